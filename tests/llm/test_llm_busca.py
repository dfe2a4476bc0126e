import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fasor.llm import busca
from fasor.llm.comum import leva_codigo

_TERMO = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BAIXA = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def simples(docs, itens, k=10):
    """Every score, by the contract's words."""
    d = [(i, _TERMO.findall((t or "").translate(_BAIXA))) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in d), sum(len(w) for _, w in d)
    df = Counter(t for _, w in d for t in set(w))
    linhas = []
    for item, texto in itens:
        q = Counter(_TERMO.findall((texto or "").translate(_BAIXA)))
        pontos = []
        for i, w in d:
            tf = Counter(w)
            s = 0
            for t, c in q.items():
                if tf[t]:
                    m = 100 - 75 + (75 * len(w) * n_docs) // total
                    peso = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += c * peso * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if s > 0:
                pontos.append((-s, i is None, i or 0))
        for r, (s, nulo, i) in enumerate(sorted(pontos)[:k], 1):
            linhas.append((item, r, None if nulo else i, -s))
    return Counter(linhas)


def conferido(spark, docs, itens, **mais):
    d = spark.createDataFrame([(t, "x", i, 3) for i, t in docs], "text string, item_id string, doc_id bigint, score int").repartition(5)
    q = spark.createDataFrame([(i, t, "y") for i, t in itens], "item_id bigint, text string, rank string")
    df = busca.busca(spark, d, q, **mais)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    r = Counter(map(tuple, df.collect()))
    assert r == simples(docs, itens, mais.get("k", 10))
    return r


def corpo(n, sorte, letras="abcdefghijklmnop"):
    palavras = [x + y for x in letras for y in letras]
    pesos = [1 / (i + 1) for i in range(len(palavras))]
    return [(i, " ".join(sorte.choices(palavras, pesos, k=sorte.randint(0, 60)))) for i in range(n)]


def test_random_corpus_in_blocks_and_small_trees(spark):
    sorte = random.Random(3)
    docs = corpo(600, sorte)
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties
    itens = [(i, " ".join(sorte.choice(docs)[1].split()[:12])) for i in range(40)]
    conferido(spark, docs, itens, por_arvore=100, palavras_por_bloco=150)
    conferido(spark, docs, itens)
    conferido(spark, docs, itens, k=3, por_arvore=1)


def test_edges(spark):
    docs = [
        (1, None), (2, ""), (3, " .,;"), (4, "Été ÉTÉ maçã 12"), (5, "a" * 100_000), (6, "rain " * 30_000 + "sun"), (None, "rain"),
        (None, "rain"), (7, "rain"), (7, "rain"), (8, "RAIN sun"),
    ]
    itens = [(1, "rain sun sun"), (1, "Rain"), (2, None), (3, "--"), (4, "nothing"), (5, "ÉTÉ"), (None, "maçã 12 12"), (6, "a" * 100_000)]
    r = conferido(spark, docs, itens)
    assert {x[0] for x in r} == {1, 5, 6, None}
    conferido(spark, docs, itens, palavras_por_bloco=1, k=2)


def test_empty_tables(spark):
    assert not conferido(spark, [], [(1, "a")])
    assert not conferido(spark, [(1, "a")], [])
    assert not conferido(spark, [(1, None)], [(1, "a")])


def test_bounds_hold_and_rule_out_leaves():
    sorte = random.Random(9)
    docs = corpo(900, sorte)
    consultas = busca.Consultas([" ".join(sorte.choice(docs)[1].split()[:8]).encode() for _ in range(25)])
    contagens = [Counter(consultas.termos[w] for w in busca.termos(t.encode()) if w in consultas.termos) for _, t in docs]
    n_dims = len(consultas.termos)
    df = np.bincount([d for c in contagens for d in c], minlength=n_dims)
    w = np.array([busca.peso(len(docs), int(x)) for x in df])
    contagens = [c for c in contagens if c]
    inicio = np.concatenate(([0], np.cumsum([len(c) for c in contagens])))
    dim = np.array([d for c in contagens for d in c])
    tf = np.array([x for c in contagens for x in c.values()])
    valor = busca.impacto(w[dim], tf, np.full(len(dim), 30), len(docs), 30 * len(docs))
    for n_faixas in (1, 7, n_dims):
        arvore = busca.Arvore(inicio, dim, valor, n_dims, busca._faixas(df, n_faixas), n_faixas, 8)
        limites = arvore.limites(consultas)
        for i, (dims, c) in enumerate(consultas.contagens):
            q = np.zeros(n_dims, np.int64)
            q[dims] = c
            pontos = np.add.reduceat(q[dim] * valor, inicio[:-1])
            abaixo = {}
            for no in reversed(range(len(arvore.filhos))):
                f = arvore.filhos[no]
                abaixo[no] = arvore.ordem[slice(*arvore.folha[no])] if f is None else np.concatenate([abaixo[f[0]], abaixo[f[1]]])
                assert pontos[abaixo[no]].max() <= limites[i, no]
        melhores = [busca.Melhores(3) for _ in consultas.contagens]
        folhas = busca.procura(arvore, list(range(len(contagens))), consultas, melhores)
    assert folhas < 0.5 * len(arvore.folha) * len(consultas.contagens)


def test_plan_has_no_cross_join(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id bigint, text string")
    itens = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    plano = busca.busca(spark, docs, itens)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plano and "NestedLoop" not in plano
    assert busca.busca(spark, docs, itens).agg(F.count("*")).first()[0] == 1

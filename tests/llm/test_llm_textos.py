"""Near duplicates, repeated passages and benchmark passages against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from fasor.llm import descontaminacao, jaccard, ligacoes, paragrafos
from fasor.llm.comum import le, leva_codigo

DOCS = "doc_id bigint, text string, n bigint, id string, chave string"


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def docs(spark, linhas):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in linhas], DOCS)


def componentes_simples(pares, nos):
    pai = {n: n for n in nos}

    def raiz(x):
        while pai[x] != x:
            pai[x] = pai[pai[x]]
            x = pai[x]
        return x

    for a, b in pares:
        a, b = raiz(a), raiz(b)
        pai[max(a, b)] = min(a, b)
    return {n: raiz(n) for n in nos}


def conjunto(texto, k):
    w = (texto or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def jaccard_simples(linhas, k=4, limiar=85):
    conj = {i: conjunto(t, k) for i, t in linhas}
    por_sombra = defaultdict(set)
    for i, s in conj.items():
        for g in s:
            por_sombra[g].add(i)
    pares = {(a, b) for v in por_sombra.values() if len(v) > 1 for a in v for b in v if a < b}
    links = [(a, b) for a, b in pares if 100 * len(conj[a] & conj[b]) >= limiar * len(conj[a] | conj[b])]
    comp = componentes_simples(links, conj)
    return {i: (len(conj[i]), comp[i]) for i in conj}


def conferido(spark, linhas):
    r = jaccard.op4_jaccard(spark, docs(spark, linhas)).collect()
    assert len(r) == len(linhas)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in r} == jaccard_simples(linhas)


def test_jaccard_table(spark):
    conferido(spark, [(x.doc_id, x.text) for x in le(spark, "/root/testdata/sf0.01", "documents").limit(500).collect()])


def test_jaccard_borderline_chains_and_hot_group(spark):
    """Copies with a few words changed, around the threshold, and texts that share a long passage."""
    g = random.Random(5)
    palavra = lambda: "".join(g.choices("abcdefgh", k=6))
    base, passagem = [palavra() for _ in range(80)], [palavra() for _ in range(60)]
    linhas = []
    for i in range(150):
        w = base[:]
        for _ in range(g.randint(0, 4)):
            w[g.randrange(len(w))] = palavra()
        linhas.append((i, " ".join(w)))
    linhas += [(1000 + i, " ".join(passagem + [palavra() for _ in range(g.randint(1, 60))])) for i in range(80)]
    linhas += [(2000 + i, linhas[0][1].upper()) for i in range(60)]
    linhas += [(3000, None), (3001, ""), (3002, " \n"), (3003, "um dois"), (3004, "UM  dois"), (3005, "um dois três quatro"), (3006, "x " * 50_000)]
    conferido(spark, linhas)


def test_jaccard_exact_threshold(spark):
    w = [f"p{i}" for i in range(103)]  # 100 shingles
    linhas = [(1, " ".join(w)), (2, " ".join(w[:88])), (3, " ".join(w[:87])), (4, " ".join(w[:75]))]
    conferido(spark, linhas)  # 1-2 is exactly 85 of 100, 1-3 is not


def test_jaccard_more_rounds_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ligacoes, "PARES_POR_LINHA", 0)
    monkeypatch.setattr(jaccard, "LINHAS_POR_PARTE", 8)
    test_jaccard_borderline_chains_and_hot_group(spark)


def test_jaccard_repeated_ids_null_ids_and_no_rows(spark):
    assert jaccard.op4_jaccard(spark, docs(spark, [])).count() == 0
    t = "a b c d e f g"
    r = jaccard.op4_jaccard(spark, docs(spark, [(5, t), (5, t), (None, t), (7, t), (None, "só nulo aqui então"), (9, "outro texto bem diferente disso")])).collect()
    assert sorted((x.doc_id or 0, x.component_id or 0) for x in r) == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 5), (9, 9)]


def test_jaccard_keeps_one_of_each(spark):
    linhas = [(i, f"a b c d e f g h {i // 3}") for i in range(30)] + [(90, None), (91, "")]
    d = docs(spark, linhas)
    fica = jaccard.um_por_componente(d)
    esperado = {i for i, (_, c) in jaccard_simples(linhas).items() if i == c}
    assert {x.doc_id for x in fica.collect()} == esperado and fica.columns == d.columns


@pytest.mark.parametrize("por_tarefa", [500_000, 40])
def test_components(spark, monkeypatch, por_tarefa):
    monkeypatch.setattr(ligacoes, "ARESTAS_POR_TAREFA", por_tarefa)
    g = random.Random(2)
    pares = [(g.randrange(400), g.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(3, 3)]
    r = {x.id: x.componente for x in ligacoes.componentes(spark.createDataFrame(pares, "a bigint, b bigint").repartition(16)).collect()}
    esperado = componentes_simples(pares, {n for p in pares for n in p})
    assert r == {n: c for n, c in esperado.items() if n in r}
    assert all(n in r for p in pares if p[0] != p[1] for n in p)
    assert ligacoes.componentes(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_prefix_filter_never_loses_a_link():
    g = np.random.default_rng(3)
    for _ in range(200):
        n = g.integers(1, 60)
        a = np.unique(g.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([g.permutation(a)[: max(1, int(len(a) * 0.93))], g.integers(0, 1 << 63, 2, dtype=np.uint64)]))
        comuns = len(np.intersect1d(a, b))
        if 100 * comuns < 85 * (len(a) + len(b) - comuns):
            continue
        classe = g.integers(0, 4, 1 << jaccard.CELULAS).astype(np.uint8)
        for ordem in range(3):
            s, linha, m = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), np.array([len(a), len(b)])
            em, _ = jaccard.prefixos(s, linha, m, classe, ordem, 85)
            assert len(np.intersect1d(s[em & (linha == 0)], s[em & (linha == 1)]))


# ---- benchmark passages

PALAVRA = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def palavras_simples(t):
    return PALAVRA.findall(bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in (t or "").encode()))


def contaminacao_simples(documentos, itens):
    seqs = [(i, palavras_simples(t)) for i, t in itens]
    saida = []
    for d, t in documentos:
        w, hit, quais = palavras_simples(t), set(), set()
        for n, (_, s) in enumerate(seqs):
            m = min(10, len(s))
            janelas = {tuple(s[k : k + m]) for k in range(len(s) - m + 1)} if s else set()
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in janelas:
                    hit |= set(range(k, k + m))
                    quais.add(n)
        # an item is an item_id, as in the SQL: rows that share one are one item
        nomes = sorted({str(seqs[n][0]) for n in quais if seqs[n][0] is not None})
        saida.append((d, len(w), len(hit), len(nomes), hashlib.sha256(",".join(nomes).encode()).hexdigest(), bool(hit)))
    return sorted(saida, key=str)


def test_benchmark_brute_force(spark):
    g = random.Random(8)
    frase = lambda n: " ".join(g.choices("Alfa beta, Gama9 dé É-x".split(), k=n))
    itens = [(i, frase(g.randint(1, 16))) for i in range(12)] + [(50, None), (51, "... !"), (52, "a b c"), (52, "a b c"), (None, "z y x")]
    documentos = [(i, frase(g.randint(0, 60))) for i in range(60)] + [(100, None), (101, ""), (102, "!"), (103, "A-B c z Y x"), (103, "A-B c z Y x"), (104, "fim " * 100_000)]
    i = spark.createDataFrame([(a, b, "k") for a, b in itens], "item_id bigint, text string, n_words string")
    r = descontaminacao.op6_descontaminacao(docs(spark, documentos), i)
    assert sorted((tuple(x) for x in r.collect()), key=str) == contaminacao_simples(documentos, itens)
    assert descontaminacao.op6_descontaminacao(docs(spark, []), i).count() == 0
    sem = descontaminacao.op6_descontaminacao(docs(spark, documentos), i.limit(0))
    assert not any(x.contaminated for x in sem.collect())


def test_automaton_brute_force():
    g = random.Random(1)
    for _ in range(400):
        janela = g.randint(1, 5)
        itens = [(k, g.choices([b"a", b"b", b"c"], k=g.randint(0, 9))) for k in range(g.randint(0, 5))]
        d = g.choices([b"a", b"b", b"c", b"d"], k=g.randint(0, 30))
        faixas, achados = descontaminacao.Automato(itens, janela).procura(d)
        hit, quais = set(), set()
        for n, (_, s) in enumerate(itens):
            m = min(janela, len(s))
            for q in range(len(s) - m + 1 if s else 0):
                for k in range(len(d) - m + 1):
                    if d[k : k + m] == s[q : q + m]:
                        hit |= set(range(k, k + m))
                        quais.add(n)
        assert ({p for a, b in faixas for p in range(a, b)}, achados) == (hit, quais)


def test_benchmark_spans_are_cut(spark):
    item = " ".join(f"w{i}" for i in range(20))
    d = docs(spark, [(1, f"Antes, disto. {item.upper()} Depois disto vem mais texto e mais texto, até que o item seja menos da metade de tudo."), (2, item), (3, "limpo"), (4, None)])
    i = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    r = {x.doc_id: x.text for x in descontaminacao.descontamina(d, i).collect()}
    assert set(r) == {1, 3, 4} and r[3] == "limpo" and r[4] is None
    assert r[1].startswith("Antes, disto. Depois disto vem") and "W" not in r[1]
    assert descontaminacao.descontamina(d, i).columns == d.columns
    with pytest.raises(ValueError):
        descontaminacao.automato(i, max_palavras=5)


# ---- repeated passages


def prosa(g, n):
    w = ["".join(g.choices("abcdefghijkl", k=g.randint(3, 8))) for _ in range(n)]
    for i in range(g.randint(4, 9), n, 9):
        w[i] += "."
    return w


def test_passages_are_found_wherever_they_stand(spark):
    g = random.Random(4)
    passagens = [prosa(g, n) for n in (55, 60, 70, 90)]
    linhas = []
    for i in range(120):
        w = prosa(g, g.randint(60, 200))
        if i < 80:
            lugar = g.randrange(len(w))
            w[lugar:lugar] = [x.upper() if i % 2 else x for x in passagens[i % 4]]
        linhas.append((i, " ".join(w)))
    linhas += [(500, None), (501, ""), (502, "curto demais."), (503, " ".join(["eco"] * 3000)), (None, linhas[0][1]), (7, linhas[7][1])]
    r = paragrafos.op7_paragrafos(docs(spark, linhas)).collect()
    achados = {x.doc_id for x in r}
    assert achados == set(range(80))
    for x in r:
        assert x.removed == (x.doc_id != x.cluster_doc) and x.cluster_doc % 4 == x.doc_id % 4 and x.end_word - x.first_word >= paragrafos.MINIMO
    limpos = {x.doc_id: x.text for x in paragrafos.remove(docs(spark, linhas[:-2])).collect()}
    assert all(limpos[i] == t for i, t in linhas[:-2] if i in (0, 1, 2, 3) or i >= 80)
    assert all(len(limpos[i].split()) <= len(t.split()) - paragrafos.MINIMO for i, t in linhas[4:80])
    assert paragrafos.op7_paragrafos(docs(spark, [])).count() == 0


def test_near_passages_by_exact_jaccard(spark):
    """Clusters are the components of all pairs of paragraphs at 0.8 or more."""
    g = random.Random(6)
    frases = []
    for _ in range(25):
        w = [x.rstrip(".") for x in prosa(g, 45)]
        for _ in range(5):
            v = w[:]
            if g.random() < 0.7:
                v[g.randrange(len(v))] = "troca" + str(g.random())[2:6]
            frases.append(" ".join(v) + ".")
    linhas = list(enumerate(frases))
    r = paragrafos.op7_paragrafos(docs(spark, linhas)).collect()
    lugares = paragrafos.ocorrencias(docs(spark, linhas)).collect()
    texto = {i: t.split() for i, t in linhas}
    conj = {x.h: conjunto(" ".join(texto[x.doc_id][x.lugar >> 32 : x.lugar & 0xFFFFFFFF]), 5) for x in lugares}
    nos = sorted(conj)
    pares = [(a, b) for a in nos for b in nos if a < b and len(conj[a] & conj[b]) >= 0.8 * len(conj[a] | conj[b])]
    comp = componentes_simples(pares, nos)
    membros = defaultdict(set)
    for x in lugares:
        membros[comp[x.h]].add(x.doc_id)
    corridas = defaultdict(list)
    for x in sorted((x for x in lugares if len(membros[comp[x.h]]) > 1), key=lambda x: (x.doc_id, x.lugar)):
        lista = corridas[x.doc_id]
        if lista and lista[-1][-1].lugar & 0xFFFFFFFF == x.lugar >> 32:
            lista[-1].append(x)
        else:
            lista.append([x])
    palavras_de = lambda c: (c[-1].lugar & 0xFFFFFFFF) - (c[0].lugar >> 32)
    passagens = [x for v in corridas.values() for c in v if palavras_de(c) >= paragrafos.PASSAGEM for x in c]
    esperado = sorted((x.doc_id, x.lugar >> 32, comp[x.h], min(membros[comp[x.h]])) for x in passagens)
    assert pares and sorted((x.doc_id, x.first_word, x.cluster_id, x.cluster_doc) for x in r) == esperado


def test_bands_reach_the_recall():
    for limiar in (0.5, 0.7, 0.8, 0.9):
        b, r = paragrafos.bandas(limiar)
        assert 1 - (1 - limiar**r) ** b >= paragrafos.RECALL and (b <= paragrafos.MAX_BANDAS or r == 1)

"""Paragraphs do not depend on their neighbours, and repeated passages are found at every length that is promised."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fasor.llm import comum, paragrafos
from fasor.llm.comum import blocos, leva_codigo

DOCS = "doc_id bigint, text string"


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def prosa(g, n):
    vocabulario = ["".join(g.choices("abcdefghijklmnop", k=g.randint(2, 9))) for _ in range(n)]
    return [w + "." if g.random() < 0.06 else w for w in vocabulario]


def partes(textos):
    """Paragraphs of each text, as hashes with their places."""
    saida = [[] for _ in textos]
    for a, _, bloco, inicio in blocos(pa.array([t.encode() for t in textos], pa.binary())):
        dono, comeco, final, hash_, _, linha = paragrafos.paragrafos(bloco, inicio)
        base = np.searchsorted(linha, dono)
        for d, x, y, h in zip(dono, comeco - base, final - base, hash_):
            saida[a + d].append((int(h), int(x), int(y)))
    return saida


def test_copies_have_equal_paragraphs_behind_any_neighbour():
    g = random.Random(1)
    textos = [" ".join(prosa(g, g.choice([6, 9, 14, 30, 120]))) for _ in range(400)]
    sozinhos = [partes([t])[0] for t in textos]
    for semente in range(3):
        ordem = list(range(len(textos)))
        random.Random(semente).shuffle(ordem)
        juntos = partes([textos[i] for i in ordem])
        assert all(juntos[k] == sozinhos[i] for k, i in enumerate(ordem))
    # every word of a text is in a paragraph
    assert all(sum(y - x for _, x, y in p) == len(t.split()) for p, t in zip(sozinhos, textos))


@pytest.mark.parametrize("n", [14, 30, 51])
def test_copies_of_short_texts_are_removed_in_any_order(spark, n):
    g = random.Random(n)
    textos = [" ".join(prosa(g, n)) for _ in range(100)]
    linhas = [(i, textos[i % 100]) for i in range(200)]
    vistos = set()
    for partes_, ordem in ((1, linhas), (16, linhas[::-1])):
        r = paragrafos.op7_paragrafos(spark.createDataFrame(ordem, DOCS).repartition(partes_)).collect()
        vistos.add(tuple(sorted(map(str, r))))
        assert {x.doc_id for x in r if x.removed} == set(range(100, 200))
    assert len(vistos) == 1


def test_recall_of_passages_inside_other_text():
    """The longest run of equal paragraphs reaches the length of a passage for nearly all of 51 words and more."""
    g = random.Random(5)
    for n, minimo in ((51, 0.9), (60, 0.96), (80, 0.99)):
        bons = 0
        for _ in range(300):
            p = prosa(g, n)
            a, b = partes([" ".join(prosa(g, g.randint(20, 90)) + p + prosa(g, g.randint(20, 90))) for _ in range(2)])
            comuns = {h for h, _, _ in a}
            corrida = melhor = fim = 0
            for h, x, y in b:
                if h in comuns:
                    corrida = corrida + y - x if x == fim else y - x
                    fim, melhor = y, max(melhor, corrida)
            bons += melhor >= paragrafos.PASSAGEM
        assert bons >= minimo * 300


def test_short_common_lines_are_left_alone(spark):
    g = random.Random(6)
    linha = " ".join(prosa(g, 13))
    linhas = [(i, " ".join(prosa(g, 40)) + "\n" + linha + "\n" + " ".join(prosa(g, 40))) for i in range(60)]
    assert paragrafos.op7_paragrafos(spark.createDataFrame(linhas, DOCS)).count() == 0


def test_contents_that_share_a_frequent_phrase(spark, monkeypatch):
    """Many contents in one key: finer keys find the same clusters as all pairs, without listing these."""
    g = random.Random(7)
    frase = [x.strip(".") for x in prosa(g, 9)]
    linhas, base = [], []
    for i in range(260):
        w = frase + [x.strip(".") for x in prosa(g, 12)]
        base.append(w)
        linhas.append((i, " ".join(w)))
    for i in range(0, 260, 4):  # one word more at the end: similar at 0.8 and more
        linhas.append((1000 + i, " ".join([*base[i], "fim"])))
    monkeypatch.setattr(paragrafos, "CONTEUDOS_POR_CHAVE", 3)
    monkeypatch.setattr(paragrafos, "QUENTE_NO_LOTE", 40)
    df = spark.createDataFrame(linhas, DOCS)
    textos = {i: t.split() for i, t in linhas}
    lugares = paragrafos.ocorrencias(df).collect()

    def sombras(x):
        w = textos[x.doc_id][x.lugar >> 32 : x.lugar & 0xFFFFFFFF]
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    conj = {x.h: sombras(x) for x in lugares}
    nos = sorted(conj)
    pai = {n: n for n in nos}

    def raiz(n):
        while pai[n] != n:
            n = pai[n]
        return n

    pares = [(a, b) for i, a in enumerate(nos) for b in nos[i + 1 :] if len(conj[a] & conj[b]) >= 0.8 * len(conj[a] | conj[b])]
    for a, b in pares:
        a, b = raiz(a), raiz(b)
        pai[max(a, b)] = min(a, b)
    achado = {(x.doc_id, x.first_word): x.cluster_id for x in paragrafos.op7_paragrafos(df).collect()}
    assert pares and achado
    certo = {(x.doc_id, x.lugar >> 32): raiz(x.h) for x in lugares}
    certos = sum(certo[k] == c for k, c in achado.items())
    assert certos >= 0.95 * len(achado)
    membros = defaultdict(set)
    for x in lugares:
        membros[raiz(x.h)].add(x.doc_id)
    juntos = {d for m in membros.values() if len(m) > 1 for d in m}
    assert len({d for d, _ in achado}) >= 0.95 * len({d for d in juntos if d % 4 == 0 and d + 1000 in juntos})


def test_no_pair_of_a_frequent_key_is_lost(spark, monkeypatch):
    """Contents in one key, with pairs right at the threshold: all of them are linked, not most."""
    g = random.Random(8)
    linhas = []
    for i in range(900):
        w = [x.strip(".") for x in prosa(g, 19)]
        linhas += [(i, " ".join(w[:16])), (10000 + i, " ".join(w))]  # 12 of 15 shingles are common
    inteiros = [p == [(h, 0, n)] for p, n in zip(partes([t for _, t in linhas]), [16, 19] * 900) for h in [p[0][0]]]
    pares = [i for i in range(900) if inteiros[2 * i] and inteiros[2 * i + 1]]
    chaves = paragrafos._chaves

    def uma(docs, b, r):
        return chaves(docs, b, r).filter("id IS NOT NULL").select(F.lit(1).cast("bigint").alias("chave"), "id", F.lit(0).alias("parte")).distinct()

    monkeypatch.setattr(paragrafos, "_chaves", uma)
    achados = defaultdict(set)
    for x in paragrafos.op7_paragrafos(spark.createDataFrame(linhas, DOCS)).collect():
        achados[x.cluster_id].add(x.doc_id)
    juntos = {d: c for c, m in achados.items() for d in m}
    assert len(pares) > 100
    assert [i for i in pares if i not in juntos or juntos[i] != juntos.get(10000 + i)] == []


def test_rows_of_a_key_that_another_batch_deals_to_parts_stay(spark):
    """Part 0 of such a key has few rows or one; it is replaced by finer keys like the parts."""
    linhas = [(1, 10, 1), (1, 11, 2), (1, 12, 0), (1, None, 0), (2, 13, 0), (3, None, 0), (4, 14, 0), (4, 15, 0)]
    df = spark.createDataFrame(linhas, "chave bigint, id bigint, parte int")
    assert {(x.chave, x.id, x.quente) for x in paragrafos._grupos(df).collect()} == {
        (1, 10, True), (1, 11, True), (1, 12, True), (4, 14, False), (4, 15, False)
    }


def test_dealt_keys_are_told(spark, monkeypatch):
    g = random.Random(9)
    frase = [x.strip(".") for x in prosa(g, 9)]
    linhas = [(i, " ".join(frase + [x.strip(".") for x in prosa(g, 4)])) for i in range(60)]
    monkeypatch.setattr(paragrafos, "QUENTE_NO_LOTE", 10)
    chaves = paragrafos._chaves(spark.createDataFrame(linhas, DOCS).coalesce(1), 4, 1).collect()
    dadas = {x.chave for x in chaves if x.parte > 0}
    assert dadas and dadas == {x.chave for x in chaves if x.id is None}
    assert all(x.parte == 0 for x in chaves if x.id is None)


def test_no_words_of_a_family_meet():
    """A word of 1024 letters and its complement, whose polynomials are equal modulo any power of two up to 2^64."""
    w = "a"
    while len(w) < 1024:
        w += w.translate(str.maketrans("ab", "ba"))
    bloco = f" {w} {w.translate(str.maketrans('ab', 'ba'))} {w.upper()} ".encode()
    ini, fim, _, b = comum.palavras(bloco, np.array([1, len(bloco)]))
    (h,) = comum.hashes(b, (ini, fim))
    assert h[0] == h[2] != h[1]
    (curtos,) = comum.hashes_de(np.arange(10, dtype=np.uint64), (np.arange(10), np.arange(1, 11)))
    assert len(set(curtos.tolist())) == 10


def test_hashes_do_not_depend_on_the_block():
    g = np.random.default_rng(3)
    b = g.integers(97, 123, 5000, dtype=np.uint8)
    ini = np.arange(0, 4900, 7)
    (h,) = comum.hashes(b, (ini, ini + 6))
    antes = comum._SEM_RESTO
    comum._SEM_RESTO = 10
    try:
        (outra,) = comum.hashes(b[21:], (ini[3:] - 21, ini[3:] - 15))
    finally:
        comum._SEM_RESTO = antes
    assert (outra == h[3:]).all() and Counter(h.tolist()).most_common(1)[0][1] == 1


def test_two_long_words_are_not_linked(spark):
    from fasor.llm import jaccard

    w = "a"
    while len(w) < 1024:
        w += w.translate(str.maketrans("ab", "ba"))
    linhas = [(1, w), (2, w.translate(str.maketrans("ab", "ba"))), (3, w)]
    df = spark.createDataFrame(linhas, DOCS).withColumn("x", F.lit(1))
    assert {r.doc_id: r.component_id for r in jaccard.op4_jaccard(spark, df).collect()} == {1: 1, 2: 2, 3: 1}


def test_cells_lose_no_pair(spark):
    g = random.Random(12)
    conj = []
    for _ in range(40):
        a = [g.getrandbits(63) for _ in range(g.choice([2, 4, 5, 8, 9, 20, 60, 254, 300]))]
        conj.append(a)
        for _ in range(4):
            conj.append(a[g.randint(0, 1 + len(a) // 6) :] + [g.getrandbits(63) for _ in range(g.randint(0, 1 + len(a) // 8))])
    df = spark.createDataFrame([(i, c) for i, c in enumerate(conj)], "id int, s array<bigint>").withColumn("peso", paragrafos._peso())
    um, outro = (df.select(F.col("id").alias(f"i{x}"), F.col("s").alias(f"s{x}"), F.col("peso").alias(f"p{x}")) for x in "ab")
    comuns = F.size(F.array_intersect("sa", "sb"))
    r = um.join(outro, F.expr("ia < ib AND ia div 5 = ib div 5")).select(
        paragrafos._podem(0.8)(F.col("pa"), F.col("pb")).alias("pode"), (comuns >= 0.8 * (F.size("sa") + F.size("sb") - comuns)).alias("liga")
    )
    contas = {(x.pode, x.liga): x["count"] for x in r.groupBy("pode", "liga").count().collect()}
    assert (False, True) not in contas and contas[True, True] > 20 and contas[False, False] > 20

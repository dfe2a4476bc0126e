"""Language and toxicity: held-out accuracy, planted pairs, rows without letters, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fasor.llm import idioma, toxicidade
from fasor.llm.comum import le, leva_codigo

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def test_codewords_are_far_apart():
    for k in (2, 3, 4, 6, 9, 30):
        c = idioma.codigo(k)
        distancias = [(c[a] != c[b]).sum() for a in range(k) for b in range(a)]
        assert min(distancias) >= (2 ** (k - 2) if k <= 6 else 3 * c.shape[1] / 10)


def test_wrong_bits_are_corrected():
    c = idioma.codigo(4)
    m = idioma.Modelo(list("abcd"), c, np.eye(c.shape[1]), np.zeros(c.shape[1]), np.full(c.shape[1], 1 / c.shape[1]), 0.05)
    for k in range(4):
        x = c[[k]].copy()
        x[0, 0] *= -1
        qual, score, duvida = m.decide(x)
        assert qual[0] == k and score[0] < 1 and not duvida[0]
    assert m.decide(np.zeros((1, c.shape[1])))[2][0]  # all languages alike


def test_language_held_out(spark):
    d = le(spark, SF, "documents")
    r = idioma.op3_idioma(d).join(d.select("doc_id", "lang"), "doc_id").collect()
    fora = [x for x in r if x.held_out]
    assert len(r) == 1000 and 250 < len(fora) < 420
    assert np.mean([x.lang == x.lang_pred for x in fora]) > 0.97
    assert all(0 <= x.score <= 1 for x in r)


def test_language_odd_rows(spark):
    d = le(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = [(-1, None, "en"), (-2, "", "en"), (-3, "12 !!", "fr"), (-4, "日本", None), (-5, "the of and " * 60_000, None), (None, "the and of this", None), (-6, "7", "xx")]
    novo = d.union(spark.createDataFrame(odd, d.schema)).withColumn("score", F.lit("clash"))
    r = {x.doc_id: x for x in idioma.identifica(novo).collect()}
    assert [r[i].lang_pred for i in (-1, -2, -3, -6)] == ["und"] * 4 and r[-1].score == 0.0
    assert r[-5].lang_pred == "en" and r[-4].lang_pred != "und" and len(r) == 1000 + len(odd)
    assert idioma.identifica(novo).columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]


def test_language_few_labels(spark):
    vazio = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert idioma.identifica(vazio).count() == 0
    um = spark.createDataFrame([(i, "abc def", "pt") for i in range(9)] + [(50, "..", "pt")], vazio.schema)
    assert {(x.lang_pred, x.score) for x in idioma.identifica(um).collect()} == {("pt", 1.0), ("und", 0.0)}
    nenhum = spark.createDataFrame([(1, "abc", None)], vazio.schema)
    assert [x.lang_pred for x in idioma.identifica(nenhum).collect()] == ["und"]
    # more languages than are learned: those with most documents, by name where equal
    muitos = spark.createDataFrame([(i, "a", f"l{i:03d}") for i in range(200)] + [(200, "a", "l150")], vazio.schema)
    assert sorted(idioma.amostra(muitos, F.lit(True), max_idiomas=3)[1]) == ["l000", "l001", "l150", "l150"]


def test_a_hundred_languages(spark):
    import random

    r = random.Random(5)
    # languages of their own syllables; and misspelt tags that hardly occur
    vocabularios = [["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 7))) for _ in range(30)] for _ in range(100)]
    linhas = [(i, " ".join(r.choice(vocabularios[i % 100]) for _ in range(25)), f"l{i % 100:02d}") for i in range(4000)]
    linhas += [(4000 + i, "nada disto", f"raro{i}") for i in range(20)]
    docs = spark.createDataFrame(linhas, "doc_id bigint, text string, lang string").repartition(6)
    x, quais = idioma.amostra(docs, idioma.resto_do_id(F.col("doc_id")) != 1, max_idiomas=100, max_linhas=2000)
    assert len(set(quais)) == 100 and max(map(quais.count, set(quais))) <= 20 and not any(q.startswith("raro") for q in quais)
    modelo = idioma.treina(x, quais)
    certos = idioma.prediz(docs, modelo).filter(~F.col("lang").startswith("raro") & (idioma.resto_do_id(F.col("doc_id")) == 1)).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert certos > 0.95


def test_both_solutions_are_equal(monkeypatch):
    gerador = np.random.default_rng(2)
    x = gerador.random((90, 32)).astype(np.float32)
    quais = [f"l{i % 3}" for i in range(90)]
    monkeypatch.setattr(idioma, "DIMENSOES", 32)
    primal = idioma.treina(x, quais)
    monkeypatch.setattr(idioma, "DIMENSOES", 90)
    dual = idioma.treina(x, quais)
    assert np.allclose(primal.pesos, dual.pesos, atol=1e-3) and np.allclose(primal.peso_do_bit, dual.peso_do_bit)
    assert np.allclose(primal.vies, dual.vies, atol=1e-3)


def test_machine_learns_a_pair():
    """Neither term alone is toxic, both together are: no sum of weights can say so."""
    gerador = np.random.default_rng(1)
    listas, y = [], []
    for _ in range(3000):
        a, b = gerador.random(2) < 0.5
        listas.append(np.unique(np.concatenate([[1] * int(a), [2] * int(b), gerador.integers(10, 400, 5)]).astype(np.int64)))
        y.append(float(a and b))
    m = toxicidade.treina(listas, np.array(y), np.ones(3000))
    um, dois, ambos = (m.pontua(np.zeros(len(t), int), np.array(t), 1)[0] for t in ([1], [2], [1, 2]))
    assert um < 0.3 and dois < 0.3 and ambos > 0.7
    assert abs(float(m.fatores[m.lugar[1]] @ m.fatores[m.lugar[2]])) > 0.05


def test_toxicity_held_out(spark):
    d, rotulos = le(spark, "/root/testdata/sf0.1", "documents"), le(spark, "/root/testdata/sf0.1", "labels")
    r = toxicidade.op8_toxicidade(d, rotulos).join(rotulos, "doc_id").filter("held_out").collect()
    toxicos, limpos = [x for x in r if x.toxic], [x for x in r if not x.toxic]
    assert np.mean([x.predicted for x in toxicos]) > 0.75
    assert np.mean([x.predicted for x in limpos]) < 0.005


def test_toxicity_odd_rows(spark):
    d, rotulos = le(spark, SF, "documents").select("doc_id", "text"), le(spark, SF, "labels").select("doc_id", "toxic")
    odd = [(-1, None), (-2, ""), (-2, ""), (-3, "..."), (None, "idiot"), (-4, "idiot " * 100_000)]
    d = d.union(spark.createDataFrame(odd, d.schema)).withColumn("predicted", F.lit("clash"))
    rotulos = rotulos.union(spark.createDataFrame([(-1, None), (None, 1), (-77, 1), (-3, 0), (-3, 0)], rotulos.schema))
    r = toxicidade.op8_toxicidade(d, rotulos).collect()
    assert len(r) == 1000 + len(odd) and all(0 <= x.score <= 1 for x in r)
    assert len({x.score for x in r if x.doc_id in (-1, -2, -3)}) == 1
    assert toxicidade.op8_toxicidade(d.limit(0), rotulos).count() == 0
    assert {x.score for x in toxicidade.op8_toxicidade(d, rotulos.limit(0)).collect()} < {0.0, float(1 / (1 + np.exp(500)))} | {0.0}

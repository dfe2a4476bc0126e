"""The near-duplicate stage of the pipeline takes runs of five words and 0.8."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from fasor.llm.comum import le
from test_llm_textos import jaccard_simples


def test_near_copies_at_five_words_and_four_fifths(spark):
    g = random.Random(8)
    palavras = lambda n: ["".join(g.choices("abcdefgh", k=6)) for _ in range(n)]
    linhas = []
    for _ in range(12):
        base = palavras(200)
        for corte in (0, 34, 38, 44, 60):  # about 1, 0.83, 0.81, 0.78 and 0.69 of the first
            linhas.append((len(linhas), " ".join(base[: 200 - corte])))
    tabela = [(10_000 + x.doc_id, x.text) for x in le(spark, "/root/testdata/sf0.01", "documents").limit(300).collect()]
    d = spark.createDataFrame(linhas + tabela, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    r = corpus_pipeline.quase_copias(spark, d, "").collect()
    cinco, quatro = (jaccard_simples(linhas + tabela, *x) for x in ((5, 80), (4, 85)))
    assert sorted(x.doc_id for x in r) == sorted(i for i, (_, c) in cinco.items() if c == i)
    assert sum(c != i for i, (_, c) in cinco.items()) > sum(c != i for i, (_, c) in quatro.items())


def test_columns_that_bear_a_results_name_stay(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.001"
    nomes = {"score": 7.5, "spans": "texto", "n_words": 3, "n_hit": "h", "text_clean": "c", "lang_pred": "l", "ambiguous": 2, "id": 9, "componente": "k", "copias": 1.5, "keep_id": 4, "t": "u", "n": 5}
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).withColumns({c: F.lit(v) for c, v in nomes.items()})
    for nome, etapa in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materializa(etapa(spark, docs, sf))
        linhas = docs.select(*nomes).distinct().collect()
        assert [r.asDict() for r in linhas] == [nomes], nome
        assert docs.columns[-len(nomes) :] == [*nomes], nome

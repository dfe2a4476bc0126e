"""What the pipeline's Python workers hold at once: short batches of rows, short blocks of texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fasor.llm import comum, idioma, jaccard

#: The setting's name, spelled out: the code is held against Spark's.
CHAVE = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture(autouse=True)
def sem_ajuste(spark):
    antes = spark.conf.get(CHAVE, None)
    spark.conf.unset(CHAVE)
    yield
    spark.conf.unset(CHAVE) if antes is None else spark.conf.set(CHAVE, antes)


def _textos(n, palavras=400):
    g = random.Random(3)
    lexico = ["".join(g.choices("abcdefghij", k=6)) for _ in range(5000)]
    return [" ".join(g.choices(lexico, k=palavras)).encode() for _ in range(n)]


def _pico(f):
    """Peak of what the call allocates, and its result."""
    comum._potencias.clear()
    tracemalloc.start()
    try:
        saida = f()
        return tracemalloc.get_traced_memory()[1], saida
    finally:
        tracemalloc.stop()


class _Docs:
    """Stands for a DataFrame, to get at the function of a task."""

    def select(self, *_):
        return self

    def mapInArrow(self, tarefa, _):
        return tarefa


@pytest.mark.parametrize("etapa", ["idiomas", "quase_copias", "sem_benchmark"])
def test_stages_hand_texts_to_python_in_short_batches(spark, etapa, tmp_path):
    def tamanhos(lotes):
        for lote in lotes:
            yield pa.RecordBatch.from_arrays([pa.array([lote.nbytes]), pa.array([len(lote)])], names=["b", "n"])

    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en"), (2, "das ist ein Haus und ein Hund", "de")], "doc_id bigint, text string, lang string")
    spark.createDataFrame([("i", "uma frase")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    getattr(corpus_pipeline, etapa)(spark, docs, str(tmp_path))
    textos = spark.range(0, 9000, 1, 1).select("id", F.repeat(F.lit("palavra "), 400).cast("binary").alias("t"))
    r = textos.mapInArrow(tamanhos, "b bigint, n bigint").collect()
    assert sum(x.n for x in r) == 9000
    assert max(x.b for x in r) <= 6 << 20  # 28 MB in one batch without the setting


def test_run_leaves_the_setting_as_it_was(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "um")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    vistos = []

    def etapa(s, docs, _):
        comum.lotes_curtos(s)
        vistos.append(s.conf.get(CHAVE))
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", etapa), ("b", lambda s, docs, _: docs)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert spark.conf.get(CHAVE, None) is None
    spark.conf.set(CHAVE, "1000000")  # the caller's own stays, within and after
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert spark.conf.get(CHAVE, None) == "1000000"
    assert vistos == [str(comum.LOTE), "1000000"]


def test_language_vectors_take_little_memory():
    textos = pa.array(_textos(1500), pa.binary())
    pico, partes = _pico(lambda: [(z - a, tem.all()) for a, z, x, tem in idioma.vetores(textos)])
    assert sum(n for n, _ in partes) == 1500 and all(t for _, t in partes)
    assert pico < 32e6  # 67 MB with blocks of 1 MB


def test_sets_take_little_memory(spark):
    textos = _textos(1500)
    lote = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(textos, pa.binary())], names=["doc_id", "t"])
    pico, saida = _pico(lambda: list(jaccard._medidas(_Docs(), 5)(iter([lote]))))
    n = np.concatenate([np.array(s.column(1).drop_null()) for s in saida])
    assert n.tolist() == [len({tuple(p[i : i + 5]) for i in range(len(p) - 4)}) for p in map(bytes.split, textos)]
    assert pico < 64e6  # 117 MB with blocks of 1 MB

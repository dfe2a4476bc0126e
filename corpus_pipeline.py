"""Clean a corpus: stages over the documents, each written as Parquet and read again by the next.

Language identification drops documents without a recognisable language; of equal texts the largest id stays; of each
near-duplicate component the least id stays; benchmark passages are cut out, and documents that are mostly benchmark
go; what is left is packed into bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fasor.llm import consultas, descontaminacao, empacotamento, exatos, idioma, jaccard
from fasor.llm.comum import CHAVE_DO_LOTE, le, leva_codigo, lotes_curtos, materializa

#: Documents whose two nearest languages are close and that score less are no language's.
SCORE_MINIMO = 0.4
#: Near duplicates share at least so many hundredths of their runs of so many words.
LIMIAR = 80
SOMBRA = 5


def idiomas(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leva_codigo(spark)
    lotes_curtos(spark)
    # the other columns travel in one, so that none of them is taken for a result
    outras = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__doc")
    previstos = idioma.identifica(docs.select(outras, "doc_id", "text", "lang"))
    rejeitado = (F.col("lang_pred") == idioma.SEM_IDIOMA) | (F.col("ambiguous") & (F.col("score") < SCORE_MINIMO))
    return previstos.filter(~rejeitado).select(*[F.col("text") if c == "text" else F.col("__doc").getField(c).alias(c) for c in docs.columns])


def copias(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exatos.deduplica(docs)


def quase_copias(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leva_codigo(spark)
    lotes_curtos(spark)
    return jaccard.um_por_componente(docs, k=SOMBRA, limiar=LIMIAR)


def sem_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leva_codigo(spark)
    lotes_curtos(spark)
    return descontaminacao.descontamina(docs, le(spark, sf_dir, "benchmark"))


def empacotados(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leva_codigo(spark)
    return empacotamento.op1_empacotamento(docs)


STAGES = [
    ("idioma", idiomas),
    ("exatos", copias),
    ("jaccard", quase_copias),
    ("descontaminacao", sem_benchmark),
    ("empacotamento", empacotados),
]

#: No SQL expresses the first stage; tests hold the rows against plain Python versions of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the table ``documents``."""
    docs = le(spark, sf_dir, "documents")
    antes = spark.conf.get(CHAVE_DO_LOTE, None)
    try:
        for _, etapa in STAGES[:-1]:
            docs = materializa(etapa(spark, docs, sf_dir))
    finally:
        if antes is None:  # the stages set it, and all that they hand to Python is written now
            spark.conf.unset(CHAVE_DO_LOTE)
    return STAGES[-1][1](spark, docs, sf_dir)


CONSULTAS = {**consultas.CONSULTAS, "pipeline": run}
SQL = dict(consultas.SQL)

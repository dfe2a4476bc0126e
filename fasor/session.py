"""Session defaults used by the command lines, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

PADROES = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def sessao(nome: str = "fasor", master: str | None = None, **extras: str) -> SparkSession:
    """Return a session with the defaults above; ``extras`` win over them."""
    construtor = SparkSession.builder.appName(nome)
    if master:
        construtor = construtor.master(master)
    for chave, valor in {**PADROES, **extras}.items():
        construtor = construtor.config(chave, valor)
    spark = construtor.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

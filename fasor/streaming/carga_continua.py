"""Upsert exports as they arrive in the folder.

The load is idempotent and a late file simply replaces its hours, so a micro-batch is the batch
load of its ZIPs. The checkpoint remembers which ZIPs are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fasor.plans.ingestao import carrega_linhas
from fasor.sources import zips

ESQUEMA_BINARIO = "path string, modificationTime timestamp, length bigint, content binary"


def inicia_carga(
    spark: SparkSession,
    pasta: str,
    base: str,
    checkpoint: str,
    zips_por_lote: int = 1000,
    gatilho: dict | None = None,
    intervalos: bool = True,
    **opcoes,
) -> StreamingQuery:
    """Start the continuous load; ``gatilho`` is passed to ``trigger`` (default: what is there now).
    ``intervalos`` False reads whole ZIPs, for folders that executors can open through Spark only."""

    def carrega_lote(lote: DataFrame, _lote: int) -> None:
        linhas = zips.linhas_dos_caminhos(lote) if intervalos else zips.linhas_dos_zips(lote)
        carrega_linhas(lote.sparkSession, linhas, base, **opcoes).descarta()

    binarios = (
        spark.readStream.format("binaryFile")
        .schema(ESQUEMA_BINARIO)
        .option("pathGlobFilter", "*.zip")
        .option("maxFilesPerTrigger", zips_por_lote)
        .load(pasta)
    )
    return (
        (binarios.select("path", "length") if intervalos else binarios)
        .writeStream.foreachBatch(carrega_lote)
        .option("checkpointLocation", checkpoint)
        .trigger(**(gatilho or {"availableNow": True}))
        .start()
    )

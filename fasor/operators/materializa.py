"""Results read more than once, written to the shared folder of the session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHAVE = "spark.checkpoint.dir"
_PROPRIAS: dict[str, str] = {}
_ESCOPO = threading.local()


def pasta_compartilhada(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder of that machine; on a cluster that would be no use
    to the others, so there the setting is required. The plan is the same everywhere.
    """
    pasta = spark.conf.get(CHAVE, None)
    if pasta is not None:
        return pasta.rstrip("/")
    contexto = spark.sparkContext
    if not contexto.isLocal:
        raise ValueError(f"set {CHAVE} to a folder that the driver and all executors share")
    if contexto.applicationId not in _PROPRIAS:
        _PROPRIAS[contexto.applicationId] = tempfile.mkdtemp(prefix="fasor-")
        atexit.register(shutil.rmtree, _PROPRIAS[contexto.applicationId], ignore_errors=True)
    return _PROPRIAS[contexto.applicationId]


def materializa(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    Later passes then read only the columns they need, their plans start at a file scan, and a lost executor costs a
    re-read instead of the whole lineage. The files stay until ``apaga`` (see ``provisorios``).
    """
    spark = df.sparkSession
    destino = f"{pasta_compartilhada(spark)}/fasor/{uuid.uuid4().hex}"
    for escritos in getattr(_ESCOPO, "listas", ()):
        escritos.append(destino)
    df.write.parquet(destino)
    return spark.read.schema(df.schema).parquet(destino)


@contextmanager
def provisorios() -> Iterator[list[str]]:
    """The list of what ``materializa`` writes in this thread while the block runs. Blocks may nest."""
    escritos: list[str] = []
    listas = _ESCOPO.__dict__.setdefault("listas", [])
    listas.append(escritos)
    try:
        yield escritos
    finally:
        listas.pop()


def apaga(spark: SparkSession, escritos: list[str]) -> None:
    """Delete written results. DataFrames that read them can no longer be used."""
    jvm = spark._jvm
    for destino in escritos:
        caminho = jvm.org.apache.hadoop.fs.Path(destino)
        caminho.getFileSystem(spark._jsc.hadoopConfiguration()).delete(caminho, True)
    escritos.clear()

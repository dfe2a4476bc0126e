"""Exact duplicates against a persistent index of digests.

The index is a Parquet table, bucketed and sorted by digest, in a folder that outlives the session. A load computes the
digests of its texts, reduces equal ones, keeps what a sort-merge anti-join does not find in the index, and appends
that. The index side of the join needs no exchange, whatever its size.

Defined results: NULL text counts as empty; texts are equal after lower-casing A-Z. Of equal texts in a load the row of
the largest ``doc_id`` stays (NULL counts as least; of rows with the same id one stays); a text that the index already
holds has no row that stays. An empty load appends nothing. Further columns of the documents are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fasor.llm.comum import MAX_IDS, a_cada_linha, materializa, minusculas, pasta_compartilhada
from fasor.operators.materializa import apaga, provisorios


@dataclass(frozen=True)
class Indice:
    spark: SparkSession
    tabela: str
    baldes: int

    def le(self) -> DataFrame:
        return self.spark.table(self.tabela)


def abre_indice(spark: SparkSession, pasta: str | None = None, baldes: int | None = None) -> Indice:
    """Open the index in ``pasta``, or begin one there; without ``pasta``, a new one in the shared folder.

    ``baldes`` has to be the same each time. A bucket should hold some hundred thousand digests.
    """
    if pasta is None:
        pasta = f"{pasta_compartilhada(spark).rstrip('/')}/fasor/indice-{uuid.uuid4().hex}"
    baldes = baldes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tabela = f"indice_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {tabela} (digest BINARY, keep_id BIGINT, carga STRING, linha BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {baldes} BUCKETS LOCATION '{pasta}'"
    )
    return Indice(spark, tabela, baldes)


def digestos(docs: DataFrame, id: str = "doc_id", texto: str = "text") -> DataFrame:
    """One row per document: id, a number of the row, SHA-256 of the normalised text. Written once."""
    return materializa(
        docs.select(
            F.col(id).cast("bigint").alias("doc_id"),
            F.monotonically_increasing_id().alias("linha"),
            _digest(F.col(texto)).alias("digest"),
        )
    )


def _digest(texto):
    return F.unhex(F.sha2(minusculas(texto), 256))


def carrega(lote: DataFrame, indice: Indice, carga: str) -> None:
    """Append to the index the digests of ``lote`` that it does not have, with the row that stays for each."""
    # numbers only, so that equal digests combine in hash maps before they move
    id_ou_menor = F.coalesce("doc_id", F.lit(-(1 << 63)))
    ficam = lote.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.max_by("linha", id_ou_menor).alias("linha"))
    novos = (
        ficam.join(indice.le().select("digest").hint("merge"), "digest", "left_anti")
        .select("digest", "keep_id", F.lit(carga).alias("carga"), "linha")
        .repartition(indice.baldes, "digest")
    )
    novos.write.insertInto(indice.tabela)


def situacao(lote: DataFrame, indice: Indice, cargas: list[str]) -> DataFrame:
    """One row per document of ``lote``: what the index says of its text, and how many rows of ``lote`` have it.

    Columns doc_id, linha, digest, keep_id, group_size, kept. ``cargas`` names the loads that ``lote`` went in by.
    A text of many copies is joined by broadcast, so that no task gets all of them.
    """
    grupos = materializa(
        lote.groupBy("digest")
        .agg(F.count("*").alias("group_size"))
        .join(indice.le().hint("merge"), "digest")
        .select(
            "digest",
            "keep_id",
            "group_size",
            F.when(F.col("carga").isin(cargas), F.col("linha")).alias("fica"),
        )
    )
    return a_cada_linha(lote, grupos, ["digest"], "group_size").select(
        "doc_id", "linha", "digest", "keep_id", "group_size", F.equal_null("linha", "fica").alias("kept")
    )


def deduplica(docs: DataFrame, indice: Indice | None = None) -> DataFrame:
    """The documents that stay, all their columns, after one load into ``indice`` (a new one if none is given).

    Only digests travel, where few enough rows go: the documents are read again and meet the keys of the rows that go.
    """
    spark = docs.sparkSession
    indice = indice or abre_indice(spark)
    carga = uuid.uuid4().hex
    with provisorios() as escritos:
        lote = digestos(docs)
        carrega(lote, indice, carga)
        estado = situacao(lote, indice, [carga])
        chave = ["doc_id", "digest"]
        saem = materializa(estado.filter(~F.col("kept")).select(*chave).distinct())
        # rows equal in id and text, of which one stays: told apart only by dropping repeats
        repetem = materializa(estado.filter("kept").select(*chave).join(_lado(saem), _iguais(), "left_semi"))
        apaga(spark, escritos[:-2])
    com_digest = docs.withColumn("__digest", _digest(F.col("text")))

    def junta(df: DataFrame, chaves: DataFrame, como: str) -> DataFrame:
        poucas = chaves.limit(MAX_IDS + 1).count() <= MAX_IDS
        lado = _lado(chaves)
        condicao = F.equal_null(F.col("doc_id").cast("bigint"), F.col("__id")) & (F.col("__digest") == F.col("__d"))
        return df.join(F.broadcast(lado) if poucas else lado, condicao, como)

    ficam = junta(com_digest, saem, "left_anti").select(*docs.columns)
    if repetem.isEmpty():
        return ficam
    unicas = junta(com_digest, repetem, "left_semi").dropDuplicates(["doc_id", "__digest"]).select(*docs.columns)
    return ficam.unionByName(unicas)


def _lado(chaves: DataFrame) -> DataFrame:
    return chaves.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__d"))


def _iguais():
    return F.equal_null("doc_id", "__id") & (F.col("digest") == F.col("__d"))


def op9_exatos(spark: SparkSession, documentos: DataFrame) -> DataFrame:
    """All documents in two loads, larger ids first, so that the anti-join of the second meets a filled index."""
    lote = digestos(documentos)
    indice = abre_indice(spark)
    meio = lote.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    corte = F.coalesce(F.col("doc_id") >= F.lit(meio), F.lit(False))
    carrega(lote.filter(corte), indice, "1")
    carrega(lote.filter(~corte), indice, "2")
    return situacao(lote, indice, ["1", "2"]).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
"""

"""Shards of near equal bytes by histogram sort.

Documents are ordered by the hash of their text, then by the hash of their id, so that equal texts are neighbours and a
group of any share can still be cut. The splitters of this order are found without moving rows: each round counts the
exact bytes in 256 equal parts of every interval that still holds a splitter, and the next round looks only into the
part that holds it. A splitter is final when the bytes below it are within the tolerance of its target, or when its
interval holds a single key. Then rows move once, to (shard, piece), where a piece is a small part of the order.

Defined results: NULL text counts as empty. Rows equal in text and id cannot be told apart and share a shard. No rows
give no rows; fewer rows than shards leave shards empty. Further columns travel with their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fasor.llm.comum import materializa

_BITS = 8
_SINAL = -(1 << 63)

CHAVE, DESEMPATE, TAMANHO = "__chave", "__desempate", "__tamanho"


def com_chaves(docs: DataFrame, id: str = "doc_id", texto: str = "text") -> DataFrame:
    """Add the two words of the sort key and the size: UTF-8 bytes plus 8."""
    t = F.coalesce(F.col(texto), F.lit(""))
    return docs.withColumns(
        {
            CHAVE: F.xxhash64(t),
            DESEMPATE: F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("?"))),
            TAMANHO: F.octet_length(t).cast("bigint") + 8,
        }
    )


def _sem_sinal(c: Column) -> Column:
    """The bits of a signed number whose unsigned order is the order of the number."""
    return c.bitwiseXOR(F.lit(_SINAL))


def _com_sinal(u: int) -> int:
    return u + _SINAL


@dataclass(frozen=True)
class _Intervalo:
    """Keys that begin with ``bits`` known bits: of the first word, or of the second where the first is given."""

    chave: int | None  # unsigned first word, once all rows of the interval have the same
    prefixo: int
    bits: int

    def contem(self) -> Column:
        c = F.lit(True)
        if self.chave is not None:
            c = F.col(CHAVE) == F.lit(_com_sinal(self.chave))
        if self.bits:
            c = c & (F.shiftrightunsigned(_sem_sinal(self._palavra()), 64 - self.bits) == F.lit(self.prefixo))
        return c

    def _palavra(self) -> Column:
        return F.col(CHAVE if self.chave is None else DESEMPATE)

    def parte(self) -> Column:
        return F.shiftrightunsigned(_sem_sinal(self._palavra()), 64 - self.bits - _BITS).bitwiseAND(F.lit(255))

    def inicio(self, parte: int) -> tuple[int, int]:
        """The least key (unsigned words) of a part; part 256 is the end of the interval."""
        u = ((self.prefixo << _BITS) + parte) << (64 - self.bits - _BITS)
        if self.chave is None:
            return u, 0
        return (self.chave, u) if u < 1 << 64 else (self.chave + 1, 0)


def _conta(df: DataFrame, abertos: list[_Intervalo]) -> dict[int, list]:
    """Exact bytes in every part of the open intervals: at most 256 rows for each come to the driver."""
    qual = F.coalesce(*[F.when(i.contem(), F.lit(n)) for n, i in enumerate(abertos)])
    parte = F.coalesce(*[F.when(i.contem(), i.parte()) for i in abertos])
    somas = (
        df.select(qual.alias("i"), parte.alias("p"), CHAVE, DESEMPATE, TAMANHO)
        .filter("i IS NOT NULL")
        .groupBy("i", "p")
        .agg(
            F.sum(TAMANHO).alias("s"),
            F.min(CHAVE).alias("c0"),
            F.max(CHAVE).alias("c1"),
            F.min(DESEMPATE).alias("d0"),
            F.max(DESEMPATE).alias("d1"),
        )
    )
    por_intervalo: dict[int, list] = {}
    for r in sorted(somas.collect()):
        por_intervalo.setdefault(r["i"], []).append(r)
    return por_intervalo


def divisores(df: DataFrame, n: int, tolerancia: float = 0.001) -> list[tuple[int, int]]:
    """The least key (two signed words) of shards 1 to n-1.

    ``df`` has the columns of ``com_chaves`` and is read once per round. ``tolerancia`` is a share of a shard.
    """
    total = df.agg(F.sum(TAMANHO)).first()[0] or 0
    if n < 2 or not total:
        return [(_com_sinal((1 << 64) - 1), (1 << 63) - 1)] * (n - 1)
    folga = tolerancia * total / n
    prontos: dict[int, tuple[int, int]] = {}
    situacao = {k: (_Intervalo(None, 0, 0), 0) for k in range(1, n)}  # interval, bytes below it
    while situacao:
        abertos = list(dict.fromkeys(i for i, _ in situacao.values()))
        contas = _conta(df, abertos)
        for k, (intervalo, abaixo) in list(situacao.items()):
            alvo = k * total / n
            for r in contas[abertos.index(intervalo)]:
                if abaixo + r["s"] >= alvo:
                    break
                abaixo += r["s"]
            antes, depois = intervalo.inicio(r["p"]), intervalo.inicio(r["p"] + 1)
            c0, d0 = r["c0"] - _SINAL, r["d0"] - _SINAL
            sozinho = r["c0"] == r["c1"] and r["d0"] == r["d1"]
            if sozinho:
                antes, depois = (c0, d0), (c0, d0 + 1) if d0 + 1 < 1 << 64 else (c0 + 1, 0)
            perto = min((alvo - abaixo, antes), (abaixo + r["s"] - alvo, depois))
            if perto[0] <= folga or sozinho:
                prontos[k] = perto[1]
                del situacao[k]
            elif r["c0"] == r["c1"] and intervalo.chave is None:
                situacao[k] = (_Intervalo(c0, 0, 0), abaixo)
            else:
                situacao[k] = (
                    _Intervalo(intervalo.chave, (intervalo.prefixo << _BITS) + r["p"], intervalo.bits + _BITS),
                    abaixo,
                )
    maior = ((1 << 64) - 1, (1 << 64) - 1)
    return [tuple(_com_sinal(u) for u in (p if p[0] < 1 << 64 else maior)) for _, p in sorted(prontos.items())]


def fragmenta(df: DataFrame, limites: list[tuple[int, int]]) -> DataFrame:
    """Add ``shard`` and ``slot`` (from 0, without gaps) to rows with the columns of ``com_chaves``; one exchange.

    A shard is numbered in up to 4096 pieces at once. The counts of the pieces, at most 4096 rows more than there are
    splitters, give the first slot of each.
    """
    shard = F.lit(0)
    for c, d in limites:
        direita = (F.col(CHAVE) > F.lit(c)) | ((F.col(CHAVE) == F.lit(c)) & (F.col(DESEMPATE) >= F.lit(d)))
        shard = shard + F.when(direita, 1).otherwise(0)
    pedaco = F.shiftrightunsigned(_sem_sinal(F.col(CHAVE)), 56) * 16 + F.shiftrightunsigned(
        _sem_sinal(F.col(DESEMPATE)), 60
    )
    df = df.withColumns({"shard": shard, "__pedaco": pedaco.cast("int")})
    primeiro = (
        df.groupBy("shard", "__pedaco")
        .agg(F.count("*").alias("n"))
        .select(
            "shard",
            "__pedaco",
            F.coalesce(
                F.sum("n").over(
                    Window.partitionBy("shard").orderBy("__pedaco").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("__primeiro"),
        )
    )
    ordem = Window.partitionBy("shard", "__pedaco").orderBy(CHAVE, DESEMPATE)
    return (
        df.withColumn("__n", F.row_number().over(ordem))
        .join(F.broadcast(primeiro), ["shard", "__pedaco"])
        .withColumn("slot", F.col("__primeiro") + F.col("__n") - 1)
        .drop("__n", "__primeiro", "__pedaco")
    )


def op5_fragmentos(spark: SparkSession, documentos: DataFrame, n: int = 24) -> DataFrame:
    """Shard, slot and size of every document; law ``bytes``."""
    medidas = materializa(
        com_chaves(documentos.select("doc_id", "text"))
        .withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit(""))))
        .drop("text")
    )
    return fragmenta(medidas, divisores(medidas, n)).select(
        "doc_id",
        F.col(TAMANHO).alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def grava_fragmentos(docs: DataFrame, pasta: str, n: int = 24, tolerancia: float = 0.001) -> None:
    """Write ``docs`` with all columns as one folder per shard."""
    chaves = com_chaves(docs)
    medidas = materializa(chaves.select(CHAVE, DESEMPATE, TAMANHO))
    fragmenta(chaves, divisores(medidas, n, tolerancia)).drop(CHAVE, DESEMPATE, TAMANHO).write.partitionBy(
        "shard"
    ).parquet(pasta)

"""Joins of a large side with a dimension whose size is measured before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Most that a broadcast may hold in the driver, and again in every executor.
LIMITE_BYTES = 64 << 20
SAIS = 8
#: Words of eight bytes that a broadcast's table holds for a row beside the row and its key: headers and places of pointers.
PALAVRAS_POR_LINHA = 8


def _bytes(coluna: Column, tipo: T.DataType) -> Column:
    """Bytes of a value, those of nested ones counted element by element."""
    if isinstance(tipo, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(coluna), F.lit(0)).cast("bigint") + 8
    if isinstance(tipo, T.StructType):
        partes = [_bytes(coluna.getField(c.name), c.dataType) for c in tipo.fields]
        return reduce(lambda a, b: a + b, partes, F.lit(16).cast("bigint"))
    if isinstance(tipo, T.MapType):
        pares = T.ArrayType(T.StructType([T.StructField("key", tipo.keyType), T.StructField("value", tipo.valueType)]))
        return _bytes(F.map_entries(coluna), pares)
    if isinstance(tipo, T.ArrayType):
        if isinstance(tipo.elementType, (T.NumericType, T.BooleanType, T.DatetimeType, T.TimestampNTZType)):
            return F.greatest(F.size(coluna), F.lit(0)).cast("bigint") * 8 + 24
        soma = F.aggregate(coluna, F.lit(0).cast("bigint"), lambda a, x: a + _bytes(x, tipo.elementType))
        return F.coalesce(soma, F.lit(0)).cast("bigint") + 24
    return F.lit(8).cast("bigint")


def bytes_de(df: DataFrame) -> int:
    """Bytes held by the rows of ``df``: one aggregate over it, one number to the driver."""
    linha = F.lit(16).cast("bigint")
    for campo in df.schema.fields:
        linha = linha + _bytes(F.col(f"`{campo.name}`"), campo.dataType)
    return df.agg(F.sum(linha).alias("b")).first()["b"] or 0


def bytes_difundidos(dimensao: DataFrame, chaves: Sequence[str]) -> int:
    """Bytes of the table that a broadcast makes of ``dimensao``: each row, its key once more, and pointers."""
    de_novo = [F.col(f"`{c}`").alias(f"_chave_{i}") for i, c in enumerate(chaves)]
    ponteiros = [F.lit(0).alias(f"_ponteiro_{i}") for i in range(PALAVRAS_POR_LINHA)]
    return bytes_de(dimensao.select("*", *de_novo, *ponteiros))


def junta_grandes(esquerda: DataFrame, direita: DataFrame, chaves: Sequence[str], como: str = "inner") -> DataFrame:
    """Join of two sides that both grow with the input: both are shuffled, none is broadcast.

    Without the hint the planner goes by the size of files. Rows made from a file by ``explode``, or read from a file
    that is well compressed, take up to some hundred times as much in the driver.
    """
    return esquerda.join(direita.hint("merge"), list(chaves), como)


def junta(
    grande: DataFrame,
    dimensao: DataFrame,
    chaves: Sequence[str],
    como: str = "inner",
    espalhar_por: Sequence[str] = (),
    teto_bytes: int | None = None,
    limite_bytes: int = LIMITE_BYTES,
) -> DataFrame:
    """Join ``grande`` to ``dimensao`` so that no key of the large side lands in one task.

    The dimension is broadcast when the size of its broadcast, which is measured (or ``teto_bytes``, a bound the caller
    has proved), is within ``limite_bytes``. Beyond it the join shuffles on the keys plus a salt: every
    row of the large side takes one salt from the hash of ``espalhar_por``, every dimension row is
    repeated for each salt. A hash, unlike ``rand()``, gives the same salt when a lost task reruns.
    A few salts are enough: they also keep later steps from depending on the partitioning of the
    join, which is what lets the adaptive plan cut partitions that are still too large.
    """
    chaves = list(chaves)
    tamanho = bytes_difundidos(dimensao, chaves) if teto_bytes is None else teto_bytes
    if tamanho <= limite_bytes:
        return grande.join(F.broadcast(dimensao), chaves, como)
    if not espalhar_por:
        return junta_grandes(grande, dimensao, chaves, como)
    sal = F.pmod(F.xxhash64(*espalhar_por), F.lit(SAIS)).cast("int")
    sais = F.explode(F.sequence(F.lit(0), F.lit(SAIS - 1)))
    salgada = junta_grandes(grande.withColumn("_sal", sal), dimensao.withColumn("_sal", sais), [*chaves, "_sal"], como)
    return salgada.drop("_sal")

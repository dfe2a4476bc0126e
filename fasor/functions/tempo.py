"""Time columns. Readings are naive local times, so ``timestamp_ntz`` throughout.

``date_trunc`` and ``to_timestamp`` pass through the session time zone and would move
hours around a daylight-saving change; the forms below never touch it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

FORMATO_PADRAO = "d/M/yyyy H:mm"


def le_data_hora(texto: Column, formatos: str | Sequence[str] = FORMATO_PADRAO) -> Column:
    """Text to ``timestamp_ntz``; the first format that fits wins, NULL when none does.

    Years outside 1800 to 3999 are no readings either: ``ordem_na_base`` holds times of some 2000 years around 1970.
    """
    if isinstance(formatos, str):
        formatos = [formatos]
    epoca = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def tenta(formato: str) -> Column:
        # read as UTC, then count seconds from a naive epoch: independent of the session zone
        instante = F.try_to_timestamp(F.concat(texto, F.lit(" Z")), F.lit(formato + " X"))
        return F.timestamp_add("SECOND", F.unix_seconds(instante), epoca)

    lido = F.coalesce(*[tenta(f) for f in formatos])
    return F.when(F.year(lido).between(1800, 3999), lido)


def trunca_hora(instante: Column) -> Column:
    """Floor to the whole hour."""
    meia_noite = F.to_date(instante).cast("timestamp_ntz")
    return meia_noite + F.make_dt_interval(F.lit(0), F.hour(instante))


def ordem_na_base(tabela_ordem: Column, instante: Column) -> Column:
    """(table order, time) as one bigint, so that "first row" stays a hash aggregate.

    The second of the epoch takes the low 37 bits, shifted to be positive.
    """
    segundo = (
        F.unix_date(F.to_date(instante)).cast("bigint") * 86400
        + F.hour(instante) * 3600
        + F.minute(instante) * 60
        + F.second(instante)
    )
    return F.shiftleft(tabela_ordem.cast("bigint"), 37) + segundo + F.lit(1 << 36)


def instante_da_ordem(ordem: Column) -> Column:
    """Time held in a value of ``ordem_na_base``."""
    epoca = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    segundo = ordem.bitwiseAND(F.lit((1 << 37) - 1)) - F.lit(1 << 36)
    return F.timestamp_add("SECOND", segundo, epoca)


def tabela_da_ordem(ordem: Column) -> Column:
    """Table order held in a value of ``ordem_na_base``."""
    return F.shiftright(ordem, 37).cast("int")

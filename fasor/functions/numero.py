"""Number columns: decimal-comma text and half-to-even rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as a number. Spark's cast alone would also take '1.5d', '0x1p3', 'NaN' or
# 'Infinity', and is slow on text it rejects. The quantifiers
# never give back, so the time is linear in the length of a field.
NUMERO = r"[ \t]*+[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[ \t]*+"


def numero_ou_nulo(texto: Column) -> Column:
    """Text with a decimal point to double; NULL when it is not a number."""
    return F.when(texto.rlike(f"^{NUMERO}$"), texto.try_cast("double"))


def numero_br(texto: Column) -> Column:
    """Text with a decimal comma to double; blank, missing or unreadable cells count as 0."""
    return F.coalesce(numero_ou_nulo(F.replace(texto, F.lit(","), F.lit("."))), F.lit(0.0))


def numeros_br(linha: Column, separador: str = ";") -> Column:
    """``numero_br`` of every field of a line, as ``array<double>``.

    One replacement per line turns each field that is not a number into 0, so that one cast
    converts the whole array and no field makes it fail.
    """
    com_ponto = F.replace(linha, F.lit(","), F.lit("."))
    so_numeros = F.regexp_replace(
        com_ponto, f"(^|{separador})(?!{NUMERO}(?:{separador}|$))[^{separador}]*", "$10"
    )
    return F.split(so_numeros, separador, -1).try_cast("array<double>")


def arredonda(valor: Column, casas: int = 0) -> Column:
    """Round the scaled binary value half to even (``round`` and ``bround`` work on decimals)."""
    if casas == 0:
        return F.rint(valor)
    fator = F.lit(float(10**casas))
    return F.rint(valor * fator) / fator

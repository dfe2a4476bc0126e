"""Electrical quantities under the three missing-value policies.

``U`` (single equipment): a missing reading makes the result missing.
``C`` (coincident): missing P or Q counts as 0, S = 0 counts as missing, missing power factor is 0.
``S`` (composition): a missing reading makes the result missing, the power factor at S = 0 is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POLITICAS = ("U", "C", "S")


def _confere(politica: str) -> None:
    if politica not in POLITICAS:
        raise ValueError(f"politica must be one of {POLITICAS}, got {politica!r}")


def _saldo(entregue: Column, recebida: Column, politica: str) -> Column:
    _confere(politica)
    saldo = entregue - recebida
    return F.coalesce(saldo, F.lit(0.0)) if politica == "C" else saldo


def potencia_ativa(eae: Column, ear: Column, politica: str = "U") -> Column:
    """P = EAE - EAR."""
    return _saldo(eae, ear, politica)


def potencia_reativa(ere: Column, err: Column, politica: str = "U") -> Column:
    """Q = ERE - ERR."""
    return _saldo(ere, err, politica)


def potencia_aparente(p: Column, q: Column, politica: str = "U") -> Column:
    """S = sqrt(P^2 + Q^2)."""
    _confere(politica)
    s = F.sqrt(p * p + q * q)
    return F.nullif(s, F.lit(0.0)) if politica == "C" else s


def fator_potencia(p: Column, s: Column, politica: str = "U") -> Column:
    """fp = P / S."""
    _confere(politica)
    fp = F.try_divide(p, s)
    if politica == "C":
        return F.coalesce(fp, F.lit(0.0))
    if politica == "S":
        return F.when(s == 0, F.lit(0.0)).otherwise(fp)
    return fp


def ultrapassagem(s: Column, potencia_instalada: Column) -> Column:
    """1 when S reaches the installed power, else 0; a missing S counts as 0."""
    acima = F.when(potencia_instalada == 0, s > 0).otherwise(
        F.try_divide(s, potencia_instalada) >= 1.0
    )
    return F.coalesce(acima.cast("int"), F.lit(0))

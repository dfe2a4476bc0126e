"""Demand of many equipments at one instant."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from fasor.operators.base import base_horaria, com_potencias, com_valores, no_instante, tabelas_elegiveis
from fasor.operators.materializa import materializa

# Headings of the delivered table.
TITULOS = {
    "codigo": "Equipamento",
    "data_hora": "Data/Hora",
    "p": "Potência Ativa (kW)",
    "q": "Potência Reativa (kvar)",
    "s": "Potência Aparente (kVA)",
    "fp": "FP",
}


def linhas_no_instante(
    medicoes: DataFrame, presenca: DataFrame, catalogo: DataFrame, resolvidos: DataFrame, instante: datetime
) -> DataFrame:
    """Rows of the instant from tables in which the EAE column has a value at some hour.

    ``presenca`` (see ``carga.presenca``), kept by the load, tells which tables these are; only the rows of the instant
    are read.
    """
    elegiveis = com_valores(tabelas_elegiveis(catalogo, resolvidos, caso="sensivel"), presenca)
    return base_horaria(no_instante(medicoes, instante), materializa(elegiveis.drop("horas_com_dado")))


def demanda_coincidente(
    medicoes: DataFrame, presenca: DataFrame, catalogo: DataFrame, resolvidos: DataFrame, instante: datetime
) -> DataFrame:
    """One row per equipment with data at the instant.

    With several tables the maxima of P, Q, S and power factor are taken independently.
    """
    linhas = com_potencias(
        linhas_no_instante(medicoes, presenca, catalogo, resolvidos, instante), politica="C"
    )
    return linhas.groupBy("codigo", "data_hora").agg(
        *[F.max(c).alias(c) for c in ("p", "q", "s", "fp")]
    )


def com_titulos(resultado: DataFrame) -> DataFrame:
    """The delivered table: columns in order, with their headings."""
    return resultado.select(*[F.col(c).alias(t) for c, t in TITULOS.items()])

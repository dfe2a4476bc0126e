"""Series, daily curves, the monthly report and the curve export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fasor.functions.numero import numero_ou_nulo
from fasor.functions.texto import codigo_relatorio

# First word of a month column in the monthly report.
MESES = (
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
)


def serie(demanda: DataFrame) -> DataFrame:
    """The plotted series."""
    return demanda.select("codigo", "data_hora", "p", "q", "s")


def curva_diaria(demanda: DataFrame) -> DataFrame:
    """Points of the daily curves. ``mes`` keeps equal day numbers of different months apart."""
    return demanda.select(
        "codigo",
        F.month("data_hora").alias("mes"),
        F.dayofmonth("data_hora").alias("dia"),
        F.hour("data_hora").alias("hora"),
        "p",
    )


def dias_presentes(demanda: DataFrame) -> DataFrame:
    return demanda.select("codigo", F.dayofmonth("data_hora").alias("dia")).distinct()


def colunas_de_mes(colunas: Sequence[str]) -> list[str]:
    return [c for c in colunas if c.split() and c.split()[0] in MESES]


def demanda_mensal(maximas: DataFrame, codigos: DataFrame) -> DataFrame:
    """Monthly maxima of the requested equipments, one row per month; unreadable cells are NULL.

    ``maximas(descricao, codigo, <month columns>)`` carries report codes.
    """
    meses = colunas_de_mes(maximas.columns)
    pedidos = codigos.dropna().distinct().select(codigo_relatorio(F.col("codigo")).alias("codigo"))
    numericas = maximas.join(pedidos, "codigo", "left_semi").select(
        "descricao", "codigo", *[numero_ou_nulo(F.col(f"`{m}`").cast("string")).alias(m) for m in meses]
    )
    return numericas.unpivot(["descricao", "codigo"], meses, "mes", "valor")


def curva_para_exportar(demanda: DataFrame) -> DataFrame:
    """Columns of the curve export, in file order; the time comes first."""
    nomes = {
        "data_hora": "Data_Hora",
        "eae": "descricao",
        "ear": "descricao_saida",
        "ere": "descricao_Q",
        "err": "descricao_saida_Q",
        "tabela_origem": "tabela_origem",
        "p": "P",
        "q": "PQ",
    }
    return demanda.select("codigo", *[F.col(de).alias(para) for de, para in nomes.items()])

"""Signed sums of the demand of several equipments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fasor.functions import eletrica
from fasor.operators.base import POSICOES, primeira_tabela
from fasor.operators.blocos import leituras
from fasor.operators.cadastro import LUGARES, canais
from fasor.operators.juncao import junta
from fasor.operators.materializa import materializa

OPERADORES = ("Somar", "Subtrair")


def composicao_spec(formulas: DataFrame) -> DataFrame:
    """Signed terms ``(formula, ordem, codigo, sinal)`` of ``(formula, ordem, codigo, operador)``.

    The first slot counts positive whatever its operator, empty slots drop out, and the same
    equipment may occur more than once.
    """
    subtrai = (F.col("ordem") > 1) & F.col("operador").eqNullSafe(F.lit("Subtrair"))
    return formulas.filter(F.coalesce("codigo", F.lit("")) != "").select(
        "formula", "ordem", "codigo", F.when(subtrai, -1.0).otherwise(1.0).alias("sinal")
    )


def canais_lenientes(codigos: DataFrame, medidores: DataFrame) -> DataFrame:
    """Channels with ``ausente``: 1 where the dictionary lacks the code, which then counts as 0."""
    dicionario = medidores.select(F.col("codigo").alias("canal"), "descricao")
    return (
        canais(codigos)
        .join(dicionario, "canal", "left")
        .withColumn("ausente", F.col("descricao").isNull().cast("int"))
    )


def base_leniente(medicoes: DataFrame, lugares: DataFrame) -> DataFrame:
    """Hourly readings of tables with at least one channel of the equipment (``lugares``).

    A channel without a column counts as 0; a missing value in an existing column stays missing.
    """
    if "bloco" in medicoes.columns:
        return primeira_tabela(leituras(medicoes, lugares, sem_canal=F.lit(0.0)).drop("tabela"))
    lidas = junta(medicoes, lugares, ["tabela"], espalhar_por=["data_hora"]).select(
        "codigo",
        "data_hora",
        "tabela_ordem",
        *[
            F.when(F.col(p).isNull(), 0.0).otherwise(F.get("valores", F.col(p))).alias(l)
            for l, p in zip(LUGARES, POSICOES)
        ],
    )
    return primeira_tabela(lidas)


def demanda_composta(medicoes: DataFrame, lugares: DataFrame, termos: DataFrame) -> DataFrame:
    """Hourly totals per formula: P and Q by sign, S and power factor of the totals.

    A term with a missing reading, or without a row at an hour that other terms have, makes the
    total of that hour missing. Equipments with no measurement column anywhere (not in
    ``lugares``, see ``base.lugares_nas_tabelas``) add 0 and are not counted. Sums combine before the shuffle, so a formula may have any number of terms.
    """
    # the same equipment in two slots adds its signs up
    pesos = materializa(termos.groupBy("formula", "codigo").agg(F.sum("sinal").alias("peso")))
    dos_termos = materializa(lugares.join(pesos, "codigo", "left_semi"))
    n_termos = (
        pesos.join(dos_termos, "codigo", "left_semi")
        .groupBy("formula")
        .agg(F.count(F.lit(1)).alias("n_termos"))
    )
    p = eletrica.potencia_ativa(F.col("eae"), F.col("ear"), "S")
    q = eletrica.potencia_reativa(F.col("ere"), F.col("err"), "S")
    parcelas = junta(base_leniente(medicoes, dos_termos), pesos, ["codigo"], espalhar_por=["data_hora"]).select(
        "formula", "data_hora", (F.col("peso") * p).alias("p"), (F.col("peso") * q).alias("q")
    )
    somas = parcelas.groupBy("formula", "data_hora").agg(
        F.sum("p").alias("p"),
        F.count("p").alias("n_p"),
        F.sum("q").alias("q"),
        F.count("q").alias("n_q"),
    )
    totais = junta(somas, n_termos, ["formula"], espalhar_por=["data_hora"]).select(
        "formula",
        "data_hora",
        F.when(F.col("n_p") == F.col("n_termos"), F.col("p")).alias("p"),
        F.when(F.col("n_q") == F.col("n_termos"), F.col("q")).alias("q"),
    )
    s = eletrica.potencia_aparente(F.col("p"), F.col("q"), "S")
    return totais.withColumn("s", s).withColumn(
        "fp", eletrica.fator_potencia(F.col("p"), F.col("s"), "S")
    )

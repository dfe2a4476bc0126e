"""The hourly base: which table serves which equipment, and the readings it gives."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from fasor.functions import eletrica
from fasor.operators.blocos import CASAS, leituras
from fasor.operators.cadastro import LUGARES, potencia_instalada
from fasor.operators.juncao import junta, junta_grandes
from fasor.operators.materializa import materializa

POSICOES = tuple(f"pos_{lugar}" for lugar in LUGARES)


def _canais_em_linhas(resolvidos: DataFrame) -> DataFrame:
    pares = F.array(
        *[F.struct(F.lit(l).alias("lugar"), F.col(l).alias("descricao")) for l in LUGARES]
    )
    return (
        resolvidos.select("codigo", F.explode(pares).alias("par"))
        .select("codigo", "par.lugar", "par.descricao")
        .filter(F.col("descricao").isNotNull())
    )


def lugares_nas_tabelas(catalogo: DataFrame, resolvidos: DataFrame, caso: str = "insensivel") -> DataFrame:
    """Place of each channel in each table that has at least one of them.

    ``(codigo, tabela, tabela_ordem, pos_eae, pos_ear, pos_ere, pos_err)``; of a stored catalogue also where the channels
    lie in blocks (``casa_eae`` ...), and whether these blocks have every hour of the table (``completo``).
    """
    if caso not in ("insensivel", "sensivel"):
        raise ValueError(f"caso must be 'insensivel' or 'sensivel', got {caso!r}")

    def chave(nome: str):
        return F.lower(nome) if caso == "insensivel" else F.col(nome)

    guardado = ["casa", "inteiro"] if "casa" in catalogo.columns else []
    colunas = catalogo.select("tabela", "tabela_ordem", "pos", *guardado, chave("descricao").alias("_chave"))
    pedidos = _canais_em_linhas(resolvidos).select(
        "codigo", "lugar", chave("descricao").alias("_chave")
    )
    return (
        junta_grandes(colunas, pedidos, ["_chave"])
        .groupBy("codigo", "tabela", "tabela_ordem")
        .agg(
            *[
                F.min(F.when(F.col("lugar") == l, F.col("pos"))).alias(p)
                for l, p in zip(LUGARES, POSICOES)
            ],
            *(
                [
                    *[F.min_by("casa", F.when(F.col("lugar") == l, F.col("pos"))).alias(c) for l, c in zip(LUGARES, CASAS)],
                    F.min("inteiro").alias("completo"),
                ]
                if guardado
                else []
            ),
        )
    )


def dos_codigos(df: DataFrame, codigos: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen equipments; all if none are chosen."""
    return df if codigos is None else df.filter(F.col("codigo").isin(list(codigos)))


def tabelas_elegiveis(catalogo: DataFrame, resolvidos: DataFrame, caso: str = "insensivel") -> DataFrame:
    """Tables that have all four columns of an equipment."""
    return lugares_nas_tabelas(catalogo, resolvidos, caso).dropna(subset=list(POSICOES))


def base_horaria(
    medicoes: DataFrame, elegiveis: DataFrame, teto_bytes: int | None = None
) -> DataFrame:
    """Every row of every eligible table, per equipment; all tables in one plan.

    The data-dependent column of the source is a place in ``valores``, so this is one map-side
    join on the table and four array reads, without any shuffle of the measurements. Of stored
    blocks it is a join on table and block (see ``blocos.leituras``).
    """
    if "bloco" in medicoes.columns:
        return leituras(medicoes, elegiveis, teto_bytes=teto_bytes).select(
            "codigo", "data_hora", F.col("tabela").alias("tabela_origem"), "tabela_ordem", *LUGARES
        )
    return junta(
        medicoes, elegiveis, ["tabela"], espalhar_por=["data_hora"], teto_bytes=teto_bytes
    ).select(
        "codigo",
        "data_hora",
        F.col("tabela").alias("tabela_origem"),
        "tabela_ordem",
        *[F.get("valores", F.col(p)).alias(l) for l, p in zip(LUGARES, POSICOES)],
    )


def com_valores(elegiveis: DataFrame, presenca: DataFrame) -> DataFrame:
    """Eligible tables in which the EAE column of the equipment has at least one value, and ``horas_com_dado``."""
    horas = presenca.select("tabela", F.col("pos").alias("pos_eae"), F.col("n").alias("horas_com_dado"))
    return elegiveis.join(horas, ["tabela", "pos_eae"]).filter("horas_com_dado > 0")


def tabelas_com_dados(elegiveis: DataFrame, presenca: DataFrame) -> DataFrame:
    """Tables with data per equipment, from the counts that the load keeps: no measurement is read."""
    return com_valores(elegiveis, presenca).select(
        "codigo", F.col("tabela").alias("tabela_origem"), "horas_com_dado"
    )


def primeira_tabela(base: DataFrame, valores: Sequence[str] = LUGARES) -> DataFrame:
    """One row per equipment and hour: the first table wins, even with missing values.

    ``min_by`` over the table number keeps this a hash aggregate; the name of the table is left to
    ``com_tabela``, as text in the buffer would force a sort. The one shuffle is by equipment and
    day: hours of a day stay together, so later sums per equipment combine them before their own
    shuffle, while an equipment with a large share of all rows still spreads over its days.
    """
    por_dia = base.withColumn("_dia", F.to_date("data_hora")).repartition("codigo", "_dia")
    return (
        por_dia.groupBy("codigo", "_dia", "data_hora")
        .agg(
            F.min("tabela_ordem").alias("tabela_ordem"),
            *[F.min_by(v, "tabela_ordem").alias(v) for v in valores],
        )
        .drop("_dia")
    )


def com_tabela(df: DataFrame, tabelas: DataFrame) -> DataFrame:
    """Name of the source table, from its number."""
    nomes = tabelas.select("tabela_ordem", F.col("tabela").alias("tabela_origem")).distinct()
    return junta(df, nomes, ["tabela_ordem"], espalhar_por=["data_hora"])


def com_potencias(base: DataFrame, politica: str = "U") -> DataFrame:
    """Add P, Q, S and power factor."""
    return (
        base.withColumn("p", eletrica.potencia_ativa(F.col("eae"), F.col("ear"), politica))
        .withColumn("q", eletrica.potencia_reativa(F.col("ere"), F.col("err"), politica))
        .withColumn("s", eletrica.potencia_aparente(F.col("p"), F.col("q"), politica))
        .withColumn("fp", eletrica.fator_potencia(F.col("p"), F.col("s"), politica))
    )


def base_unica(medicoes: DataFrame, elegiveis: DataFrame) -> DataFrame:
    """One row per equipment and hour, straight from the measurements.

    Only an equipment that several tables serve can have an hour twice; the rows of the others need no shuffle.
    ``elegiveis`` tells before any scan.
    """
    tabelas = F.count(F.lit(1)).over(Window.partitionBy("codigo"))
    contados = materializa(elegiveis.withColumn("_tabelas", tabelas))
    uma, varias = contados.filter("_tabelas = 1"), contados.filter("_tabelas > 1")
    colunas = ["codigo", "data_hora", "tabela_ordem", *LUGARES]
    if uma.isEmpty():
        return primeira_tabela(base_horaria(medicoes, varias)).select(*colunas)
    direta = base_horaria(medicoes, uma).select(*colunas)
    if varias.isEmpty():
        return direta
    return direta.unionByName(primeira_tabela(base_horaria(medicoes, varias)).select(*colunas))


def demanda(medicoes: DataFrame, elegiveis: DataFrame, equipamentos: DataFrame) -> DataFrame:
    """Hourly demand of every equipment that has an eligible table and installed power."""
    return _demanda(base_unica(medicoes, elegiveis), equipamentos)


def demanda_horaria(base: DataFrame, equipamentos: DataFrame) -> DataFrame:
    """Hourly demand of every registered equipment, from rows of any number of tables.

    Equipments without installed power show no demand (see ``sem_dados``).
    """
    return _demanda(primeira_tabela(base), equipamentos)


def _demanda(unica: DataFrame, equipamentos: DataFrame) -> DataFrame:
    potencias = potencia_instalada(equipamentos).filter(F.col("potencia_instalada").isNotNull())
    return junta(com_potencias(unica), potencias, ["codigo"], espalhar_por=["data_hora"]).withColumn(
        "ultrapassagem", eletrica.ultrapassagem(F.col("s"), F.col("potencia_instalada"))
    )


def no_instante(df: DataFrame, instante: datetime) -> DataFrame:
    """Rows of one hour. Of a stored base only the month's files and in them the day's pages are read."""
    if (instante.minute, instante.second, instante.microsecond) != (0, 0, 0):
        raise ValueError("the instant must be a whole hour")
    if {"ano", "mes"} <= set(df.columns):
        df = df.filter((F.col("ano") == instante.year) & (F.col("mes") == instante.month))
    if "dia" in df.columns:
        df = df.filter(F.col("dia") == instante.day)
    return df.filter(F.col("data_hora") == F.lit(instante.isoformat(" ")).cast("timestamp_ntz"))


def no_periodo(df: DataFrame, ano: int, mes: int | None = None) -> DataFrame:
    """Rows of one month, or of the whole year. The range on the time reaches the Parquet scan."""
    inicio = datetime(ano, mes or 1, 1)
    fim = datetime(ano + 1, 1, 1) if mes in (None, 12) else datetime(ano, mes + 1, 1)
    if {"ano", "mes"} <= set(df.columns):
        df = df.filter(F.col("ano") == ano)
        df = df if mes is None else df.filter(F.col("mes") == mes)
    coluna = F.col("data_hora")
    return df.filter(
        (coluna >= F.lit(inicio.isoformat(" ")).cast("timestamp_ntz"))
        & (coluna < F.lit(fim.isoformat(" ")).cast("timestamp_ntz"))
    )


def sem_dados(
    codigos: DataFrame,
    resolvidos: DataFrame,
    resultado: DataFrame,
    equipamentos: DataFrame | None = None,
) -> DataFrame:
    """Requested equipments that are not in ``resultado``, each with the first reason that applies.

    The installed power is a reason only where ``equipamentos`` is given: the coincident table
    does not need it.
    """
    faltantes = codigos.select("codigo").dropna().distinct().join(
        resultado.select("codigo").distinct(), "codigo", "left_anti"
    )
    canais_ok = resolvidos.select(
        "codigo",
        F.expr(" AND ".join(f"{c} IS NOT NULL" for c in LUGARES)).alias("_canais"),
    )
    pedidos = faltantes.join(canais_ok, "codigo", "left")
    motivo = F.when(~F.coalesce("_canais", F.lit(False)), "canal_sem_cadastro")
    if equipamentos is not None:
        potencias = potencia_instalada(equipamentos).select(
            "codigo", F.col("potencia_instalada").isNotNull().alias("_potencia")
        )
        pedidos = pedidos.join(potencias, "codigo", "left")
        motivo = motivo.when(~F.coalesce("_potencia", F.lit(False)), "sem_potencia_instalada")
    return pedidos.select("codigo", motivo.otherwise("sem_medicao").alias("motivo"))

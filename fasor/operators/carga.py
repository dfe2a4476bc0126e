"""Catalogue growth, upsert and integrity checks of the measurement tables.

``medicoes(tabela, data_hora, valores array<double>)`` holds one row per table and hour.
``catalogo(tabela, tabela_ordem, pos, descricao, descricao_norm, tipo)`` names the places of
``valores``. New channels take the next place, so old rows need no rewrite: a place beyond the end
of their array reads as NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fasor.functions.texto import normaliza_nome
from fasor.operators.juncao import junta
from fasor.operators.materializa import materializa

ESQUEMA_CATALOGO = (
    "tabela string, tabela_ordem int, pos int, descricao string, descricao_norm string, tipo string"
)


def com_chave_normalizada(catalogo: DataFrame) -> DataFrame:
    return catalogo.withColumn("descricao_norm", normaliza_nome(F.col("descricao")))


def colunas_novas(colunas: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Delivered channels that the table does not know under any spelling; first spelling wins."""
    primeira = F.min(F.struct("arquivo", "indice", "descricao"))
    return (
        colunas.groupBy("tabela", "descricao_norm")
        .agg(primeira.alias("p"))
        .join(catalogo.select("tabela", "descricao_norm"), ["tabela", "descricao_norm"], "left_anti")
        .select("tabela", "descricao_norm", "p.arquivo", "p.indice", "p.descricao")
    )


def confere_lugares(catalogo: DataFrame) -> None:
    """Raise ValueError if the places of some table are not 0, 1, 2, ...: values would be read from wrong ones."""
    ruins = (
        catalogo.groupBy("tabela")
        .agg(F.min("pos").alias("a"), F.max("pos").alias("z"), F.count_distinct("pos").alias("n"), F.count("*").alias("m"))
        .filter("a <> 0 OR n <> z + 1 OR n <> m")
        .select("tabela")
        .take(3)
    )
    if ruins:
        raise ValueError(f"the catalogue has gaps or repeated places, in {[r[0] for r in ruins]}")


def presenca(medicoes: DataFrame, por: Sequence[str] = ()) -> DataFrame:
    """Number of values in every place of every table: ``(tabela, pos, n, *por)``."""
    return (
        medicoes.select("tabela", *por, F.posexplode("valores").alias("pos", "valor"))
        .filter(F.col("valor").isNotNull())
        .groupBy("tabela", "pos", *por)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("tabela", "pos", "n", *por)
    )


def cresce_catalogo(catalogo: DataFrame, colunas: DataFrame) -> DataFrame:
    """Catalogue after a load: known channels keep their place, new ones follow in load order.

    Tables are numbered in the order of their first load. The window runs over the new header names of one table.
    """
    novas = colunas_novas(colunas, catalogo)
    conhecidas = catalogo.groupBy("tabela").agg(
        F.max("tabela_ordem").alias("ordem_conhecida"), (F.max("pos") + 1).alias("proxima")
    )
    livre = catalogo.agg(F.coalesce(F.max("tabela_ordem") + 1, F.lit(0))).first()[0]
    por_chegada = (
        novas.groupBy("tabela")
        .agg(F.min("arquivo").alias("arquivo"))
        .join(conhecidas, "tabela", "left_anti")
    )
    tabelas_novas = _numera(por_chegada, ["arquivo", "tabela"], "ordem_nova", livre).select("tabela", "ordem_nova")
    na_tabela = Window.partitionBy("tabela").orderBy("arquivo", "indice")
    numeradas = (
        novas.join(conhecidas, "tabela", "left")
        .join(tabelas_novas, "tabela", "left")
        .select(
            "tabela",
            F.coalesce("ordem_conhecida", "ordem_nova").alias("tabela_ordem"),
            (F.coalesce("proxima", F.lit(0)) + F.row_number().over(na_tabela) - 1)
            .cast("int")
            .alias("pos"),
            "descricao",
            "descricao_norm",
            F.lit("REAL").alias("tipo"),
        )
    )
    return catalogo.unionByName(numeradas)


def _numera(df: DataFrame, ordem: Sequence[str], nome: str, primeiro: int) -> DataFrame:
    """Number the rows in order, without bringing them into one task: rows per sorted partition, then within each."""
    ordenado = materializa(df.repartitionByRange(*ordem).withColumn("_parte", F.spark_partition_id()))
    antes = Window.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    inicios = ordenado.groupBy("_parte").count().select(
        "_parte", F.coalesce(F.sum("count").over(antes), F.lit(0)).alias("_antes")
    )
    na_parte = Window.partitionBy("_parte").orderBy(*ordem)
    return (
        ordenado.join(F.broadcast(inicios), "_parte")
        .withColumn(nome, (F.col("_antes") + F.row_number().over(na_parte) - 1 + primeiro).cast("int"))
        .drop("_parte", "_antes")
    )


def alinha(largas: DataFrame, colunas: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Put the values of each file in the places of its table.

    ``(arquivo, tabela, data_hora, valores)``; channels that the file lacks are NULL.
    """
    alvos = colunas.select("arquivo", "tabela").distinct()
    lugares = (
        alvos.join(catalogo.select("tabela", "descricao_norm", "pos"), "tabela")
        .join(
            colunas.select("arquivo", "tabela", "descricao_norm", "indice"),
            ["arquivo", "tabela", "descricao_norm"],
            "left",
        )
        .groupBy("arquivo", "tabela")
        .agg(F.max("pos").alias("ultimo"), F.map_from_entries(F.collect_list(F.struct("pos", "indice"))).alias("de"))
        .select(
            "arquivo",
            "tabela",
            F.transform(F.sequence(F.lit(0), "ultimo"), lambda pos: F.try_element_at("de", pos)).alias("mapa"),
        )
    )
    return junta(largas, lugares, ["arquivo"], espalhar_por=["data_hora"]).select(
        "arquivo",
        "tabela",
        "data_hora",
        F.transform("mapa", lambda i: F.get("valores", i)).alias("valores"),
    )


def _chave(linhas: DataFrame) -> list[str]:
    return ["tabela", *(["bloco"] if "bloco" in linhas.columns else []), "data_hora"]


def sobrepoe(linhas: DataFrame, modo: str = "linha") -> DataFrame:
    """One row per table and hour (and block, if there is one) out of ``(tabela, data_hora, valores, arquivo)``.

    ``modo='linha'``: the last file replaces the whole row, channels it lacks become NULL.
    ``modo='celula'``: the last file that has the channel gives its value.
    Rows already stored carry an empty ``arquivo``, which sorts before every file.
    """
    chave = _chave(linhas)
    if modo == "linha":
        return linhas.groupBy(*chave).agg(F.max_by("valores", "arquivo").alias("valores"))
    if modo != "celula":
        raise ValueError(f"modo must be 'linha' or 'celula', got {modo!r}")
    celulas = linhas.select(*chave, "arquivo", F.posexplode("valores").alias("pos", "valor"))
    presente = F.when(F.col("valor").isNotNull(), F.col("arquivo"))
    ultimas = celulas.groupBy(*chave, "pos").agg(
        F.max_by("valor", presente).alias("valor")
    )
    return ultimas.groupBy(*chave).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "valor"))), lambda c: c["valor"]
        ).alias("valores")
    )


def upsert(atuais: DataFrame, novas: DataFrame, modo: str = "linha") -> DataFrame:
    """Stored rows ``(tabela, data_hora, valores)`` after loading ``novas`` (with ``arquivo``). Both may be in blocks."""
    chave = _chave(novas)
    antigas = atuais.select(*chave, "valores", F.lit("").alias("arquivo"))
    return sobrepoe(antigas.unionByName(novas.select(*chave, "valores", "arquivo")), modo)


def celulas_nomeadas(medicoes: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Long view ``(tabela, data_hora, descricao, valor)``, one row per row and known channel."""
    nomes = catalogo.select("tabela", "pos", "descricao")
    return junta(medicoes, nomes, ["tabela"], espalhar_por=["data_hora"]).select(
        "tabela", "data_hora", "descricao", F.get("valores", F.col("pos")).alias("valor")
    )


def chaves_duplicadas(linhas: DataFrame) -> DataFrame:
    """Keys that occur more than once."""
    return (
        linhas.groupBy(*_chave(linhas))
        .agg(F.count(F.lit(1)).alias("ocorrencias"))
        .filter(F.col("ocorrencias") > 1)
    )


def colunas_da_tabela(catalogo: DataFrame) -> DataFrame:
    """Every column of every table, in order: ``(tabela, pos, descricao, tipo)``, time first."""
    tempo = catalogo.select("tabela").distinct().select(
        "tabela",
        F.lit(0).alias("pos"),
        F.lit("Data_Hora").alias("descricao"),
        F.lit("DATETIME").alias("tipo"),
    )
    return tempo.unionByName(
        catalogo.select("tabela", (F.col("pos") + 1).alias("pos"), "descricao", "tipo")
    )


def diagnostico_colunas(catalogo: DataFrame) -> DataFrame:
    """Per table: number of columns, the time included, and of names that repeat once normalised."""
    por_nome = catalogo.groupBy("tabela", "descricao_norm").agg(F.count(F.lit(1)).alias("n"))
    return por_nome.groupBy("tabela").agg(
        (F.sum("n") + 1).alias("n_colunas"),
        F.sum((F.col("n") > 1).cast("bigint")).alias("n_repetidas"),
    )

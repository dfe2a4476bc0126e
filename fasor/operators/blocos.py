"""Measurements cut into blocks of channels: a row per table, block of 16 places and hour.

A table may have a thousand channels of which an equipment needs four. Stored rows therefore hold 16 places each:
``blocos(tabela, bloco, data_hora, valores array<double>)``, and the catalogue says where a channel lies: its ``casa`` is
16 times the block plus the place in it. The four quantities of a meter get four neighbouring places that never cross
the border of a block, also if they arrive in different loads, so an equipment reads one block.

A row that is loaded has all blocks that its table has by then. So the blocks of a table's first load have every hour of
the table; ``inteiro`` in the catalogue says so. Later blocks lack the older hours, which then count as rows without
values, exactly as a new column of a wide table would read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fasor.operators.cadastro import LUGARES
from fasor.operators.juncao import junta

POR_BLOCO = 16
#: Hash classes of tables within a month of a stored base. Fixed for the life of a base.
CLASSES = 16
#: Blocks that a query names one by one for the scan to skip all others; beyond so many the join alone decides.
MAX_BLOCOS_NOMEADOS = 2000

CASAS = tuple(f"casa_{lugar}" for lugar in LUGARES)
_GRANDEZA = f"^(.+)({'|'.join(LUGARES)})$"


def classe_da_tabela(tabela: Column | str) -> Column:
    return F.pmod(F.xxhash64(tabela), F.lit(CLASSES)).cast("int")


def _bloco(casa: Column | str) -> Column:
    return F.floor(F.col(casa) / POR_BLOCO if isinstance(casa, str) else casa / POR_BLOCO).cast("int")


def com_casas(depois: DataFrame, antes: DataFrame) -> DataFrame:
    """The catalogue ``depois`` with ``casa`` and ``inteiro``; channels that ``antes`` has keep theirs.

    A meter is what names share before the quantity. A new meter takes the next four places that start at a multiple of
    four, other channels follow one by one. The windows run over the new header names of one table.
    """
    norma = F.lower("descricao_norm")
    medidor = F.nullif(F.regexp_extract(norma, _GRANDEZA, 1), F.lit(""))
    grandeza = F.array_position(F.array(*[F.lit(l) for l in LUGARES]), F.regexp_extract(norma, _GRANDEZA, 2)).cast("int") - 1
    conhecidas = antes.select("tabela", "pos", "casa", "inteiro", medidor.alias("_medidor"), grandeza.alias("_grandeza"))
    dos_medidores = (
        conhecidas.filter("_medidor IS NOT NULL")
        .groupBy("tabela", "_medidor")
        .agg(F.min(F.col("casa") - F.col("_grandeza")).alias("_conhecido"))
    )
    # four places stay free for every meter, so the next free place follows the last meter's fourth
    usada = F.when(F.col("_medidor").isNull(), F.col("casa")).otherwise(F.col("casa") - F.col("_grandeza") + 3)
    das_tabelas = conhecidas.groupBy("tabela").agg((F.ceil((F.max(usada) + 1) / 4) * 4).cast("int").alias("_livre"))
    dos_blocos = conhecidas.groupBy("tabela", _bloco("casa").alias("_bloco")).agg(F.max("inteiro").alias("_inteiro"))

    novas = (
        depois.join(conhecidas.select("tabela", "pos"), ["tabela", "pos"], "left_anti")
        .withColumns({"_medidor": medidor, "_grandeza": grandeza})
        .join(dos_medidores, ["tabela", "_medidor"], "left")
        .join(das_tabelas, "tabela", "left")
    )
    tabela = Window.partitionBy("tabela")
    novo_medidor = F.col("_medidor").isNotNull() & F.col("_conhecido").isNull()
    primeiro = F.min("pos").over(Window.partitionBy("tabela", "_medidor"))
    numerado = (
        novas.withColumn("_primeiro", F.when(novo_medidor, primeiro))
        .withColumn("_ordem", F.when(novo_medidor, F.dense_rank().over(tabela.orderBy(F.asc_nulls_last("_primeiro"))) - 1))
        .withColumn("_medidores", F.coalesce(F.max("_ordem").over(tabela) + 1, F.lit(0)))
        .withColumn("_so", F.row_number().over(tabela.orderBy(F.col("_medidor").isNotNull(), "pos")) - 1)
    )
    livre = F.coalesce("_livre", F.lit(0))
    casa = (
        F.when(F.col("_medidor").isNull(), livre + 4 * F.col("_medidores") + F.col("_so"))
        .when(novo_medidor, livre + 4 * F.col("_ordem") + F.col("_grandeza"))
        .otherwise(F.col("_conhecido") + F.col("_grandeza"))
    )
    colocadas = (
        numerado.withColumn("casa", casa.cast("int"))
        .withColumn("_bloco", _bloco("casa"))
        .join(dos_blocos, ["tabela", "_bloco"], "left")
        .withColumn("inteiro", F.coalesce("_inteiro", F.col("_livre").isNull()))
    )
    return antes.select(*depois.columns, "casa", "inteiro").unionByName(colocadas.select(*depois.columns, "casa", "inteiro"))


def em_blocos(largas: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Rows of ``(tabela, data_hora, valores, ...)`` with one value a channel, cut into blocks; other columns are kept."""
    lugar = F.struct((F.col("casa") % POR_BLOCO).alias("lugar"), "pos")
    dos_blocos = catalogo.groupBy("tabela", _bloco("casa").alias("bloco")).agg(
        F.map_from_entries(F.collect_list(lugar)).alias("pos"), F.max(F.col("casa") % POR_BLOCO).alias("ultimo")
    )  # at most 16 places
    das_tabelas = dos_blocos.groupBy("tabela").agg(
        F.collect_list(
            F.struct("bloco", F.transform(F.sequence(F.lit(0), "ultimo"), lambda l: F.try_element_at("pos", l)).alias("de"))
        ).alias("_blocos")
    )
    outras = [c for c in largas.columns if c not in ("tabela", "valores")]
    return (
        junta(largas, das_tabelas, ["tabela"], espalhar_por=["data_hora"])
        .select("tabela", *outras, "valores", F.explode("_blocos").alias("_b"))
        .select(
            "tabela",
            F.col("_b.bloco").alias("bloco"),
            *outras,
            F.transform("_b.de", lambda pos: F.get("valores", pos)).alias("valores"),
        )
    )


def em_linhas(blocos: DataFrame, catalogo: DataFrame) -> DataFrame:
    """The opposite of ``em_blocos``: one row per table and hour, ``valores`` by ``pos``."""
    casas = catalogo.groupBy("tabela").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "casa"))), lambda x: x["casa"]).alias("_casas")
    )
    horas = blocos.groupBy("tabela", "data_hora").agg(
        F.map_from_entries(F.collect_list(F.struct("bloco", "valores"))).alias("_m")
    )  # one row of a wide table
    return junta(horas, casas, ["tabela"], espalhar_por=["data_hora"]).select(
        "tabela",
        "data_hora",
        F.transform(
            "_casas",
            lambda c: F.get(F.try_element_at("_m", F.floor(c / POR_BLOCO).cast("int")), c % POR_BLOCO),
        ).alias("valores"),
    )


def com_pos(lugares: DataFrame, catalogo: DataFrame) -> DataFrame:
    """``(tabela, pos, n)`` from counts by ``(tabela, bloco, lugar)``."""
    casas = catalogo.select("tabela", "pos", _bloco("casa").alias("bloco"), (F.col("casa") % POR_BLOCO).alias("lugar"))
    return lugares.join(casas, ["tabela", "bloco", "lugar"]).select("tabela", "pos", "n")


def _so_os_blocos(blocos: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Rows of the few blocks that ``pedidos`` names. Their names reach the scan: other pages are not read."""
    pares = pedidos.select("tabela", "bloco", classe_da_tabela("tabela").alias("classe")).distinct()
    nomes = pares.limit(MAX_BLOCOS_NOMEADOS + 1).collect()
    if len(nomes) > MAX_BLOCOS_NOMEADOS:
        return blocos
    for c in ("tabela", "bloco", "classe"):
        if c in blocos.columns:
            blocos = blocos.filter(F.col(c).isin(sorted({r[c] for r in nomes})))
    return blocos


def leituras(
    blocos: DataFrame, lugares: DataFrame, sem_canal: Column | None = None, teto_bytes: int | None = None
) -> DataFrame:
    """The four channels of every row of ``lugares``: ``(codigo, tabela, tabela_ordem, data_hora, eae, ear, ere, err)``.

    ``lugares`` (``base.lugares_nas_tabelas`` of a catalogue with places) is small. Where one block has all channels and
    every hour, which is the rule, this is one map-side join on table and block. Else the blocks' rows meet by hour.
    ``sem_canal`` stands for a channel that the table lacks.
    """
    sem_canal = F.lit(None).cast("double") if sem_canal is None else sem_canal
    dos_canais = F.filter(F.array(*[_bloco(c) for c in CASAS]), lambda b: b.isNotNull())
    dos_canais = F.array_distinct(F.when(F.col("completo"), dos_canais).otherwise(F.array_append(dos_canais, F.lit(0))))
    pedidos = lugares.select("codigo", "tabela", "tabela_ordem", *CASAS, dos_canais.alias("_blocos"))
    um_so = F.size("_blocos") == 1
    simples = pedidos.filter(um_so).withColumn("bloco", F.col("_blocos")[0]).drop("_blocos")
    varios = pedidos.filter(~um_so).select("*", F.explode("_blocos").alias("bloco")).drop("_blocos")
    chaves = ["tabela", "bloco"]

    def junto(lado: DataFrame) -> DataFrame:
        return junta(_so_os_blocos(blocos, lado), lado, chaves, espalhar_por=["data_hora"], teto_bytes=teto_bytes)

    def valor(casa: str) -> Column:
        return F.get("valores", F.col(casa) % POR_BLOCO)

    chave = ["codigo", "tabela", "tabela_ordem", "data_hora"]
    direta = junto(simples).select(
        *chave, *[F.when(F.col(c).isNull(), sem_canal).otherwise(valor(c)).alias(l) for l, c in zip(LUGARES, CASAS)]
    )
    if varios.isEmpty():
        return direta
    # every channel is in one of the blocks
    juntas = junto(varios).groupBy(*chave, *CASAS).agg(
        *[F.max(F.when(_bloco(c) == F.col("bloco"), valor(c))).alias(l) for l, c in zip(LUGARES, CASAS)]
    )
    return direta.unionByName(
        juntas.select(*chave, *[F.when(F.col(c).isNull(), sem_canal).otherwise(F.col(l)).alias(l) for l, c in zip(LUGARES, CASAS)])
    )

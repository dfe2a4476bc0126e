"""Stored measurement tables, registry files and delivered files.

Measurements are Parquet in blocks of 16 channels (``operators/blocos``), partitioned by year, month and a hash class of
the table; so a month of many small tables makes few large files, and a load touches the classes of its tables only.
Within a partition rows are sorted by day, table, block and hour, and pages are small: the channels of an equipment and
one day of all tables are both few pages, and the page index lets the scan skip the others.

``presenca`` counts, in the same partitions, the values of every place of every block. What a base consists of is told by
its newest manifest (``sources/publicacao``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from fasor.operators.blocos import CLASSES, classe_da_tabela, com_pos
from fasor.operators.cadastro import sem_chave_nula
from fasor.operators.carga import ESQUEMA_CATALOGO
from fasor.sources.publicacao import Estado, estado

__all__ = ["CLASSES", "classe_da_tabela"]

ESQUEMA_MEDICOES = (
    "tabela string, bloco int, data_hora timestamp_ntz, dia int, valores array<double>, ano int, mes int, classe int"
)
ESQUEMA_PRESENCA = "tabela string, bloco int, lugar int, n bigint, ano int, mes int, classe int"
ESQUEMA_GUARDADO = ESQUEMA_CATALOGO + ", casa int, inteiro boolean"
PARTICOES = ("ano", "mes", "classe")
#: Pages hold four blocks of one day, about 12 kB. Readings have no dictionary: a reader of few pages would have to
#: read all of it.
OPCOES = {"parquet.page.row.count.limit": "96", "parquet.enable.dictionary#valores.list.element": "false"}


def com_particoes(medicoes: DataFrame) -> DataFrame:
    return medicoes.withColumns(
        {"ano": F.year("data_hora"), "mes": F.month("data_hora"), "classe": classe_da_tabela("tabela")}
    )


def _le(spark: SparkSession, base: str, nome: str, esquema: str, agora: Estado | None) -> DataFrame:
    agora = agora or estado(spark, base)
    raiz = f"{base}/{nome}"
    pastas = [f"{raiz}/carga={c}/ano={a}/mes={m}/classe={k}" for (a, m, k), c in sorted(agora.particoes.items())]
    if not pastas:
        return spark.createDataFrame([], esquema)
    return spark.read.schema(f"{esquema}, carga string").option("basePath", raiz).parquet(*pastas).drop("carga")


def le_medicoes(spark: SparkSession, base: str, agora: Estado | None = None) -> DataFrame:
    """All blocks of all tables; filters on year, month, class, table, block and time prune files and pages."""
    return _le(spark, base, "medicoes", ESQUEMA_MEDICOES, agora)


def le_presenca(spark: SparkSession, base: str, agora: Estado | None = None) -> DataFrame:
    """Values of every place: ``(tabela, pos, n)``, summed over the months that have any."""
    agora = agora or estado(spark, base)
    somas = (
        _le(spark, base, "presenca", ESQUEMA_PRESENCA, agora)
        .groupBy("tabela", "bloco", "lugar")
        .agg(F.sum("n").alias("n"))
    )
    return com_pos(somas, le_catalogo(spark, base, agora))


def le_catalogo(spark: SparkSession, base: str, agora: Estado | None = None) -> DataFrame:
    """The catalogue of the newest state; empty before the first load."""
    agora = agora or estado(spark, base)
    if agora.catalogo is None:
        return spark.createDataFrame([], ESQUEMA_GUARDADO)
    return spark.read.schema(ESQUEMA_GUARDADO).parquet(f"{base}/catalogo/carga={agora.catalogo}")


def nas_tabelas(medicoes: DataFrame, tabelas: Sequence[str]) -> DataFrame:
    """Rows of some tables; of a stored base only their classes are read."""
    if "classe" in medicoes.columns:
        classes = medicoes.sparkSession.createDataFrame([(t,) for t in tabelas], "t string")
        numeros = [r[0] for r in classes.select(classe_da_tabela("t")).distinct().collect()]
        medicoes = medicoes.filter(F.col("classe").isin(numeros))
    return medicoes.filter(F.col("tabela").isin(list(tabelas)))


def nas_particoes(medicoes: DataFrame, tocadas: DataFrame) -> DataFrame:
    """Stored rows of the partitions in ``tocadas``; no other file is read.

    The years are a static range. Within it the partitions, at most twelve times ``CLASSES`` a year, are found while the
    query runs: the comparison makes them a selective side.
    """
    anos = tocadas.agg(F.min("ano"), F.max("ano")).first()
    if anos[0] is None:
        return medicoes.limit(0)
    no_periodo = F.col("ano").between(anos[0], anos[1])
    quais = tocadas.select(*PARTICOES).distinct().filter(no_periodo)
    return medicoes.filter(no_periodo).join(F.broadcast(quais), list(PARTICOES), "left_semi")


def grava_medicoes(blocos: DataFrame, base: str, carga: str) -> None:
    """Write whole partitions, and their counts, as those of a load. Nothing reads them before they are published."""
    prontas = com_particoes(blocos)

    def grava(df: DataFrame, nome: str) -> None:
        # partitions of any size: small ones share a writer, large ones are cut
        df.write.options(**OPCOES).partitionBy(*PARTICOES).parquet(f"{base}/{nome}/carga={carga}")

    # The day stands as a number, as Parquet filters of this type of time are not pushed down. Every other day runs
    # backwards: a page that holds the end of one day and the start of the next then spans few blocks, not all.
    avante = F.col("dia") % 2 == 0
    vaivem = [x for c in ("tabela", "bloco") for x in (F.when(avante, F.col(c)).asc(), F.when(~avante, F.col(c)).desc())]
    ordem = (*PARTICOES, "dia", *vaivem, "data_hora")
    grava(
        prontas.select("tabela", "bloco", "data_hora", F.dayofmonth("data_hora").alias("dia"), "valores", *PARTICOES)
        .hint("rebalance", *PARTICOES)
        .sortWithinPartitions(*ordem),
        "medicoes",
    )
    celulas = prontas.select("tabela", "bloco", *PARTICOES, F.posexplode_outer("valores").alias("lugar", "valor"))
    contas = celulas.groupBy("tabela", "bloco", "lugar", *PARTICOES).agg(F.count("valor").alias("n"))
    grava(contas.hint("rebalance", *PARTICOES), "presenca")


def grava_catalogo(catalogo: DataFrame, base: str, carga: str) -> None:
    """Write the catalogue of a load. Nothing reads it before it is published."""
    catalogo.write.parquet(f"{base}/catalogo/carga={carga}")


def le_cadastro(
    spark: SparkSession, caminho: str, esquema: str, chave: str, exige: tuple[str, ...] = ()
) -> DataFrame:
    """Registry sheet saved as CSV (``;``, header), Parquet or by ``grava_cadastro``, without rows that lack the key.

    Columns are found by the names in the header, whatever their order; required ones that it lacks raise ValueError,
    other columns of ``esquema`` are NULL.
    """
    if versoes := _versoes(spark, f"{caminho.rstrip('/')}/versao=*/_SUCCESS"):
        caminho = f"{caminho.rstrip('/')}/versao={versoes[-1]}/*.parquet"
    if caminho.endswith(".parquet"):
        return sem_chave_nula(spark.read.parquet(caminho), chave, exige)
    lido = spark.read.option("header", True).option("sep", ";").csv(caminho)
    sem_chave_nula(lido, chave, exige)
    tipos = spark.createDataFrame([], esquema).schema
    return sem_chave_nula(
        lido.select(
            *[
                (F.col(f"`{c.name}`") if c.name in lido.columns else F.lit(None)).try_cast(c.dataType).alias(c.name)
                for c in tipos
            ]
        ),
        chave,
    )


def grava_cadastro(cadastro: DataFrame, destino: str) -> None:
    """Write a registry or a dictionary back as a new version under ``destino``; ``le_cadastro`` reads the newest one
    whose write has ended. The version before it stays, for those who are reading it; older ones are deleted.
    """
    spark = cadastro.sparkSession
    destino = destino.rstrip("/")
    iniciadas, prontas = (_versoes(spark, f"{destino}/versao=*{fim}") for fim in ("", "/_SUCCESS"))
    cadastro.write.parquet(f"{destino}/versao={max(iniciadas, default=-1) + 1}")
    caminho = spark._jvm.org.apache.hadoop.fs.Path
    for velha in iniciadas:
        if velha not in prontas[-1:]:
            p = caminho(f"{destino}/versao={velha}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _versoes(spark: SparkSession, padrao: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(padrao)
    achadas = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(int(re.search(r"/versao=(\d+)", a.getPath().toString())[1]) for a in achadas)


def grava_csv(
    df: DataFrame, destino: str, por: Sequence[str] = (), codificacao: str = "ISO-8859-1"
) -> None:
    """CSV as the pages deliver it: ``;``, header, latin-1; a folder per value of ``por``."""
    escrita = (
        df.write.mode("overwrite")
        .option("sep", ";")
        .option("header", True)
        .option("encoding", codificacao)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    )
    (escrita.partitionBy(*por) if por else escrita).csv(destino)


def exporta_curva(curva: DataFrame, pasta: str) -> None:
    """Curves of all equipments (``perfis.curva_para_exportar``), one folder per equipment and year, in order of time.

    An equipment's year has at most 8784 rows, so it is one file of one task.
    """
    com_ano = curva.withColumn("ano", F.year("Data_Hora"))
    juntas = com_ano.repartition("codigo", "ano").sortWithinPartitions("codigo", "ano", "Data_Hora")
    grava_csv(juntas, f"{pasta}/curvas", por=["codigo", "ano"])


def exporta_coincidente(resultado: DataFrame, pasta: str, instante: datetime) -> str:
    """Coincident table (``coincidente.com_titulos``) under the name of its instant."""
    destino = f"{pasta}/demanda_coincidente_{instante:%Y%m%d_%H%M}"
    grava_csv(resultado, destino)
    return destino

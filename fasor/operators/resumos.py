"""Monthly summaries of the demand, from which the key figures follow without the hours.

A summary has one row per equipment and month: counts, sums, sums of squares, extremes, overload hours, and the largest
distinct values of P with the first hour of each. Summaries of months merge, so a load recomputes the months it touched.

Only one figure may need more than a summary keeps: the largest P under the outlier bound, where all kept values of a
month are beyond the bound and it had more. Such months of such equipments are read again, exactly; nothing is
approximated. Every other value that the figures ask for is a month's largest or least one, or the largest under the
bound, and these are kept with their hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fasor.functions.numero import arredonda
from fasor.functions.tempo import instante_da_ordem, ordem_na_base
from fasor.operators import kpi
from fasor.operators.juncao import junta, junta_grandes
from fasor.operators.materializa import materializa

#: Largest distinct values of P that a month keeps.
MAIORES = 8
CHAVE = ("codigo", "ano", "mes")
_VALOR = "struct<p:double,ordem:bigint,q:double>"
ESQUEMA = (
    "codigo string, ano int, mes int, potencia_instalada double, n_p bigint, soma_p double, max_p double, min_p double,"
    " n_q bigint, soma_q double, n_s bigint, soma_s double, max_s double, min_p_sem_zero bigint, n_x bigint,"
    " soma_x decimal(38,0), soma_x2 decimal(38,0), horas_ultrapassagem bigint, primeira_ordem bigint, ultima_ordem bigint,"
    f" distintos int, maiores array<{_VALOR}>, menor {_VALOR}"
)


def por_mes(demanda: DataFrame) -> DataFrame:
    return demanda.withColumns({"ano": F.year("data_hora"), "mes": F.month("data_hora")})


def resumo_mensal(demanda: DataFrame, maiores: int = MAIORES) -> DataFrame:
    """Summaries of an hourly demand (see ``base.demanda``): the columns of ``ESQUEMA``.

    The one shuffle of hours is by equipment and month and value of P; a month of an equipment has at most 744 hours, so
    what is collected is bounded.
    """
    p, q, s = F.col("p"), F.col("q"), F.col("s")
    inteiro = F.when(p != 0, p.try_cast("bigint"))
    x = inteiro.cast("decimal(19,0)")
    ordem = ordem_na_base(F.col("tabela_ordem"), F.col("data_hora"))
    # rows of one P first: sums of them merge into the month's
    por_valor = por_mes(demanda).withColumn("_ordem", ordem).groupBy(*CHAVE, "p").agg(
        F.max("potencia_instalada").alias("potencia_instalada"),
        F.count(p).alias("n_p"),
        F.sum(p).alias("soma_p"),
        F.count(q).alias("n_q"),
        F.sum(q).alias("soma_q"),
        F.count(s).alias("n_s"),
        F.sum(s).alias("soma_s"),
        F.max(s).alias("max_s"),
        F.min(inteiro).alias("min_p_sem_zero"),
        F.count(inteiro).alias("n_x"),
        F.sum(x).alias("soma_x"),
        F.sum((x * x).cast("decimal(38,0)")).alias("soma_x2"),
        F.sum("ultrapassagem").alias("horas_ultrapassagem"),
        F.min("_ordem").alias("primeira_ordem"),
        F.max("_ordem").alias("ultima_ordem"),
        F.min_by("q", "_ordem").alias("_q"),
    )
    valor = F.when(p.isNotNull(), F.struct("p", F.col("primeira_ordem").alias("ordem"), F.col("_q").alias("q")))
    meses = por_valor.groupBy(*CHAVE).agg(
        F.max("potencia_instalada").alias("potencia_instalada"),
        F.max("p").alias("max_p"),
        F.min("p").alias("min_p"),
        F.max("max_s").alias("max_s"),
        F.min("min_p_sem_zero").alias("min_p_sem_zero"),
        F.min("primeira_ordem").alias("primeira_ordem"),
        F.max("ultima_ordem").alias("ultima_ordem"),
        *[F.sum(c).alias(c) for c in ("n_p", "soma_p", "n_q", "soma_q", "n_s", "soma_s", "n_x", "horas_ultrapassagem")],
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("soma_x", "soma_x2")],
        F.sort_array(F.collect_list(valor), asc=False).alias("_valores"),
    )
    return meses.select(
        *CHAVE,
        *[c for c in _nomes() if c not in (*CHAVE, "distintos", "maiores", "menor")],
        F.size("_valores").alias("distintos"),
        F.slice("_valores", 1, maiores).alias("maiores"),
        F.get("_valores", F.size("_valores") - 1).alias("menor"),
    )


def _nomes() -> list[str]:
    fora, nomes, nivel = "", [], 0
    for c in ESQUEMA + ",":
        nivel += (c in "<(") - (c in ">)")
        if c == "," and not nivel:
            nomes.append(fora.split()[0])
            fora = ""
        else:
            fora += c
    return nomes


def estatisticas(resumos: DataFrame) -> DataFrame:
    """``kpi.estatisticas`` from summaries."""
    def media(nome: str) -> Column:
        return F.try_divide(F.sum(f"soma_{nome}"), F.sum(f"n_{nome}"))

    somas = resumos.groupBy("codigo").agg(
        F.max("potencia_instalada").alias("potencia_instalada"),
        F.max("max_p").alias("max_p"),
        F.min("min_p").alias("min_p"),
        arredonda(F.max("max_s"), 2).alias("max_s"),
        F.rint(media("p")).alias("media_p"),
        F.rint(media("q")).alias("media_q"),
        media("s").alias("media_s"),
        F.min("min_p_sem_zero").alias("min_p_sem_zero"),
        F.sum("n_x").alias("_n"),
        F.sum("soma_x").cast("decimal(38,0)").alias("_x"),
        F.sum("soma_x2").cast("decimal(38,0)").alias("_x2"),
        F.sum("horas_ultrapassagem").alias("horas_ultrapassagem"),
        F.min("primeira_ordem").alias("primeira_ordem"),
        F.max("ultima_ordem").alias("ultima_ordem"),
    )
    # n * sum(x^2) - sum(x)^2 in whole numbers; in doubles where these have no room
    n = F.col("_n")
    exato = F.try_subtract(F.try_multiply(n.cast("decimal(19,0)"), "_x2"), F.try_multiply("_x", "_x")).cast("double")
    perto = n * F.col("_x2").cast("double") - F.col("_x").cast("double") * F.col("_x").cast("double")
    variancia = F.when(n > 1, F.coalesce(exato, F.greatest(perto, F.lit(0.0))) / (n.cast("double") * (n - 1)))
    desvio = F.coalesce(F.sqrt(variancia).try_cast("bigint"), F.lit(0).cast("bigint"))
    return kpi.com_faixa(somas.withColumn("desvio_p", desvio).drop("_n", "_x", "_x2"))


def _indecisos(resumos: DataFrame, figuras: DataFrame) -> DataFrame:
    """Months whose kept values all lie beyond the equipment's bound, and which had more: ``(codigo, ano, mes)``."""
    ultimo = F.get("maiores", F.size("maiores") - 1)["p"]
    cortados = resumos.filter(F.col("distintos") > F.size("maiores"))
    return (
        junta(cortados, figuras.select("codigo", "limite_superior"), ["codigo"], espalhar_por=["ano", "mes"])
        .filter(ultimo >= F.col("limite_superior"))
        .select(*CHAVE)
    )


def painel(resumos: DataFrame, horas: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``kpi.painel`` from summaries.

    ``horas`` gives the hourly demand of the months that it gets as ``(codigo, ano, mes)``; it is called only if there
    are some that the summaries cannot decide.
    """
    figuras = materializa(estatisticas(resumos))
    candidatos = resumos.select("codigo", F.explode("maiores").alias("v")).select("codigo", "v.p", "v.ordem", "v.q")
    indecisos = materializa(_indecisos(resumos, figuras))
    if not indecisos.isEmpty():
        # a month of an equipment has at most 744 hours: nothing to spread
        de_novo = junta(por_mes(horas(indecisos)), indecisos, CHAVE, "left_semi")
        ordem = ordem_na_base(F.col("tabela_ordem"), F.col("data_hora"))
        candidatos = candidatos.unionByName(materializa(de_novo.select("codigo", "p", ordem.alias("ordem"), "q")))
    abaixo = (
        junta(candidatos, figuras.select("codigo", "limite_superior"), ["codigo"], espalhar_por=["ordem"])
        .filter("p < limite_superior")
        .groupBy("codigo")
        .agg(F.max("p").alias("max_p_filtrado"))
    )
    limitadas = materializa(kpi.com_limites(junta_grandes(figuras, abaixo, ["codigo"], "left")))
    valores = limitadas.select("codigo", "max_p_robusto", F.col("min_p").alias("_min_p")).dropna()
    # largest and least ones in one join, so that the values are broadcast once
    menores = resumos.select("codigo", "menor.p", "menor.ordem", "menor.q")
    todos = candidatos.withColumn("_menor", F.lit(False)).unionByName(menores.withColumn("_menor", F.lit(True)))
    no_maximo = ~F.col("_menor") & (F.col("p") == F.col("max_p_robusto"))
    no_minimo = F.col("_menor") & (F.col("p") == F.col("_min_p"))
    ordem_no_maximo, ordem_no_minimo = F.when(no_maximo, F.col("ordem")), F.when(no_minimo, F.col("ordem"))
    extremos = (
        junta(todos, valores, ["codigo"], espalhar_por=["ordem"])
        .filter(no_maximo | no_minimo)
        .groupBy("codigo")
        .agg(
            F.min(ordem_no_maximo).alias("_max"),
            F.min_by("q", ordem_no_maximo).alias("q_no_maximo"),
            F.min(ordem_no_minimo).alias("_min"),
            F.min_by("q", ordem_no_minimo).alias("q_no_minimo"),
        )
    )
    juntas = junta_grandes(limitadas, extremos, ["codigo"], "left")
    return kpi.cartao(
        juntas.withColumns(
            {"instante_maximo": instante_da_ordem(F.col("_max")), "instante_minimo": instante_da_ordem(F.col("_min"))}
        )
    )

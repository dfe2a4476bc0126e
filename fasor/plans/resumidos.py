"""Key figures of a stored base from summaries that are kept beside it.

``<base>/resumos`` holds the monthly summaries of all equipments, and what each equipment was defined by (tables, places,
installed power), published like the base itself. Bringing them up to date reads the months that a load has rewritten
since then, and, for equipments whose definition changed, their own blocks; nothing else.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fasor.operators import base as horas
from fasor.operators import cadastro, resumos
from fasor.operators.blocos import CASAS
from fasor.operators.materializa import apaga, materializa, provisorios
from fasor.sources import tabelas
from fasor.sources.publicacao import Estado, estado, nova_carga, publica

Mes = tuple[int, int]


def _raiz(base: str) -> str:
    return f"{base}/resumos"


def le_resumos(spark: SparkSession, base: str, meses: Iterable[Mes] | None = None, agora: Estado | None = None) -> DataFrame:
    """Stored summaries, of some months or of all."""
    agora = agora or estado(spark, _raiz(base))
    agora = agora if meses is None else agora.nos_meses(meses)
    raiz = f"{_raiz(base)}/linhas"
    pastas = [f"{raiz}/carga={c}/ano={a}/mes={m}" for (a, m), c in sorted(agora.particoes.items())]
    if not pastas:
        return spark.createDataFrame([], resumos.ESQUEMA)
    lidas = spark.read.schema(f"{resumos.ESQUEMA}, carga string").option("basePath", raiz).parquet(*pastas)
    return lidas.select(*spark.createDataFrame([], resumos.ESQUEMA).columns)


def _definicoes(elegiveis: DataFrame, equipamentos: DataFrame) -> DataFrame:
    """A hash of all that an equipment's demand depends on besides the measurements; tables of one equipment are few."""
    lugares = F.array_sort(F.collect_list(F.struct("tabela", "tabela_ordem", *CASAS, "completo")))
    potencias = cadastro.potencia_instalada(equipamentos)
    return (
        elegiveis.groupBy("codigo").agg(lugares.alias("_l")).join(potencias, "codigo", "left")
        .select("codigo", F.sha2(F.to_json(F.struct("_l", "potencia_instalada")), 256).alias("definicao"))
    )


def _assinaturas(agora: Estado) -> dict[Mes, str]:
    """For every month which loads hold its partitions."""
    por_mes: dict[Mes, list] = {}
    for (ano, mes, classe), carga in sorted(agora.particoes.items()):
        por_mes.setdefault((ano, mes), []).append((classe, carga))
    return {m: hashlib.sha256(json.dumps(x).encode()).hexdigest() for m, x in por_mes.items()}


def _demanda(spark: SparkSession, base: str, agora: Estado, meses: Iterable[Mes], elegiveis: DataFrame, equipamentos: DataFrame) -> DataFrame:
    """Hourly demand of some months; the other months' files are not even listed."""
    return horas.demanda(tabelas.le_medicoes(spark, base, agora.nos_meses(meses)), elegiveis, equipamentos)


def _elegiveis(spark: SparkSession, base: str, agora: Estado, equipamentos: DataFrame, medidores: DataFrame) -> DataFrame:
    resolvidos = cadastro.completos(cadastro.resolve_canais(cadastro.codigos_distintos(equipamentos), medidores))
    return materializa(horas.tabelas_elegiveis(tabelas.le_catalogo(spark, base, agora), resolvidos))


def atualiza(spark: SparkSession, base: str, equipamentos: DataFrame, medidores: DataFrame) -> Estado:
    """Bring the summaries up to the newest state of the base and the registry; returns their state."""
    agora, antes = estado(spark, base), estado(spark, _raiz(base))
    with provisorios() as escritos:
        feito = _atualiza(spark, base, agora, antes, equipamentos, medidores)
    apaga(spark, escritos)
    return feito


def _atualiza(spark: SparkSession, base: str, agora: Estado, antes: Estado, equipamentos: DataFrame, medidores: DataFrame) -> Estado:
    elegiveis = _elegiveis(spark, base, agora, equipamentos, medidores)
    definicoes = materializa(_definicoes(elegiveis, equipamentos))
    velhas = (
        spark.createDataFrame([], definicoes.schema)
        if antes.catalogo is None
        else spark.read.schema(definicoes.schema).parquet(f"{_raiz(base)}/definicoes/carga={antes.catalogo}")
    )
    assinaturas = _assinaturas(agora)
    mudados = [m for m, a in assinaturas.items() if antes.notas.get(f"{m[0]}-{m[1]}") != a]
    outros = [m for m in assinaturas if m not in set(mudados)]
    # equipments that are new, gone or defined otherwise
    outra = definicoes.alias("n").join(velhas.alias("v"), "codigo", "full").filter(
        ~F.col("n.definicao").eqNullSafe(F.col("v.definicao"))
    )
    outra = materializa(outra.select("codigo"))
    mudou_cadastro = not outra.isEmpty()
    if not mudados and not mudou_cadastro:
        return antes

    partes = []
    if mudados:
        partes.append(resumos.resumo_mensal(_demanda(spark, base, agora, mudados, elegiveis, equipamentos)))
    if outros and mudou_cadastro:
        ficam = le_resumos(spark, base, outros, antes).join(outra, "codigo", "left_anti")
        deles = materializa(elegiveis.join(outra, "codigo", "left_semi"))
        partes += [ficam, resumos.resumo_mensal(_demanda(spark, base, agora, outros, deles, equipamentos))]
    esta = nova_carga()
    prontas = partes[0]
    for parte in partes[1:]:
        prontas = prontas.unionByName(parte)
    prontas = materializa(prontas)
    meses = [tuple(r) for r in prontas.select("ano", "mes").distinct().collect()]
    if meses:
        prontas.hint("rebalance", "ano", "mes").write.partitionBy("ano", "mes").parquet(f"{_raiz(base)}/linhas/carga={esta}")
    definicoes.write.parquet(f"{_raiz(base)}/definicoes/carga={esta}")
    refeitos = set(mudados) | (set(outros) if mudou_cadastro else set())
    particoes = {m: c for m, c in antes.particoes.items() if m not in refeitos} | dict.fromkeys(meses, esta)
    notas = {f"{a}-{m}": x for (a, m), x in assinaturas.items()}
    novo = Estado(antes.numero + 1, esta, particoes, notas)
    publica(spark, _raiz(base), novo)
    return novo


def painel(spark: SparkSession, base: str, equipamentos: DataFrame, medidores: DataFrame) -> DataFrame:
    """``kpi.painel`` of a stored base, from its summaries, which are brought up to date first."""
    feito = atualiza(spark, base, equipamentos, medidores)

    def de_novo(indecisos: DataFrame) -> DataFrame:
        agora = estado(spark, base)
        meses = [tuple(r) for r in indecisos.select("ano", "mes").distinct().collect()]  # months
        deles = _elegiveis(spark, base, agora, equipamentos, medidores).join(indecisos.select("codigo").distinct(), "codigo", "left_semi")
        return _demanda(spark, base, agora, meses, materializa(deles), equipamentos)

    return resumos.painel(le_resumos(spark, base, None, feito), de_novo)

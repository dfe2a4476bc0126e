"""Seconds per headline query. Prints one JSON line. With BENCH_STORED=1 also load, upsert and query of stored tables.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2). ``queries`` has the best
run of each, ``first`` the first one, which also pays for compilation; ``value`` and ``value_first`` are their sums.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fasor.operators import base, cadastro, coincidente, kpi
from fasor.operators.materializa import pasta_compartilhada
from fasor.plans import entradas
from fasor.plans.consultas import CONSULTAS, ESCOLHIDOS, INSTANTE
from fasor.plans.ingestao import carrega_linhas, guarda
from fasor.session import sessao
from fasor.sources import tabelas

PRINCIPAIS = (
    "painel_demanda",
    "serie_anual",
    "curva_diaria",
    "base_horaria",
    "dedup_primeira_tabela",
    "demanda_coincidente",
    "demanda_composta",
    "demanda_mensal",
    "parse_data_hora",
    "dedup_leituras",
    "agrega_hora",
    "auditoria_carga",
    "upsert_linha",
    "upsert_existente",
)


def consome(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def gravadas(spark: SparkSession, pasta: str) -> dict[str, Callable[[], None]]:
    """Load into an empty base, load again (upsert of all partitions), store the region tables, query them."""
    raiz = f"{pasta_compartilhada(spark)}/bench-{uuid.uuid4().hex}"
    regioes = f"{raiz}/regioes"
    codigos = cadastro.codigos_distintos(entradas.equipamentos(spark, pasta))
    resolvidos = cadastro.completos(cadastro.resolve_canais(codigos, entradas.medidores(spark, pasta)))

    def painel(escolhidos: tuple[str, ...] | None = None) -> None:
        elegiveis = base.dos_codigos(base.tabelas_elegiveis(tabelas.le_catalogo(spark, regioes), resolvidos), escolhidos)
        consome(kpi.painel(base.demanda(tabelas.le_medicoes(spark, regioes), elegiveis, entradas.equipamentos(spark, pasta))))

    def instante() -> None:
        lidas, presenca, catalogo = (le(spark, regioes) for le in (tabelas.le_medicoes, tabelas.le_presenca, tabelas.le_catalogo))
        consome(coincidente.demanda_coincidente(lidas, presenca, catalogo, resolvidos, INSTANTE))

    def carrega(destino: str) -> None:
        carrega_linhas(spark, entradas.linhas(spark, pasta), destino).descarta()

    return {
        "carga": lambda: carrega(f"{raiz}/{uuid.uuid4().hex}"),
        "carga_upsert": lambda: carrega(f"{raiz}/mesma"),
        "grava_regioes": lambda: guarda(spark, regioes, entradas.medicoes(spark, pasta), entradas.catalogo(spark, pasta)),
        "painel_gravado": painel,
        "escolhidos_gravados": lambda: painel(ESCOLHIDOS),
        "coincidente_gravado": instante,
    }


def main() -> None:
    pasta = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    vezes = int(os.environ.get("BENCH_RUNS", "2"))
    spark = sessao("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    passos = {nome: lambda nome=nome: consome(CONSULTAS[nome](spark, pasta)) for nome in PRINCIPAIS}
    primeiras, melhores = {}, {}
    if os.environ.get("BENCH_STORED"):
        passos |= gravadas(spark, pasta)
    for nome, passo in passos.items():
        medidas = []
        for _ in range(vezes):
            inicio = time.perf_counter()
            passo()
            medidas.append(time.perf_counter() - inicio)
        primeiras[nome], melhores[nome] = round(medidas[0], 3), round(min(medidas), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_best_run",
                "value": round(sum(melhores.values()), 3),
                "value_first": round(sum(primeiras.values()), 3),
                "unit": "sec",
                "queries": melhores,
                "first": primeiras,
                "sf": os.path.basename(pasta.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": vezes,
            }
        )
    )


if __name__ == "__main__":
    main()

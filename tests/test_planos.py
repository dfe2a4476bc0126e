"""Physical plans: no Python, no cross join, pushed filters, pruned columns, hash aggregates."""

import re
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fasor.operators import base, blocos, carga, coincidente, composicao, kpi, limpeza
from fasor.plans import entradas
from fasor.plans.consultas import CONSULTAS
from fasor.plans.ingestao import guarda
from fasor.sources import tabelas

PASTA = "/root/testdata/sf0.001"
# These aggregate text, structs or arrays: header names, registry rows, whole stored rows.
COM_ESTRUTURA = {
    "colunas_novas", "cresce_catalogo", "insere_ou_ignora", "normaliza_colunas", "chaves_duplicadas",
    "upsert_linha", "upsert_celula", "canais_incompletos", "equipamentos_sem_dados", "nome_equipamento",
    "resolve_canais", "tabelas_elegiveis", "upsert_existente", "cadastro_atualiza", "mudancas_ilegiveis",
    "coincidente_sem_dados", "tabelas_com_dados", "cadastro_edicoes", "edicoes_ilegiveis",
}


def plano(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("nome", sorted(CONSULTAS))
def test_plan(spark, nome):
    texto = plano(CONSULTAS[nome](spark, PASTA))
    for proibido in ("CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "ArrowEvalPython", "BatchEvalPython"):
        assert proibido not in texto
    if nome not in COM_ESTRUTURA:
        assert "SortAggregate" not in texto


@pytest.mark.parametrize("nome", ["painel_demanda", "demanda_coincidente", "upsert_linha", "auditoria_carga"])
def test_whole_plan_without_written_results(spark, nome, monkeypatch):
    """The same checks from the tables on: what is otherwise written in between is part of the plan here."""
    for modulo in list(sys.modules.values()):
        if getattr(modulo, "__name__", "").startswith("fasor.") and hasattr(modulo, "materializa") and "llm" not in modulo.__name__:
            if callable(modulo.materializa):
                monkeypatch.setattr(modulo, "materializa", lambda df: df)
    texto = plano(CONSULTAS[nome](spark, PASTA))
    assert "lineitem.parquet" in texto
    for proibido in ("CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "ArrowEvalPython", "BatchEvalPython"):
        assert proibido not in texto


def test_audit_reads_the_lines_once(spark):
    plano_ = CONSULTAS["auditoria_carga"](spark, PASTA)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plano_


def lidas_de_teste(spark, n):
    # the hour is the same in all rows, but no literal
    hora = F.timestamp_add("HOUR", F.col("id") % 1, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return spark.range(n).select(
        F.concat(F.lit("f"), F.col("id") % 3).alias("arquivo"),
        hora.alias("instante"),
        hora.alias("data_hora"),
        F.array(F.col("id").cast("double"), F.lit(1.0)).alias("valores"),
    )


def test_lines_move_once_to_become_hours(spark):
    texto = plano(limpeza.horas_largas(lidas_de_teste(spark, 1000)))
    assert len(re.findall(r"Exchange hashpartitioning", texto)) == 1


def test_hour_of_very_many_lines_spreads(spark):
    lidas = lidas_de_teste(spark, 3000).union(lidas_de_teste(spark, 3000))
    partes = limpeza._por_hora(lidas, 100)
    assert [p for _, p in partes] == [[], ["_parte"]]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cheias = partes[1][0].groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(cheias) > 3 and max(r["count"] for r in cheias) < 3000
    def iguais(limite):
        return sorted(map(tuple, limpeza.horas_largas(lidas, limite=limite).collect()), key=str)
    assert iguais(100) == iguais(10**9)
    assert limpeza.sem_duplicatas(lidas, limite=100).count() == 3000


@pytest.mark.parametrize("com_linhas", [True, False])
def test_tasks_that_sum_hours_grow_in_number_with_the_lines(spark, monkeypatch, com_linhas):
    monkeypatch.setattr(limpeza, "LINHAS_POR_TAREFA", 100, raising=False)
    lidas = lidas_de_teste(spark, 20000)

    def dealt(limite):
        partes = limpeza._por_hora(lidas, limite, lidas.select("arquivo") if com_linhas else None)
        return [df.rdd.getNumPartitions() for df, _ in partes]

    assert dealt(10**9) == [200]
    assert sum(dealt(3000)) >= 200  # one part for the hours of many lines, if there are any
    poucas = lidas_de_teste(spark, 90)
    linhas = poucas.select("arquivo") if com_linhas else None
    assert limpeza._por_hora(poucas, 10**9, linhas)[0][0].rdd.getNumPartitions() <= 8
    largas = sorted(map(tuple, limpeza.horas_largas(lidas).collect()), key=str)
    monkeypatch.setattr(limpeza, "LINHAS_POR_TAREFA", 10**9, raising=False)
    assert sorted(map(tuple, limpeza.horas_largas(lidas).collect()), key=str) == largas


def base_gravada(spark, pasta):
    medicoes = spark.createDataFrame(
        [(f"t{i}", datetime(ano, mes, 1), [1.0, None]) for i in range(20) for ano in (2020, 2021, 2023) for mes in (1, 2)],
        "tabela string, data_hora timestamp_ntz, valores array<double>",
    )
    catalogo = spark.createDataFrame(
        [(f"t{i}", i, p, f"A-{s}", f"a{s.lower()}", "REAL") for i in range(20) for p, s in enumerate(("EAE", "EAR", "ERE", "ERR"))],
        carga.ESQUEMA_CATALOGO,
    )
    guarda(spark, pasta, medicoes, catalogo)
    return medicoes


def test_upsert_reads_touched_partitions_only(spark, tmp_path):
    pasta = str(tmp_path)
    base_gravada(spark, pasta)
    tocadas = tabelas.com_particoes(
        spark.createDataFrame([("t3", datetime(2021, 2, 9))], "tabela string, data_hora timestamp_ntz")
    )
    lidas = tabelas.nas_particoes(tabelas.le_medicoes(spark, pasta), tocadas)
    linhas = lidas.collect()
    assert {(r.ano, r.mes) for r in linhas} == {(2021, 2)} and "t3" in {r.tabela for r in linhas}
    texto = plano(lidas)
    assert "(ano#" in texto.split("PartitionFilters")[1] and "2021" in texto.split("PartitionFilters")[1]
    assert "dynamicpruning" in texto


def test_instant_of_stored_tables_is_one_pruned_scan(spark, tmp_path):
    pasta = str(tmp_path)
    base_gravada(spark, pasta)
    catalogo = tabelas.le_catalogo(spark, pasta).filter("tabela = 't1'")
    resolvidos = spark.createDataFrame([("A", "A-EAE", "A-EAR", "A-ERE", "A-ERR")], "codigo string, eae string, ear string, ere string, err string")
    df = coincidente.demanda_coincidente(
        tabelas.le_medicoes(spark, pasta), tabelas.le_presenca(spark, pasta), catalogo, resolvidos, datetime(2021, 2, 1)
    )
    texto = plano(df)
    (lido,) = [x for x in texto.split("\n") if "FileScan" in x and "/medicoes/" in x]
    assert re.search(r"PartitionFilters: \[[^\]]*ano", lido)
    for filtro in ("In(tabela", "EqualTo(bloco,0)", "EqualTo(data_hora"):
        assert filtro in lido.replace("EqualTo(tabela", "In(tabela").replace("In(bloco, [0])", "EqualTo(bloco,0)")
    assert [r.p for r in df.collect()] == [0.0]  # EAR has no value at all: NULL counts as 0 here


def linhas_lidas(spark, df) -> int:
    """Rows in the pages that the scans of stored measurements read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execucao = df.sparkSession._jsparkSession.sessionState().executePlan(df._jdf.logicalPlan(), getattr(spark._jvm.org.apache.spark.sql.execution, "CommandExecutionMode").ALL())
        execucao.toRdd().count()
        folhas = execucao.executedPlan().collectLeaves()
        scans = [folhas.apply(i) for i in range(folhas.size())]
        return sum(f.metrics().apply("numOutputRows").value() for f in scans if "/medicoes/" in f.toString())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def larga(spark, tmp_path_factory):
    """Three tables, one of 250 meters with four channels each, over two months of hours."""
    pasta = str(tmp_path_factory.mktemp("larga"))
    nomes = [(t, i, 4 * m + p, f"{t}M{m}-{s}", f"{t}m{m}{s.lower()}", "REAL") for i, (t, n) in enumerate((("a", 250), ("b", 20), ("c", 20))) for m in range(n) for p, s in enumerate(("EAE", "EAR", "ERE", "ERR"))]
    catalogo = spark.createDataFrame(nomes, carga.ESQUEMA_CATALOGO)
    horas = spark.range(59 * 24).select(F.timestamp_add("HOUR", "id", F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")).alias("data_hora"))
    largas = horas.crossJoin(spark.createDataFrame([("a", 1000), ("b", 80), ("c", 80)], "tabela string, n int")).select(
        "tabela",
        "data_hora",
        F.transform(F.sequence(F.lit(1), "n"), lambda i: F.pmod(F.xxhash64("tabela", "data_hora", i), F.lit(100_000)) / 100.0).alias("valores"),
    )
    guarda(spark, pasta, largas.repartition(4), catalogo)
    resolvidos = catalogo.filter("pos % 4 = 0").select(
        F.replace("descricao", F.lit("-EAE"), F.lit("")).alias("codigo")
    ).select("codigo", *[F.concat("codigo", F.lit(f"-{s}")).alias(s.lower()) for s in ("EAE", "EAR", "ERE", "ERR")])
    return pasta, largas, resolvidos


def test_one_equipment_reads_few_pages(spark, larga):
    pasta, largas, resolvidos = larga
    lidas, catalogo = tabelas.le_medicoes(spark, pasta), tabelas.le_catalogo(spark, pasta)
    um = base.tabelas_elegiveis(catalogo, resolvidos.filter("codigo = 'aM101'"))
    df = base.base_horaria(lidas, um)
    assert 0 < linhas_lidas(spark, df) < 0.1 * linhas_lidas(spark, tabelas.nas_tabelas(lidas, ['a']))
    iguais = base.base_horaria(largas, um).exceptAll(df).count() + df.exceptAll(base.base_horaria(largas, um)).count()
    assert iguais == 0 and df.count() == 59 * 24


def test_one_hour_reads_few_pages(spark, larga):
    pasta, largas, resolvidos = larga
    lidas, catalogo = tabelas.le_medicoes(spark, pasta), tabelas.le_catalogo(spark, pasta)
    instante = datetime(2021, 2, 11, 13)
    df = coincidente.linhas_no_instante(lidas, tabelas.le_presenca(spark, pasta), catalogo, resolvidos, instante).select("codigo", *base.LUGARES)
    tudo = linhas_lidas(spark, base.no_periodo(lidas, 2021, 2))
    assert 0 < linhas_lidas(spark, base.no_instante(lidas, instante)) < 0.05 * tudo
    assert 0 < linhas_lidas(spark, df) < 0.05 * tudo
    certo = base.base_horaria(base.no_instante(largas, instante), base.tabelas_elegiveis(catalogo, resolvidos)).select("codigo", *base.LUGARES)
    assert df.count() == 290 and df.exceptAll(certo).count() == 0


def test_channels_of_a_meter_share_a_block_and_old_hours_stay(spark, tmp_path):
    """Channels that come later, in any order, and meters that come later."""
    pasta = str(tmp_path)
    nomes = [(0, "Z"), (1, "M1-EAE"), (2, "M1-ERE"), (3, "M2-ERR"), (4, "Y")]
    depois = [*nomes, (5, "M1-EAR"), (6, "M3-EAE"), (7, "M2-EAE"), (8, "W")] + [(9 + i, f"N{i}-EAE") for i in range(6)] + [(15, "M1-ERR"), (16, "N5-EAR"), (17, "N5-ERE"), (18, "N5-ERR")]

    def catalogo(nomes):
        return spark.createDataFrame([("t", 0, p, d, d.replace("-", "").lower(), "REAL") for p, d in nomes], carga.ESQUEMA_CATALOGO)

    def horas(n, dia):
        return spark.createDataFrame([("t", datetime(2021, 1, dia, h), [float(100 * dia + 10 * p + h) for p in range(n)]) for h in range(3)], "tabela string, data_hora timestamp_ntz, valores array<double>")

    guarda(spark, pasta, horas(5, 1), catalogo(nomes))
    primeiro = tabelas.le_catalogo(spark, pasta)
    ambos = horas(5, 1).unionByName(horas(19, 2))
    cat = catalogo(depois)
    com = blocos.com_casas(cat, primeiro)
    em_blocos = blocos.em_blocos(horas(5, 1), primeiro).unionByName(blocos.em_blocos(horas(19, 2), com))
    casas = {r.descricao: (r.casa, r.inteiro) for r in com.collect()}
    assert len(set(c for c, _ in casas.values())) == 19
    assert {casas[f"M1-{s}"][0] // 4 for s in ("EAE", "EAR", "ERE", "ERR")} == {casas["M1-EAE"][0] // 4}
    assert {casas[d][0] for _, d in nomes} <= set(range(16)) and casas["Z"][0] == 8
    assert casas["M1-ERR"][1] and not casas["N5-EAE"][1]
    assert sorted(map(str, blocos.em_linhas(em_blocos, com).select(F.slice("valores", 1, 5).alias("v"), "data_hora").collect())) == sorted(
        map(str, ambos.select(F.slice("valores", 1, 5).alias("v"), "data_hora").collect())
    )
    pedidos = spark.createDataFrame([(c, *[f"{c}-{s}" for s in ("EAE", "EAR", "ERE", "ERR")]) for c in ("M1", "N5")], "codigo string, eae string, ear string, ere string, err string")
    elegiveis = base.tabelas_elegiveis(com, pedidos)
    assert {r.codigo: r.completo for r in elegiveis.collect()} == {"M1": True, "N5": False}
    for feito, certo in ((base.base_horaria(em_blocos, elegiveis), base.base_horaria(ambos, elegiveis)),
                         (composicao.base_leniente(em_blocos, base.lugares_nas_tabelas(com, pedidos.unionByName(pedidos.select(F.lit("Q").alias("codigo"), F.lit("Z").alias("eae"), F.lit("N0-EAE").alias("ear"), F.lit("nada").alias("ere"), F.lit("W").alias("err"))))),
                          composicao.base_leniente(ambos, base.lugares_nas_tabelas(com, pedidos.unionByName(pedidos.select(F.lit("Q").alias("codigo"), F.lit("Z").alias("eae"), F.lit("N0-EAE").alias("ear"), F.lit("nada").alias("ere"), F.lit("W").alias("err"))))))):
        colunas = ["codigo", "data_hora", "tabela_ordem", *base.LUGARES]
        assert sorted(map(str, feito.select(*colunas).collect())) == sorted(map(str, certo.select(*colunas).collect()))


def test_chosen_equipments_read_their_tables_only(spark, tmp_path):
    pasta = str(tmp_path)
    base_gravada(spark, pasta)
    lidas = tabelas.nas_tabelas(tabelas.le_medicoes(spark, pasta), ["t1", "t2"])
    texto = plano(lidas)
    assert "classe" in texto.split("PartitionFilters")[1].split("]")[0]
    assert {r.tabela for r in lidas.collect()} == {"t1", "t2"} and lidas.count() == 12


def test_scan_reads_only_what_the_query_needs(spark):
    texto = plano(kpi.estatisticas(base.demanda_horaria(entradas.horario(spark, PASTA), entradas.equipamentos(spark, PASTA))).select("codigo", "max_p"))
    (colunas,) = re.findall(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)", texto)
    assert "l_tax" not in colunas


def test_month_filter_reaches_the_scan(spark, tmp_path):
    caminho = str(tmp_path / "d")
    entradas.horario(spark, PASTA).write.parquet(caminho)
    texto = plano(base.no_periodo(spark.read.parquet(caminho), 1997, 3))
    assert "GreaterThanOrEqual(data_hora,1997-03-01" in texto and "LessThan(data_hora,1997-04-01" in texto


def test_measurements_are_not_shuffled_to_find_their_equipments(spark, tmp_path):
    caminho = str(tmp_path / "m")
    entradas.medicoes(spark, PASTA).write.parquet(caminho)
    elegiveis = spark.createDataFrame(
        [("A", "regiao_000000000_a", 0, 0, 1, 2, 3)],
        "codigo string, tabela string, tabela_ordem int, pos_eae int, pos_ear int, pos_ere int, pos_err int",
    )
    texto = plano(base.base_horaria(spark.read.parquet(caminho), elegiveis))
    assert "BroadcastHashJoin" in texto and "Exchange hashpartitioning" not in texto


def test_one_shuffle_keeps_hours_of_a_day_together(spark, tmp_path):
    caminho = str(tmp_path / "h")
    entradas.horario(spark, PASTA).write.parquet(caminho)
    texto = plano(base.primeira_tabela(spark.read.parquet(caminho)))
    assert len(re.findall(r"Exchange hashpartitioning\(codigo", texto)) == 1
    assert "SortAggregate" not in texto


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    antes = spark.conf.get("spark.sql.shuffle.partitions")
    def soma():
        return CONSULTAS["painel_demanda"](spark, PASTA).select(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    try:
        esperado = soma()
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert soma() == esperado
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", antes)

"""What is broadcast: only what was measured, and the measure is of the table that a broadcast makes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fasor.operators import base, cadastro, juncao, kpi, resumos

SUFIXOS = ("EAE", "EAR", "ERE", "ERR")


def plano(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def linhas(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def gravado(df, pasta):
    """From a small file: the planner takes what comes from it for small."""
    df.write.parquet(str(pasta))
    return df.sparkSession.read.parquet(str(pasta))


@pytest.fixture
def tudo_grande(monkeypatch):
    monkeypatch.setattr(juncao, "bytes_de", lambda df: juncao.LIMITE_BYTES + 1)
    for modulo in (kpi, resumos, base):
        monkeypatch.setattr(modulo, "materializa", lambda df: df)


def demanda(spark, pasta):
    """Three equipments, 300 hours over three months, whole numbers, with outliers."""
    horas = spark.range(900).select(
        F.concat(F.lit("E"), (F.col("id") % 3).cast("string")).alias("codigo"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / 3) * 7, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("data_hora"),
        F.lit(0).alias("tabela_ordem"),
        F.when(F.col("id") % 97 < 4, 5000 + F.col("id") * 3).otherwise(F.col("id") * 7 % 40).cast("double").alias("p"),
        (F.col("id") % 11).cast("double").alias("q"),
        (F.col("id") % 13 + 100).cast("double").alias("s"),
        F.lit(90.0).alias("potencia_instalada"),
        (F.col("id") % 2).cast("bigint").alias("ultrapassagem"),
    )
    return gravado(horas, pasta)


@pytest.mark.parametrize("espalhar_por", [[], ["id"]])
@pytest.mark.parametrize("como", ["inner", "left", "left_semi", "left_anti"])
def test_beyond_the_limit_nothing_is_broadcast(spark, tmp_path, como, espalhar_por):
    grande = spark.range(100).select(F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("k"), "id")
    dimensao = gravado(spark.createDataFrame([(0, "a"), (2, "b"), (2, "c"), (None, "d")], "k bigint, v string"), tmp_path / "d")
    junta = juncao.junta(grande, dimensao, ["k"], como, espalhar_por, limite_bytes=0)
    assert "Broadcast" not in plano(junta) and "SortMergeJoin" in plano(junta)
    assert linhas(junta) == linhas(juncao.junta(grande, dimensao, ["k"], como, espalhar_por))


def test_the_measure_is_of_the_broadcast_table(spark):
    dimensao = spark.range(10_000).select(F.format_string("F%09d", "id").alias("codigo"), F.col("id").cast("double").alias("x"))
    # Spark's own figure for such rows: 155 bytes a row at 324,000 rows, of which 42 are the row
    assert juncao.bytes_de(dimensao) == 42 * 10_000 and 120 * 10_000 < juncao.bytes_difundidos(dimensao, ["codigo"]) < 200 * 10_000
    junta = juncao.junta(dimensao, dimensao.withColumnRenamed("x", "y"), ["codigo"], espalhar_por=["x"], limite_bytes=juncao.bytes_de(dimensao))
    assert "Broadcast" not in plano(junta)


def test_registry_and_catalogue_are_not_broadcast(spark, tmp_path):
    nomes = [f"M{i}" for i in range(5)]
    medidores = [(f"{n}-{s}", f"SE {n}-{s}") for n in nomes for s in SUFIXOS if (n, s) != ("M4", "ERR")]
    canais = [(t, o, 4 * i + j, f"se {n}-{s}") for o, t in enumerate("tu") for i, n in enumerate(nomes[o:4]) for j, s in enumerate(SUFIXOS)]
    medidores = gravado(spark.createDataFrame([*medidores, (None, "x")], "codigo string, descricao string"), tmp_path / "m")
    catalogo = gravado(spark.createDataFrame([*canais, ("t", 0, 99, None)], "tabela string, tabela_ordem int, pos int, descricao string"), tmp_path / "c")
    codigos = gravado(spark.createDataFrame([(n,) for n in [*nomes, "outro"]], "codigo string"), tmp_path / "e")
    elegiveis = base.tabelas_elegiveis(catalogo, cadastro.completos(cadastro.resolve_canais(codigos, medidores)))
    assert "Broadcast" not in plano(elegiveis)
    assert sorted((r.codigo, r.tabela, r.pos_eae, r.pos_err) for r in elegiveis.collect()) == sorted(
        (n, t, 4 * i, 4 * i + 3) for o, t in enumerate("tu") for i, n in enumerate(nomes[o:4])
    )


@pytest.mark.parametrize("maiores", [1, resumos.MAIORES])
def test_panel_from_summaries_broadcasts_only_what_was_measured(spark, tmp_path, tudo_grande, maiores):
    horas = demanda(spark, tmp_path / "h")
    meses = gravado(resumos.resumo_mensal(horas, maiores), tmp_path / "r")
    lidos = []
    painel = resumos.painel(meses, lambda indecisos: lidos.append(plano(indecisos)) or horas)
    assert "Broadcast" not in plano(painel) and not any("Broadcast" in p for p in lidos)
    assert bool(lidos) == (maiores == 1)
    assert linhas(painel) == linhas(kpi.painel(horas))


def test_values_of_the_extremes_are_broadcast_once(spark, tmp_path):
    horas = demanda(spark, tmp_path / "h")
    painel = resumos.painel(gravado(resumos.resumo_mensal(horas), tmp_path / "r"), lambda _: horas)
    assert plano(painel).count("BroadcastExchange") == 1
    assert linhas(painel) == linhas(kpi.painel(horas))


def test_first_hour_of_extremes_from_summaries(spark):
    """The extremes recur in other months, and the least value is among the largest of its month."""
    p = [5.0, 9.0, 1.0, 9.0, 1.0, 5.0]
    linhas_ = [("a", datetime(2024, 1 + i // 2, 1, i), 0, v, float(i), 1.0, 10.0, 0) for i, v in enumerate(p)]
    horas = spark.createDataFrame(linhas_, "codigo string, data_hora timestamp_ntz, tabela_ordem int, p double, q double, s double, potencia_instalada double, ultrapassagem bigint")
    for maiores in (1, resumos.MAIORES):
        (r,) = resumos.painel(resumos.resumo_mensal(horas, maiores), lambda _: horas).collect()
        assert (r.instante_maximo, r.q_no_maximo) == (datetime(2024, 1, 1, 1), 1.0)
        assert (r.instante_minimo, r.q_no_minimo) == (datetime(2024, 2, 1, 2), 2.0)


def test_panel_broadcasts_only_what_was_measured(spark, tmp_path, request):
    horas = demanda(spark, tmp_path / "h")
    esperado = linhas(kpi.para_exibir(kpi.painel(horas)))
    request.getfixturevalue("tudo_grande")
    exibido = kpi.para_exibir(kpi.painel(horas))
    assert "Broadcast" not in plano(exibido) and linhas(exibido) == esperado

"""Semantics on hand-made rows, with expected values computed by hand or in pandas."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fasor.functions import eletrica, texto
from fasor.functions.numero import arredonda, numero_br, numero_ou_nulo, numeros_br
from fasor.functions.tempo import instante_da_ordem, le_data_hora, ordem_na_base, tabela_da_ordem, trunca_hora
from fasor.operators import base, cadastro, carga, coincidente, composicao, juncao, kpi, perfis

T0 = datetime(2024, 1, 1)


def um(spark, coluna):
    return spark.range(1).select(coluna.alias("x")).first()["x"]


# ---- scalar functions ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "cru, valor",
    [("1,5", 1.5), ("1.234,56", 0.0), ("", 0.0), (" ", 0.0), (None, 0.0), ("-", 0.0), ("1,5d", 0.0),
     ("0x1p3", 0.0), ("NaN", 0.0), ("Infinity", 0.0), (" 7 ", 7.0), ("+3", 3.0), (",5", 0.5), ("5,", 5.0),
     ("1e2", 100.0), ("1_000", 0.0), ("1 2", 0.0)],
)
def test_number(spark, cru, valor):
    assert um(spark, numero_br(F.lit(cru).cast("string"))) == valor
    if cru is not None:
        assert um(spark, numeros_br(F.lit(f"x;{cru};{cru}"))) == [0.0, valor, valor]


def test_number_without_default(spark):
    assert um(spark, numero_ou_nulo(F.lit("n/d"))) is None
    assert um(spark, numero_ou_nulo(F.lit("12.5"))) == 12.5


@pytest.mark.parametrize("x", [0.125, 1.015, 2.675, -0.125, 1e9 + 0.005, 0.5, 1.5, 2.5])
def test_rounding_is_numpys(spark, x):
    assert um(spark, arredonda(F.lit(x), 2)) == np.round(x, 2)
    assert um(spark, arredonda(F.lit(x))) == np.round(x)


def test_time_does_not_pass_through_the_session_zone(spark):
    zona = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        # midnight of 4 November 2018 did not exist there
        lido = spark.createDataFrame([("04/11/2018 00:30",)], "t string").select(
            le_data_hora(F.col("t")).alias("t")
        )
        linha = lido.select("t", trunca_hora(F.col("t")).alias("h")).selectExpr("cast(t as string)", "cast(h as string)").first()
        assert tuple(linha) == ("2018-11-04 00:30:00", "2018-11-04 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zona)


def test_far_dates_are_no_readings(spark):
    df = spark.createDataFrame([("31/12/9999 10:00",), ("01/01/3999 00:00",), ("01/01/1700 00:00",)], "t string")
    assert [r.t and r.t.year for r in df.select(le_data_hora(F.col("t")).alias("t")).collect()] == [None, 3999, None]


def test_order_key_round_trip(spark):
    pares = [(0, datetime(1969, 12, 31, 23)), (0, datetime(2024, 1, 1)), (3, datetime(1995, 5, 5, 5, 7, 9))]
    df = spark.createDataFrame(pares, "o int, t timestamp_ntz").withColumn("k", ordem_na_base(F.col("o"), F.col("t")))
    lidos = df.orderBy("k").select(tabela_da_ordem(F.col("k")), instante_da_ordem(F.col("k"))).collect()
    assert [tuple(r) for r in lidos] == pares


@pytest.mark.parametrize(
    "membro, tabela",
    [("Dados (Sinop - Norte).txt", "sinop___norte"), ("a (x) (y).txt", "x"), ("dir.v1/Meu Arquivo-01.txt", "meu_arquivo_01"),
     ("sem_extensao", "sem_extensao"), ("().txt", "()"), ("p(q)/r.txt", "q")],
)
def test_table_name(spark, membro, tabela):
    assert um(spark, texto.nome_tabela(F.lit(membro))) == tabela


def test_names(spark):
    assert um(spark, texto.normaliza_nome(F.lit(" Transf. Ação nº-1 "))) == "transfacaono1"
    assert um(spark, texto.normaliza_nome(F.lit("Æß½°§"))) == "aess12degSS"
    assert um(spark, texto.padroniza_coluna_tempo(F.lit(" data-hora"))) == "Data_Hora"
    assert um(spark, texto.padroniza_coluna_tempo(F.lit("datahora"))) == "datahora"
    assert um(spark, texto.codigo_relatorio(F.lit("F01"))) == "AL-F01"
    assert um(spark, texto.codigo_relatorio(F.lit("TR01"))) == "TR01"
    assert um(spark, texto.nome_equipamento(F.lit("SE 1-EAE"))) == "SE 1"


def test_policies(spark):
    linhas = [(3.0, 0.0, 4.0, 0.0), (0.0, 0.0, 0.0, 0.0), (None, 1.0, 2.0, 0.0), (-3.0, 0.0, 4.0, 0.0)]
    df = spark.createDataFrame(linhas, "eae double, ear double, ere double, err double")
    esperado = {
        "U": [(3, 4, 5, 0.6), (0, 0, 0, None), (None, 2, None, None), (-3, 4, 5, -0.6)],
        "C": [(3, 4, 5, 0.6), (0, 0, None, 0), (0, 2, 2, 0), (-3, 4, 5, -0.6)],
        "S": [(3, 4, 5, 0.6), (0, 0, 0, 0), (None, 2, None, None), (-3, 4, 5, -0.6)],
    }
    for politica, valores in esperado.items():
        lidos = base.com_potencias(df, politica).select("p", "q", "s", "fp").collect()
        assert [tuple(r) for r in lidos] == valores
    with pytest.raises(ValueError):
        eletrica.potencia_ativa(F.col("eae"), F.col("ear"), "Z")


@pytest.mark.parametrize("s, pot, marca", [(5.0, 5.0, 1), (4.9, 5.0, 0), (None, 5.0, 0), (1.0, 0.0, 1), (0.0, 0.0, 0), (1.0, None, 0)])
def test_overload(spark, s, pot, marca):
    assert um(spark, eletrica.ultrapassagem(F.lit(s).cast("double"), F.lit(pot).cast("double"))) == marca


# ---- key figures against pandas ------------------------------------------------------------


def figuras_em_pandas(p, q, potencia):
    """The figures of one equipment, straight from their definitions."""
    p, q = pd.Series(p, dtype=float), pd.Series(q, dtype=float)
    s = np.sqrt(p**2 + q**2)
    maximo, minimo, media_p = p.max(), p.min(), np.round(p.mean(), 0)
    inteiros = p.dropna()
    inteiros = inteiros[inteiros != 0].astype(int)
    desvio = inteiros.std()
    desvio = 0 if pd.isna(desvio) else int(desvio)
    abaixo = p[p < media_p + 3 * desvio]
    if len(abaixo):
        filtrado = abaixo.max()
        razao = maximo / filtrado if filtrado != 0 else (math.inf if maximo > 0 else math.nan)
        if razao > 1.10:
            maximo = filtrado
    media_q = np.round(q.mean(), 0)
    i_max, i_min = p.index[p == maximo], p.index[p == minimo]
    piso = np.round(media_p - 3.0 * desvio, 0)
    return {
        "max_p_robusto": maximo,
        "min_p_robusto": piso if minimo < piso else minimo,
        "max_s": np.round(s.max(), 2),
        "media_p": media_p,
        "media_q": media_q,
        "desvio_p": desvio,
        "fp_global": np.round(media_p / s.mean(), 2) if s.mean() else None,
        "carregamento_pct": np.sqrt(maximo**2 + media_q**2) / potencia * 100,
        "horas_ultrapassagem": int((s / potencia >= 1).sum()),
        "instante_maximo": T0 + timedelta(hours=int(i_max[0])),
        "q_no_maximo": q[i_max[0]],
        "instante_minimo": T0 + timedelta(hours=int(i_min[0])),
        "q_no_minimo": q[i_min[0]],
    }


def series():
    rng = np.random.default_rng(7)
    casos = {
        "plano": ([5.0] * 40, [1.0] * 40),
        "pico": ([10.0] * 50 + [500.0] + [11.0] * 50, [2.0] * 101),
        "vale": ([-900.0] + [100.0, 101.0] * 40, [0.0] * 81),
        "um": ([7.5], [3.0]),
        "negativo": (list(-rng.integers(1, 50, 60).astype(float)), [1.0] * 60),
        "fracoes": ([0.4, 0.4, 0.9, 3.2, 2.8, 0.0], [1.0, None, 2.0, 0.5, 0.5, 0.0]),
        "zeros": ([0.0] * 5, [0.0] * 5),
        "faltas": ([None, 3.0, None, 9.0, 9.0], [1.0, 2.0, 3.0, None, 5.0]),
    }
    for i in range(4):
        p = rng.normal(200, 30, 300).round(2)
        p[rng.integers(0, 300, 3)] *= 8
        casos[f"acaso{i}"] = (list(p), list(rng.normal(40, 9, 300).round(2)))
    return casos


def demanda_de(spark, casos, potencia):
    linhas = [
        (c, T0 + timedelta(hours=h), 0, pp if pp is None else float(pp), 0.0, qq if qq is None else float(qq), 0.0)
        for c, (p, q) in casos.items()
        for h, (pp, qq) in enumerate(zip(p, q))
    ]
    horas = spark.createDataFrame(
        linhas,
        "codigo string, data_hora timestamp_ntz, tabela_ordem int, eae double, ear double, ere double, err double",
    )
    equipamentos = spark.createDataFrame(
        [(i, c, potencia) for i, c in enumerate(casos)], "id bigint, codigo string, potencia_instalada double"
    )
    return base.demanda_horaria(horas, equipamentos)


def test_panel_against_pandas(spark):
    casos = series()
    lidos = {r.codigo: r for r in kpi.painel(demanda_de(spark, casos, 250.0)).collect()}
    assert set(lidos) == set(casos)
    for codigo, (p, q) in casos.items():
        for nome, esperado in figuras_em_pandas(p, q, 250.0).items():
            obtido = lidos[codigo][nome]
            if esperado is None or (isinstance(esperado, float) and math.isnan(esperado)):
                assert obtido is None, (codigo, nome)
            elif isinstance(esperado, datetime):
                assert obtido == esperado, (codigo, nome)
            else:
                assert obtido == pytest.approx(esperado, rel=1e-12), (codigo, nome)


def test_all_missing_keeps_its_row(spark):
    (linha,) = kpi.painel(demanda_de(spark, {"x": ([None, None], [None, None])}, 10.0)).collect()
    assert linha.codigo == "x" and linha.max_p_robusto is None and linha.instante_maximo is None
    assert linha.desvio_p == 0 and linha.horas_ultrapassagem == 0


def test_hot_equipment_and_lazy_forms_agree(spark, monkeypatch):
    casos = series()
    casos["quente"] = ([float(i % 97) for i in range(2000)], [1.0] * 2000)
    demanda = demanda_de(spark, casos, 250.0).persist()
    figuras = kpi.estatisticas(demanda)
    esperado = sorted(map(tuple, kpi.limites(demanda, figuras).collect()), key=str)
    extremos = sorted(map(tuple, kpi.extremos(demanda, kpi.limites(demanda, figuras)).collect()), key=str)
    # beyond the broadcast limit the joins are salted
    monkeypatch.setattr(juncao, "bytes_de", lambda df: juncao.LIMITE_BYTES + 1)
    assert sorted(map(tuple, kpi.limites(demanda, figuras).collect()), key=str) == esperado
    assert sorted(map(tuple, kpi.extremos(demanda, kpi.limites(demanda, figuras)).collect()), key=str) == extremos


@pytest.mark.parametrize("como", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, como):
    grande = spark.range(3000).select((F.col("id") % 7 * F.when(F.col("id") % 3 == 0, 0).otherwise(1)).alias("k"), "id")
    pequena = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "k bigint, v string")
    difundida = juncao.junta(grande, pequena, ["k"], como, ["id"])
    salgada = juncao.junta(grande, pequena, ["k"], como, ["id"], limite_bytes=0)
    assert "BroadcastHashJoin" in difundida._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, difundida.collect()), key=str) == sorted(map(tuple, salgada.collect()), key=str)


def test_size_counts_nested_text(spark):
    df = spark.sql("SELECT array('abc', repeat('x', 1000)) a, named_struct('t', repeat('y', 500)) s, map('k', repeat('z', 300)) m")
    assert 1800 < juncao.bytes_de(df) < 2200
    assert juncao.bytes_de(spark.sql("SELECT cast(null as array<string>) a, cast(null as struct<t:string>) s")) < 200


# ---- tables, coincident demand, composition ------------------------------------------------


def tabelas_de_teste(spark):
    """Equipment A in tables t1 and t2 (missing values at the first), B with other case in t1."""
    catalogo = spark.createDataFrame(
        [("t1", 0, 0, "A-EAE"), ("t1", 0, 1, "A-EAR"), ("t1", 0, 2, "A-ERE"), ("t1", 0, 3, "A-ERR"),
         ("t2", 1, 3, "A-EAE"), ("t2", 1, 2, "A-EAR"), ("t2", 1, 1, "A-ERE"), ("t2", 1, 0, "A-ERR"),
         ("t1", 0, 4, "b-eae"), ("t1", 0, 5, "b-ear"), ("t1", 0, 6, "b-ere"), ("t1", 0, 7, "b-err"),
         ("t3", 2, 0, "C-EAE"), ("t3", 2, 1, "C-EAR")],
        "tabela string, tabela_ordem int, pos int, descricao string",
    )
    h = [T0, T0 + timedelta(hours=1)]
    medicoes = spark.createDataFrame(
        [("t1", h[0], [None] * 4 + [8.0, 1.0, 1.0, 1.0]),
         ("t1", h[1], [5.0, 1.0, 3.0]),  # short row: places 3 to 7 were added later
         ("t2", h[0], [0.0, 4.0, 1.0, 4.0]),
         ("t2", h[1], [0.0, 40.0, 1.0, 40.0]),
         ("t3", h[0], [9.0, 2.0])],
        "tabela string, data_hora timestamp_ntz, valores array<double>",
    )
    codigos = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "codigo string")
    medidores = spark.createDataFrame(
        [(f"{c}-{s}", f"{c}-{s}") for c in "AB" for s in texto.SUFIXOS] + [("C-EAE", "C-EAE"), ("C-EAR", "C-EAR")],
        "codigo string, descricao string",
    )
    return medicoes, catalogo, codigos, medidores


def test_first_table_wins_even_with_missing_values(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    resolvidos = cadastro.completos(cadastro.resolve_canais(codigos, medidores))
    linhas = base.base_horaria(medicoes, base.tabelas_elegiveis(catalogo, resolvidos))
    assert linhas.count() == 6
    unicas = {
        (r.codigo, r.data_hora.hour): tuple(r)[2:] for r in base.primeira_tabela(linhas).collect()
    }
    assert unicas == {
        ("A", 0): (0, None, None, None, None),
        ("A", 1): (0, 5.0, 1.0, 3.0, None),
        ("B", 0): (0, 8.0, 1.0, 1.0, 1.0),
        ("B", 1): (0, None, None, None, None),
    }
    motivos = base.sem_dados(codigos, cadastro.resolve_canais(codigos, medidores), linhas)
    assert {tuple(r) for r in motivos.collect()} == {("C", "canal_sem_cadastro"), ("D", "canal_sem_cadastro")}


def test_one_table_needs_no_shuffle_and_gives_the_same(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    elegiveis = base.tabelas_elegiveis(catalogo, cadastro.completos(cadastro.resolve_canais(codigos, medidores)))
    esperado = sorted(map(tuple, base.primeira_tabela(base.base_horaria(medicoes, elegiveis)).select(
        "codigo", "data_hora", "tabela_ordem", *cadastro.LUGARES).collect()), key=str)
    assert sorted(map(tuple, base.base_unica(medicoes, elegiveis).collect()), key=str) == esperado
    so_b = base.base_unica(medicoes, base.dos_codigos(elegiveis, ["B"]))
    assert "Exchange hashpartitioning" not in so_b._jdf.queryExecution().executedPlan().toString()
    assert {r.codigo for r in so_b.collect()} == {"B"}
    assert base.base_unica(medicoes, base.dos_codigos(elegiveis, [])).count() == 0


def test_coincident(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    resolvidos = cadastro.completos(cadastro.resolve_canais(codigos, medidores))
    lidos = coincidente.demanda_coincidente(medicoes, carga.presenca(medicoes), catalogo, resolvidos, T0).collect()
    # t1 gives a row of zeros, t2 gives P = 3 and Q = 4; B fails the exact name test
    assert [tuple(r) for r in lidos] == [("A", T0, 3.0, 4.0, 5.0, 0.6)]
    assert coincidente.com_titulos(
        coincidente.demanda_coincidente(medicoes, carga.presenca(medicoes), catalogo, resolvidos, T0)
    ).columns == ["Equipamento", "Data/Hora", "Potência Ativa (kW)", "Potência Reativa (kvar)", "Potência Aparente (kVA)", "FP"]
    with pytest.raises(ValueError):
        base.no_instante(medicoes, datetime(2024, 1, 1, 0, 30))


def test_coincident_leaves_out_tables_without_any_eae(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    resolvidos = cadastro.completos(cadastro.resolve_canais(codigos, medidores))
    sem_eae = medicoes.filter("tabela = 't1'").withColumn(
        "valores", F.array(F.lit(None).cast("double"), F.lit(1.0), F.lit(7.0), F.lit(1.0))
    )
    linhas = coincidente.linhas_no_instante(sem_eae, carga.presenca(sem_eae), catalogo, resolvidos, T0)
    assert linhas.count() == 0


def test_coincident_of_all_is_the_union_of_singles(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    catalogo = catalogo.withColumn("descricao", F.upper("descricao"))
    resolvidos = cadastro.completos(cadastro.resolve_canais(codigos, medidores))
    todos = coincidente.demanda_coincidente(medicoes, carga.presenca(medicoes), catalogo, resolvidos, T0).collect()
    sozinhos = [
        r
        for c in ("A", "B")
        for r in coincidente.demanda_coincidente(
            medicoes, carga.presenca(medicoes), catalogo, resolvidos.filter(F.col("codigo") == c), T0
        ).collect()
    ]
    assert sorted(map(tuple, todos)) == sorted(map(tuple, sozinhos)) and len(todos) == 2


def test_composition(spark):
    medicoes, catalogo, codigos, medidores = tabelas_de_teste(spark)
    lugares = base.lugares_nas_tabelas(catalogo, cadastro.resolve_canais(codigos, medidores))
    termos = composicao.composicao_spec(
        spark.createDataFrame(
            [("so_b", 1, "B", "Subtrair"), ("b_menos_c", 1, "B", None), ("b_menos_c", 2, "C", "Subtrair"),
             ("b_menos_c", 3, "", "Somar"), ("b_mais_d", 1, "D", None), ("b_mais_d", 2, "B", "Somar"),
             ("b_duas_vezes", 1, "B", None), ("b_duas_vezes", 2, "B", "Somar"), ("a_menos_b", 1, "A", None),
             ("a_menos_b", 2, "B", "Subtrair")],
            "formula string, ordem int, codigo string, operador string",
        )
    )
    lidos = {
        (r.formula, r.data_hora.hour): (r.p, r.q) for r in composicao.demanda_composta(medicoes, lugares, termos).collect()
    }
    assert lidos[("so_b", 0)] == (7.0, 0.0)
    assert lidos[("b_menos_c", 0)] == (0.0, 0.0)  # C: P = 7, and Q = 0 as it has no such channel
    assert lidos[("b_mais_d", 0)] == (7.0, 0.0)  # D has no channel at all: adds 0
    assert lidos[("b_duas_vezes", 0)] == (14.0, 0.0)
    assert lidos[("a_menos_b", 0)] == (None, None)  # A is missing in its first table
    assert lidos[("b_menos_c", 1)] == (None, None)


# ---- registry, upsert, report --------------------------------------------------------------


def test_registry_edits(spark):
    cad = spark.createDataFrame(
        [(1, "A", 10.0), (2, "B", 20.0), (3, "C", None)], "id bigint, codigo string, potencia_instalada double"
    )
    mud = spark.createDataFrame(
        [(1, "U", "A2", ""), (2, "D", "", ""), (3, "U", "C", "7.5"), (9, "U", "Z", "1")],
        "id bigint, op string, codigo string, potencia_instalada string",
    )
    assert sorted(map(tuple, cadastro.atualiza(cad, mud).collect())) == [(1, "A2", None), (2, "B", 20.0), (3, "C", 7.5)]
    assert sorted(r.id for r in cadastro.exclui(cad, mud).collect()) == [1, 3]
    # several changes of one id: the last counts; what cannot be read changes nothing and is reported
    varias = spark.createDataFrame(
        [(1, "U", "A3", "5", 1), (1, "U", "A4", "abc", 2), (2, "U", "B2", "7", 9), (2, "U", "B1", "6", 8), (7, "U", "x", "abc", 1)],
        "id bigint, op string, codigo string, potencia_instalada string, n int",
    )
    assert sorted(map(tuple, cadastro.atualiza(cad, varias, ordem="n").collect())) == [
        (1, "A4", 10.0), (2, "B2", 7.0), (3, "C", None),
    ]
    assert [tuple(r) for r in cadastro.mudancas_ilegiveis(cad, varias, ordem="n").collect()] == [
        (1, "potencia_instalada", "abc")
    ]
    dic = spark.createDataFrame([("k1", "velho")], "codigo string, descricao string")
    novos = spark.createDataFrame(
        [("k1", "novo", 1), ("k2", "b", 3), ("k2", "a", 2), (None, "x", 0)], "codigo string, descricao string, n int"
    )
    assert sorted(map(tuple, cadastro.insere_ou_ignora(dic, novos, "n").collect())) == [("k1", "velho"), ("k2", "a")]


def test_upsert_modes(spark):
    esquema = "tabela string, data_hora timestamp_ntz, valores array<double>"
    atuais = spark.createDataFrame([("t", T0, [1.0, 2.0])], esquema)
    novas = spark.createDataFrame(
        [("t", T0, [None, 5.0, None], "a"), ("t", T0, [None, None, 6.0], "b")], esquema + ", arquivo string"
    )
    assert carga.upsert(atuais, novas).first().valores == [None, None, 6.0]
    assert carga.upsert(atuais, novas, "celula").first().valores == [1.0, 5.0, 6.0]
    with pytest.raises(ValueError):
        carga.upsert(atuais, novas, "outro")


def test_monthly_report(spark):
    maximas = spark.createDataFrame(
        [("SE 1", "AL-F1", "10.5", "n/d", None, "x"), ("SE 2", "TR2", "1", "2", "3", "y")],
        "descricao string, codigo string, `Janeiro 2024` string, `Março 2024` string, Dezembro string, Obs string",
    )
    codigos = spark.createDataFrame([("F1",), ("F1",), (None,)], "codigo string")
    assert sorted(map(tuple, perfis.demanda_mensal(maximas, codigos).collect())) == [
        ("SE 1", "AL-F1", "Dezembro", None),
        ("SE 1", "AL-F1", "Janeiro 2024", 10.5),
        ("SE 1", "AL-F1", "Março 2024", None),
    ]


def test_period_filter(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 12, 31, 23),), (datetime(2024, 1, 1),), (datetime(2024, 12, 31, 23),), (datetime(2025, 1, 1),)],
        "data_hora timestamp_ntz",
    )
    assert base.no_periodo(df, 2024).count() == 2
    assert [r.data_hora for r in base.no_periodo(df, 2024, 12).collect()] == [datetime(2024, 12, 31, 23)]


def test_edits_in_order_against_a_loop(spark):
    """Mixed edits of a few ids, one of them very often, applied one by one."""
    sorte = random.Random(11)
    inicio = {i: (f"c{i}", float(i)) for i in range(0, 40, 2)}
    edicoes = []
    for ordem in range(900):
        i = 7 if ordem % 3 == 0 else sorte.randrange(45)
        op = sorte.choice("IUUUDX")
        edicoes.append((i, op, ordem, sorte.choice([None, "", f"n{ordem}"]), sorte.choice([None, "", "abc", str(ordem)])))
    estado, ruins = dict(inicio), {}
    for i, op, ordem, codigo, potencia in edicoes:
        ilegivel = [(i, ordem, "potencia_instalada", "abc")] if potencia == "abc" else []
        numero = float(potencia) if potencia and not ilegivel else None
        if op == "D":
            estado.pop(i, None)
            ruins.pop(i, None)
        elif op == "I" and i not in estado:
            estado[i], ruins[i] = (codigo or None, numero), ilegivel
        elif op == "U" and i in estado:
            c, p = estado[i]
            c = c if codigo is None else codigo or None
            p = None if potencia == "" else p if numero is None else numero
            estado[i], ruins[i] = (c, p), ruins.get(i, []) + ilegivel
    registro = spark.createDataFrame([(i, *v) for i, v in inicio.items()], "id bigint, codigo string, potencia_instalada double")
    df = spark.createDataFrame(edicoes, "id bigint, op string, ordem bigint, codigo string, potencia_instalada string").repartition(6)
    assert {r.id: (r.codigo, r.potencia_instalada) for r in cadastro.aplica(registro, df).collect()} == estado
    assert sorted(map(tuple, cadastro.edicoes_ilegiveis(registro, df).collect())) == sorted(x for r in ruins.values() for x in r)
    # no edits, no registry, columns that the edits lack
    assert cadastro.aplica(registro, df.filter("false")).count() == 20
    assert cadastro.aplica(registro.filter("false"), df.filter("op = 'U'")).count() == 0
    so_codigo = cadastro.aplica(registro, df.drop("potencia_instalada")).collect()
    assert {r.id for r in so_codigo} == set(estado)

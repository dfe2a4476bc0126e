"""Summaries that a base keeps: the same figures, and only what changed is read again."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fasor.operators import base, cadastro, carga, kpi, resumos
from fasor.plans import resumidos
from fasor.plans.ingestao import guarda
from fasor.sources import publicacao, tabelas

SUFIXOS = ("EAE", "EAR", "ERE", "ERR")
NOMES = [("t", 0, f"M{m}") for m in range(8)] + [("u", 1, f"M{m}") for m in range(5, 12)]


def catalogo(spark):
    lugar = {"t": 0, "u": 0}
    linhas = []
    for tabela, ordem, nome in NOMES:
        for s in SUFIXOS:
            linhas.append((tabela, ordem, lugar[tabela], f"{nome}-{s}", f"{nome}{s}".lower(), "REAL"))
            lugar[tabela] += 1
    return spark.createDataFrame(linhas, carga.ESQUEMA_CATALOGO)


def medidas(spark, meses, semente=0):
    """Whole numbers with outliers, repeated values and missing ones."""
    inicios = spark.createDataFrame([(datetime(a, m, 1),) for a, m in meses], "t timestamp_ntz")
    horas = inicios.select(F.explode(F.sequence(F.lit(0), F.lit(400), F.lit(7))).alias("h"), "t").select(
        F.timestamp_add("HOUR", "h", "t").alias("data_hora"), "h"
    )
    n = {t: 4 * sum(x == t for x, _, _ in NOMES) for t in ("t", "u")}
    sorte = lambda i: F.pmod(F.xxhash64("tabela", "data_hora", i, F.lit(semente)), F.lit(1000))
    valor = lambda i: F.when(sorte(i) > 985, sorte(i) * 90).when(sorte(i) < 30, None).otherwise(F.floor(sorte(i) / 100)).cast("double")
    return horas.crossJoin(spark.createDataFrame(list(n.items()), "tabela string, n int")).select(
        "tabela", "data_hora", F.transform(F.sequence(F.lit(1), "n"), valor).alias("valores")
    )


def registro(spark, potencia_de_3=500.0):
    nomes = sorted({n for _, _, n in NOMES})
    equipamentos = spark.createDataFrame(
        [(i, n, potencia_de_3 if n == "M3" else None if n == "M4" else 300.0) for i, n in enumerate(nomes)], "id bigint, codigo string, potencia_instalada double"
    )
    medidores = spark.createDataFrame([(f"{n}-{s}", f"{n}-{s}") for n in nomes for s in SUFIXOS], "codigo string, descricao string")
    return equipamentos, medidores


def direto(spark, pasta, equipamentos, medidores):
    canais = cadastro.completos(cadastro.resolve_canais(cadastro.codigos_distintos(equipamentos), medidores))
    elegiveis = base.tabelas_elegiveis(tabelas.le_catalogo(spark, pasta), canais)
    return kpi.painel(base.demanda(tabelas.le_medicoes(spark, pasta), elegiveis, equipamentos))


def linhas(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("maiores", [1, 2, resumos.MAIORES])
def test_figures_from_summaries(spark, tmp_path, maiores, monkeypatch):
    """Also where a month keeps fewer values than it has outliers, so that hours are read again."""
    pasta = str(tmp_path)
    guarda(spark, pasta, medidas(spark, [(2021, m) for m in range(1, 6)]), catalogo(spark))
    certo = resumos.resumo_mensal
    monkeypatch.setattr(resumos, "resumo_mensal", lambda d: certo(d, maiores))
    refeitos = []
    original = resumidos._demanda
    monkeypatch.setattr(resumidos, "_demanda", lambda *a: refeitos.append(a[3]) or original(*a))
    achado = resumidos.painel(spark, pasta, *registro(spark))
    assert linhas(achado) == linhas(direto(spark, pasta, *registro(spark)))
    assert achado.count() == 11 and (len(refeitos) > 1) == (maiores < resumos.MAIORES)


def test_only_changed_months_and_equipments_are_read(spark, tmp_path, monkeypatch):
    pasta = str(tmp_path)
    todos = [(2021, m) for m in range(1, 5)]
    guarda(spark, pasta, medidas(spark, todos), catalogo(spark))
    pedidos = []
    original = resumidos._demanda

    def espia(spark, base, agora, meses, elegiveis, equipamentos):
        lidas = tabelas.le_medicoes(spark, base, agora.nos_meses(meses)).inputFiles()
        meses_lidos = {tuple(int(p.split("=")[1]) for p in f.split("/") if p.startswith(("ano=", "mes="))) for f in lidas}
        pedidos.append((meses_lidos, {r.codigo for r in elegiveis.select("codigo").collect()}))
        return original(spark, base, agora, meses, elegiveis, equipamentos)

    monkeypatch.setattr(resumidos, "_demanda", espia)
    um = resumidos.atualiza(spark, pasta, *registro(spark))
    assert [p[0] for p in pedidos] == [set(todos)]
    assert resumidos.atualiza(spark, pasta, *registro(spark)) == um and len(pedidos) == 1  # nothing new, nothing read
    guarda(spark, pasta, medidas(spark, [(2021, 3), (2021, 5)], semente=1), catalogo(spark))
    dois = resumidos.atualiza(spark, pasta, *registro(spark))
    assert pedidos[1][0] == {(2021, 3), (2021, 5)}
    assert {m for m, c in dois.particoes.items() if um.particoes.get(m) == c} == {(2021, 1), (2021, 2), (2021, 4)}
    assert linhas(resumidos.painel(spark, pasta, *registro(spark))) == linhas(direto(spark, pasta, *registro(spark)))
    # another installed power: that equipment only
    del pedidos[:]
    outro = registro(spark, 7.0)
    assert linhas(resumidos.painel(spark, pasta, *outro)) == linhas(direto(spark, pasta, *outro))
    assert pedidos[0][1] == {"M3"}
    # an equipment that goes, and one that comes back
    sem = outro[0].filter("codigo <> 'M3'")
    assert linhas(resumidos.painel(spark, pasta, sem, outro[1])) == linhas(direto(spark, pasta, sem, outro[1]))
    assert linhas(resumidos.painel(spark, pasta, *outro)) == linhas(direto(spark, pasta, *outro))


def test_a_refresh_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    pasta = str(tmp_path)
    guarda(spark, pasta, medidas(spark, [(2021, 1)]), catalogo(spark))
    antes = linhas(resumidos.painel(spark, pasta, *registro(spark)))
    guarda(spark, pasta, medidas(spark, [(2021, 1)], semente=2), catalogo(spark))

    def morre(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(resumidos, "publica", morre)
        with pytest.raises(RuntimeError):
            resumidos.atualiza(spark, pasta, *registro(spark))
    assert linhas(resumos.painel(resumidos.le_resumos(spark, pasta), lambda _: None)) == antes
    assert linhas(resumidos.painel(spark, pasta, *registro(spark))) == linhas(direto(spark, pasta, *registro(spark))) != antes
    assert len(publicacao.limpa(spark, f"{pasta}/resumos", 1, 0)) >= 2


def test_empty_base(spark, tmp_path):
    assert resumidos.painel(spark, str(tmp_path), *registro(spark)).count() == 0

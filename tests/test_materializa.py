"""Where shared results go, and that nothing depends on them being written."""

import os

import pytest

from fasor.operators import materializa as m
from fasor.plans.consultas import CONSULTAS

PASTA = "/root/testdata/sf0.001"


def linhas(df):
    return sorted(map(str, df.collect()))


def test_goes_to_the_folder_the_session_names(spark):
    pasta = spark.conf.get("spark.checkpoint.dir")
    assert m.pasta_compartilhada(spark) == pasta
    df = spark.range(10).selectExpr("id", "cast(null as timestamp_ntz) t", "array(id * 0.5d) v")
    escrita = m.materializa(df)
    assert escrita.schema.simpleString() == df.schema.simpleString() and linhas(escrita) == linhas(df)
    assert all(f.startswith(f"file://{pasta}/fasor/") for f in escrita.inputFiles())
    assert os.path.isdir(f"{pasta}/fasor")


class Sessao:
    """A session that names no folder."""

    def __init__(self, spark, local):
        self.conf = type("C", (), {"get": staticmethod(lambda chave, padrao: padrao)})
        self.sparkContext = type("S", (), {"isLocal": local, "applicationId": f"teste-{local}", "master": "x"})


def test_without_a_folder_one_machine_gets_its_own_and_a_cluster_is_told(spark):
    pasta = m.pasta_compartilhada(Sessao(spark, True))
    assert os.path.isdir(pasta) and m.pasta_compartilhada(Sessao(spark, True)) == pasta
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        m.pasta_compartilhada(Sessao(spark, False))


def test_results_can_be_dropped(spark):
    with m.provisorios() as escritos:
        a = m.materializa(spark.range(3))
    m.materializa(spark.range(4))
    (onde,) = escritos
    assert a.count() == 3 and os.path.isdir(onde)
    m.apaga(spark, escritos)
    assert not os.path.exists(onde) and escritos == []


def test_session_zone_does_not_matter(spark):
    nomes = ("painel_demanda", "agrega_hora", "serie_anual")
    em_utc = {n: linhas(CONSULTAS[n](spark, PASTA)) for n in nomes}
    zona = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Cuiaba")
        for n in nomes:
            assert linhas(CONSULTAS[n](spark, PASTA)) == em_utc[n]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zona)

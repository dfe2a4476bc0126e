"""Every registered query against its SQL, over the smallest data set."""

import pytest
from compara import conexao, diferenca

import __spark_entry__ as entrada
from fasor.plans.consultas import CONSULTAS
from fasor.plans.oraculo import SQL

PASTA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return conexao(PASTA)


def test_every_query_has_sql():
    assert set(CONSULTAS) == set(SQL)
    assert set(CONSULTAS) <= set(entrada.queries()) and set(entrada.oracle_sql()) <= set(entrada.queries())


@pytest.mark.parametrize("nome", sorted(entrada.oracle_sql()))
def test_query(spark, con, nome):
    assert diferenca(spark, con, nome, PASTA) is None


def test_entry(spark):
    assert entrada.entry(spark).count() > 0


def test_all_reasons_occur(spark):
    motivos = {r.motivo for r in CONSULTAS["equipamentos_sem_dados"](spark, "/root/testdata/sf0.01").collect()}
    assert motivos == {"canal_sem_cadastro", "sem_potencia_instalada", "sem_medicao"}

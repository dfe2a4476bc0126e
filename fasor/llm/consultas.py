"""The queries of the operators, over the whole tables they are meant for, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fasor.llm import bpe, busca, conversas, descontaminacao, empacotamento, exatos, fragmentos, idioma, jaccard, paginas, paragrafos, segredos, toxicidade
from fasor.llm.comum import le, leva_codigo

_OPERADORES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_empacotamento": lambda s, d: empacotamento.op1_empacotamento(le(s, d, "documents")),
    "op2_segredos": lambda s, d: segredos.op2_segredos(le(s, d, "documents")),
    "op3_idioma": lambda s, d: idioma.op3_idioma(le(s, d, "documents")),
    "op4_jaccard": lambda s, d: jaccard.op4_jaccard(s, le(s, d, "documents")),
    "op5_fragmentos": lambda s, d: fragmentos.op5_fragmentos(s, le(s, d, "documents")),
    "op6_descontaminacao": lambda s, d: descontaminacao.op6_descontaminacao(le(s, d, "documents"), le(s, d, "benchmark")),
    "op7_paragrafos": lambda s, d: paragrafos.op7_paragrafos(le(s, d, "documents")),
    "op8_toxicidade": lambda s, d: toxicidade.op8_toxicidade(le(s, d, "documents"), le(s, d, "labels")),
    "op9_exatos": lambda s, d: exatos.op9_exatos(s, le(s, d, "documents")),
    "op10_paginas": lambda s, d: paginas.op10_paginas(le(s, d, "pages")),
    "op11_conversas": lambda s, d: conversas.op11_conversas(le(s, d, "conversations")),
    "op12_busca": lambda s, d: busca.op12_busca(s, le(s, d, "documents"), le(s, d, "benchmark")),
    "op13_bpe": lambda s, d: bpe.op13_bpe(le(s, d, "documents")),
}


def _consulta(operador: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def consulta(spark: SparkSession, pasta: str) -> DataFrame:
        leva_codigo(spark)
        return operador(spark, pasta)

    return consulta


CONSULTAS = {nome: _consulta(operador) for nome, operador in _OPERADORES.items()}

SQL: dict[str, str] = {
    "op4_jaccard": jaccard.SQL,
    "op6_descontaminacao": descontaminacao.SQL,
    "op9_exatos": exatos.SQL,
    "op11_conversas": conversas.SQL,
    "op12_busca": busca.SQL,
}

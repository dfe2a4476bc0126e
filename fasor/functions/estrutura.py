"""Shape of expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def calcula_uma_vez(*colunas: Column) -> Column:
    """Generator that gives its columns, one output row per input row.

    The optimiser moves neither filters nor expressions through a generated column. A costly value
    that later steps use is thus computed once per row: not again inside a filter or a join
    condition, nor once per element inside a lambda.
    """
    return F.inline(F.array(F.struct(*colunas)))

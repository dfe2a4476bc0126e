"""Run queries in Spark and their SQL in DuckDB, and compare rows as multisets.

    python tests/compara.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABELAS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def conexao(pasta: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABELAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{pasta}/{t}.parquet'")
    return con


def _celula(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if hasattr(v, "isoformat"):
        return v.isoformat(" ")
    return v


def linhas_spark(df) -> tuple[list[str], Counter]:
    colunas = sorted(df.columns)
    linhas = df.select(*[f"`{c}`" for c in colunas]).collect()
    return colunas, Counter(tuple(_celula(v) for v in r) for r in linhas)


def linhas_duckdb(con, sql: str) -> tuple[list[str], Counter]:
    res = con.execute(sql)
    nomes = [c[0] for c in res.description]
    ordem = sorted(range(len(nomes)), key=lambda i: nomes[i])
    linhas = res.fetchall()
    return [nomes[i] for i in ordem], Counter(tuple(_celula(r[i]) for i in ordem) for r in linhas)


def diferenca(spark, con, nome: str, pasta: str) -> str | None:
    """None when both sides agree, else what differs first."""
    import __spark_entry__ as entrada

    cols_s, rows_s = linhas_spark(entrada.queries()[nome](spark, pasta))
    cols_d, rows_d = linhas_duckdb(con, entrada.oracle_sql()[nome])
    if cols_s != cols_d:
        return f"columns {cols_s} != {cols_d}"
    if rows_s != rows_d:
        so_s, so_d = rows_s - rows_d, rows_d - rows_s
        return (
            f"rows {sum(rows_s.values())} / {sum(rows_d.values())},"
            f" only Spark {sum(so_s.values())}: {list(so_s)[:3]},"
            f" only SQL {sum(so_d.values())}: {list(so_d)[:3]}"
        )
    if not rows_s:
        return "both empty"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entrada

    from fasor.session import sessao

    pasta = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    nomes = sys.argv[2:] or sorted(entrada.queries())
    spark = sessao("compara", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con = conexao(pasta)
    ruins = 0
    for nome in nomes:
        inicio = time.time()
        try:
            erro = diferenca(spark, con, nome, pasta)
        except Exception as exc:  # report and go on with the next query
            erro = f"{type(exc).__name__}: {str(exc)[:600]}"
        ruins += erro is not None
        print(f"{'ok ' if erro is None else 'BAD'} {nome} {time.time() - inicio:.2f}s {erro or ''}", flush=True)
    print(f"{len(nomes) - ruins} of {len(nomes)} agree")

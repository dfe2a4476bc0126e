"""Pack documents into bins of a fixed number of tokens, best fit under conflicts.

Rows are dealt by the hash of their id to groups of about ``por_grupo`` pieces; each group is packed on its own, pieces
in decreasing size (those with duplicates in the group before the others, while all bins have room), into bins kept in the order of their residual. A bin carries two bitmaps: of the duplicate clusters
that it holds, and of the sources that have filled their quota in it. A piece goes to the tightest bin that fits and
has neither bit: the search starts at the least sufficient residual and moves on to the next bin until one is
compatible, else a new bin is opened. Pieces alike in size, cluster and source go on where the last one stopped, since
what refused the last one refuses them too.

A document longer than a bin is cut into full bins and a rest; the rest is packed. Nothing is dropped: documents
without tokens take a place of length 0. Any number of copies of one text may exist; each needs another bin.

Defined results: NULL length counts as 0, as do negative ones. NULL cluster means no duplicates; NULL source is a
source of its own. Repeated rows are packed each. Ties go by id and row. No rows give no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fasor.llm.comum import materializa, minusculas

CAPACIDADE = 8192
POR_FONTE = 8
POR_GRUPO = 20_000


def empacota_grupo(itens: list[tuple], capacidade: int, por_fonte: int) -> list[tuple[int, int]]:
    """Bin and offset of each item (size, cluster or None, source), in the given order of preference.

    Items have to come in the order in which they are placed. Equal items should be neighbours.
    """
    quantos = Counter(c for _, c, _ in itens if c is not None)
    bit_do_cluster = {c: 1 << i for i, c in enumerate(c for c, n in quantos.items() if n > 1)}
    bit_da_fonte = {f: 1 << i for i, f in enumerate(dict.fromkeys(f for _, _, f in itens))}
    ordem: list[tuple[int, int]] = []  # (residual, bin), sorted
    resto: list[int] = []
    clusters: list[int] = []
    cheias: list[int] = []
    da_fonte: list[dict] = []
    saida = []
    anterior, retoma = None, (0, -1)
    for item in itens:
        tamanho, cluster, fonte = item
        bc, bf = bit_do_cluster.get(cluster, 0), bit_da_fonte[fonte]
        # what refused an equal item before still refuses: only the bin taken then has changed, and it has the bit now
        i = bisect_left(ordem, retoma if item == anterior and bc else (tamanho, -1))
        while i < len(ordem) and (clusters[ordem[i][1]] & bc or cheias[ordem[i][1]] & bf):
            i += 1
        if i < len(ordem):
            retoma = ordem.pop(i)
            caixa = retoma[1]
        else:
            caixa = len(resto)
            resto.append(capacidade)
            clusters.append(0)
            cheias.append(0)
            da_fonte.append({})
            retoma = (capacidade + 1, -1)
        anterior = item
        saida.append((caixa, capacidade - resto[caixa]))
        resto[caixa] -= tamanho
        clusters[caixa] |= bc
        n = da_fonte[caixa][fonte] = da_fonte[caixa].get(fonte, 0) + 1
        if n >= por_fonte:
            cheias[caixa] |= bf
        insort(ordem, (resto[caixa], caixa))
    return saida


def empacota(
    docs: DataFrame,
    tamanho: Column,
    cluster: Column,
    fonte: Column,
    id: str = "doc_id",
    capacidade: int = CAPACIDADE,
    por_fonte: int = POR_FONTE,
    por_grupo: int = POR_GRUPO,
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, token_start, n_tokens, bin_id, bin_offset.

    ``bin_id`` is ``group:number``. The number of groups follows the number of pieces, so a task holds the sizes of
    about ``por_grupo`` pieces, never a text.
    """
    n = F.greatest(F.coalesce(tamanho.cast("bigint"), F.lit(0)), F.lit(0))
    itens = materializa(
        docs.select(
            F.col(id).cast("bigint").alias("doc_id"),
            n.alias("__n"),
            cluster.cast("bigint").alias("cluster"),
            fonte.cast("string").alias("fonte"),
        )
    )
    # all pieces but the last fill a bin; a document without tokens is one empty piece
    ultimo = F.greatest(F.ceil(F.col("__n") / F.lit(capacidade)) - 1, F.lit(0))
    pecas = itens.select(
        "doc_id", "cluster", "fonte", "__n", F.explode(F.sequence(F.lit(0).cast("bigint"), ultimo)).alias("piece")
    ).select(
        "doc_id",
        "cluster",
        "fonte",
        "piece",
        (F.col("piece") * capacidade).alias("token_start"),
        F.least(F.col("__n") - F.col("piece") * capacidade, F.lit(capacidade)).alias("n_tokens"),
    )
    total = itens.select(F.sum(ultimo + 1)).first()[0] or 0
    grupos = -(-total // por_grupo) or 1
    pecas = pecas.withColumn("grupo", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens", "cluster", "fonte"), F.lit(grupos)))

    def grupo(linhas: pd.DataFrame) -> pd.DataFrame:
        copias = linhas["cluster"].map(linhas["cluster"].value_counts()) > 1
        linhas = linhas.assign(copias=copias).sort_values(
            ["copias", "n_tokens", "cluster", "fonte", "doc_id", "piece"],
            ascending=[False, False, True, True, True, True],
            kind="stable",
        )
        itens = [
            (int(n), None if pd.isna(c) else int(c), f if isinstance(f, str) else None)
            for n, c, f in zip(linhas["n_tokens"], linhas["cluster"], linhas["fonte"])
        ]
        lugares = empacota_grupo(itens, capacidade, por_fonte)
        return linhas.assign(
            bin_id=[f"{g}:{c}" for g, (c, _) in zip(linhas["grupo"], lugares)], bin_offset=[o for _, o in lugares]
        )[["doc_id", "piece", "token_start", "n_tokens", "bin_id", "bin_offset"]]

    return pecas.groupBy("grupo").applyInPandas(
        grupo, "doc_id bigint, piece bigint, token_start bigint, n_tokens bigint, bin_id string, bin_offset bigint"
    )


def cluster_de_copias(texto: Column) -> Column:
    """Equal texts (A-Z lower-cased) are one cluster; NULL is in none."""
    return F.when(texto.isNotNull(), F.xxhash64(minusculas(texto)))


def n_palavras(texto: Column) -> Column:
    """Words between white space; NULL has none."""
    return F.coalesce(F.regexp_count(texto, F.lit(r"\S+")), F.lit(0))


def op1_empacotamento(documentos: DataFrame) -> DataFrame:
    return empacota(documentos, n_palavras(F.col("text")), cluster_de_copias(F.col("text")), F.col("source"))

"""Exact dedup against the index, and shards: hand-made rows, brute force, plans."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fasor.llm import exatos, fragmentos
from fasor.llm.comum import le

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"


def docs(spark, linhas):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x") for i, t in linhas], DOCS)


def digesto(t):
    return hashlib.sha256("".join(c.lower() if c.isascii() else c for c in t or "").encode()).hexdigest()


def test_exact_rows(spark):
    linhas = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000)]
    linhas += [(10 + i, "quente") for i in range(300)]
    r = {x.doc_id: x for x in exatos.op9_exatos(spark, docs(spark, linhas)).collect()}
    assert len(r) == len(linhas)
    por_digesto = defaultdict(list)
    for i, t in linhas:
        por_digesto[digesto(t)].append(i)
    for i, t in linhas:
        grupo = por_digesto[digesto(t)]
        assert (r[i].keep_id, r[i].group_size, r[i].kept, r[i].text_sha256) == (
            max(grupo), len(grupo), i == max(grupo), digesto(t),
        )


def test_exact_empty_table_and_repeated_rows(spark):
    assert exatos.op9_exatos(spark, docs(spark, [])).count() == 0
    iguais = exatos.op9_exatos(spark, docs(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")])).collect()
    assert Counter(x.kept for x in iguais) == {True: 2, False: 3}  # one row of each text
    assert {x.keep_id for x in iguais if x.text_sha256 == digesto("a")} == {1}


def test_exact_index_outlives_the_load(spark, tmp_path):
    pasta = str(tmp_path / "indice")
    primeiro = exatos.deduplica(docs(spark, [(1, "a"), (2, "A"), (3, "b")]), exatos.abre_indice(spark, pasta, 4))
    assert {x.doc_id for x in primeiro.collect()} == {2, 3}
    assert primeiro.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    segundo = exatos.deduplica(docs(spark, [(9, "B"), (8, "c"), (8, "c")]), exatos.abre_indice(spark, pasta, 4))
    assert [x.doc_id for x in segundo.collect()] == [8]
    indice = exatos.abre_indice(spark, pasta, 4)
    assert {(x.keep_id) for x in indice.le().collect()} == {2, 3, 8}


def test_exact_index_side_has_no_exchange(spark, tmp_path):
    indice = exatos.abre_indice(spark, str(tmp_path / "i"), 8)
    lote = exatos.digestos(docs(spark, [(i, str(i)) for i in range(50)]))
    exatos.carrega(lote, indice, "1")
    novos = lote.groupBy("digest").agg(F.max("doc_id")).join(indice.le().select("digest").hint("merge"), "digest", "left_anti")
    plano = novos._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plano and plano.count("Exchange hashpartitioning") == 1 and "Python" not in plano
    assert novos.count() == 0


def conferido(linhas, n):
    """Slots without gaps; returns bytes and rows of every shard."""
    soma, slots = Counter(), defaultdict(list)
    for x in linhas:
        soma[x.shard] += x["size"]
        slots[x.shard].append(x.slot)
        assert x.law == "bytes" and x.grown_shard is None and 0 <= x.shard < n
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return soma


def test_shards_of_the_table(spark):
    d = le(spark, "/root/testdata/sf0.01", "documents")
    linhas = fragmentos.op5_fragmentos(spark, d).collect()
    textos = {x.doc_id: x.text for x in d.collect()}
    assert sorted(x.doc_id for x in linhas) == sorted(textos)
    assert all(x["size"] == len((textos[x.doc_id] or "").encode()) + 8 for x in linhas)
    soma = conferido(linhas, 24)
    total, maior = sum(soma.values()), max(x["size"] for x in linhas)
    for k in range(1, 24):  # every boundary is the key nearest to its target
        assert abs(sum(soma[i] for i in range(k)) - k * total / 24) <= maior / 2 + 0.001 * total / 24
    onde = defaultdict(set)
    for x in linhas:
        onde[textos[x.doc_id]].add(x.shard)
    assert sum(len(v) > 1 for v in onde.values()) <= 23  # equal texts part only at a boundary


def test_shards_split_a_hot_group(spark):
    linhas = [(i, "igual" * 20) for i in range(1500)] + [(5000 + i, f"outro {i}" * 9) for i in range(1500)]
    linhas += [(None, None), (None, ""), (7, "igual" * 20), (9999, "longo" * 2000)]
    r = fragmentos.op5_fragmentos(spark, docs(spark, linhas)).collect()
    soma = conferido(r, 24)
    assert len(r) == len(linhas)
    assert max(soma.values()) - min(soma.values()) < 0.05 * sum(soma.values()) / 24 + 10_100


@pytest.mark.parametrize("linhas", [[], [(1, None)], [(1, "a"), (1, "a"), (1, "a")]])
def test_shards_of_few_rows(spark, linhas):
    r = fragmentos.op5_fragmentos(spark, docs(spark, linhas)).collect()
    conferido(r, 24)
    assert len(r) == len(linhas) and len({x.shard for x in r}) <= 1


def test_shard_files_hold_all_rows(spark, tmp_path):
    d = docs(spark, [(i, f"t{i}" * (i % 7)) for i in range(200)])
    fragmentos.grava_fragmentos(d, str(tmp_path / "f"), 4)
    lidos = spark.read.parquet(str(tmp_path / "f"))
    assert sorted(x.doc_id for x in lidos.collect()) == list(range(200))
    assert set(lidos.columns) == {*d.columns, "shard", "slot"}


def test_shards_native_plan(spark):
    d = docs(spark, [(i, str(i)) for i in range(50)])
    plano = fragmentos.op5_fragmentos(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plano and plano.count("Exchange hashpartitioning(shard") <= 3

"""Components of documents from candidates that share keys, without all pairs of a group.

Documents that share a key are candidates. Listing all pairs of a key costs the square of its documents, so each group
first meets one of its members, the centre; the links found there join most of a group of near copies into one
component. Only pairs of *different* components can still matter. They are listed and checked in full once they are few
for the size of the input; until then further rounds take other centres. The components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fasor.llm.comum import materializa

#: Remaining pairs, one for each key that they share, are listed when there are at most so many for each row of the
#: groups, or after so many rounds.
PARES_POR_LINHA = 8
RODADAS = 2
#: Edges that a task holds at once, some 100 bytes each.
ARESTAS_POR_TAREFA = 500_000


def _contrai(arestas: DataFrame) -> DataFrame:
    """Replace the edges of each task by stars of the same components. A task takes about ARESTAS_POR_TAREFA edges."""

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pai: dict[int, int] = {}

        def raiz(x: int) -> int:
            fim = x
            while (p := pai.get(fim, fim)) != fim:
                fim = p
            while x != fim:
                pai[x], x = fim, pai.get(x, x)
            return fim

        for lote in lotes:
            for u, v in zip(lote.column(0).to_pylist(), lote.column(1).to_pylist()):
                a, b = raiz(u), raiz(v)
                if a != b:
                    pai[max(a, b)] = min(a, b)
        nos = list(pai)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nos, pa.int64()), pa.array([raiz(x) for x in nos], pa.int64())], names=["u", "v"]
        )

    tarefas = -(-arestas.count() // ARESTAS_POR_TAREFA) or 1
    return materializa(arestas.coalesce(tarefas).mapInArrow(tarefa, "u bigint, v bigint"))


def componentes(ligacoes: DataFrame) -> DataFrame:
    """Component (least id) of every id that has a link: columns id, componente. ``ligacoes`` has a and b.

    Tasks first turn the edges that they have into stars. Then, until all components are stars, all larger neighbours
    of a node move to its least neighbour, all smaller ones do, and the tasks contract again. Each step is written out,
    so that a lost executor costs a re-read.
    """

    def move(arestas: DataFrame, maiores: bool) -> DataFrame:
        u, v = F.col("u"), F.col("v")
        lados = arestas.union(arestas.select("v", "u")) if maiores else arestas
        menor = materializa(lados.groupBy("u").agg(F.least(F.min("v"), u).alias("m")))
        juntos = lados.join(menor, "u")
        if maiores:
            novas = juntos.filter(v > u).select(v.alias("u"), F.col("m").alias("v"))
        else:
            novas = juntos.select(v.alias("u"), F.col("m").alias("v")).union(menor.select("u", F.col("m").alias("v")))
        return materializa(novas.filter(u > v).distinct())

    def pronta(arestas: DataFrame) -> bool:
        """Every node has one edge, to a node that has none: all components are stars."""
        n, nos = arestas.agg(F.count("*"), F.count_distinct("u")).first()
        if n != nos:
            return False
        return arestas.join(arestas.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()

    arestas = _contrai(
        materializa(ligacoes.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v"))
    )
    while not pronta(arestas):
        arestas = _contrai(move(move(arestas, True), False))
    return arestas.select(F.col("u").alias("id"), F.col("v").alias("componente")).union(
        arestas.select("v", "v").distinct()
    )


def grupos(chaves: DataFrame) -> DataFrame:
    """Rows of keys that more than one id has: columns chave, id, peso, centro, peso_centro (one id of the group).

    ``chaves`` has chave, id and peso (see ``peso``, or NULL), each key and id once, and may have parte: a common key's
    rows are dealt to parts, each with a centre of its own, so that it does not end in one task. Rows of part 0 and of a
    key without others are dropped; so ``parte`` counts from 1 for keys that are dealt. The centre has the key earliest
    in its order, so it has few tokens that the others lack.
    """
    chaves = chaves if "parte" in chaves.columns else chaves.withColumn("parte", F.lit(0))
    grupo = Window.partitionBy("chave", "parte")
    return materializa(
        chaves.withColumns({"__n": F.count("*").over(grupo), "__c": F.min(F.struct(lugar("peso"), "id", "peso")).over(grupo)})
        .filter("__n > 1 OR parte > 0")
        .select("chave", "id", "peso", F.col("__c.id").alias("centro"), F.col("__c.peso").alias("peso_centro"))
    )


def peso(n: Column, lugar: Column) -> Column:
    """Size of the set of an id, and the place of the key in its order, as one number."""
    return F.shiftleft(n.cast("bigint"), 32) + lugar


def tamanho(peso: Column | str) -> Column:
    return F.shiftright(peso, 32)


def lugar(peso: Column | str) -> Column:
    return (F.col(peso) if isinstance(peso, str) else peso).bitwiseAND(F.lit(0xFFFFFFFF))


def liga(
    linhas: DataFrame,
    verifica: Callable[[DataFrame], DataFrame],
    podem: Callable[[Column, Column], Column] | None = None,
    vivo: Callable[[Column, Column], Column] | None = None,
    rodadas: int = RODADAS,
) -> DataFrame:
    """Components from the rows of ``grupos``: columns id, componente.

    ``verifica`` gets distinct pairs a < b and returns those that are links. ``podem`` says from the weights of two ids
    in a key whether they can be linked *and* have this key first in common: a linked pair does so at one of its keys,
    and needs to be met only there. ``vivo`` says the same of a weight and the least size in the key: rows that not even
    that could be linked with are left out after the first round.
    """

    def pares(df: DataFrame) -> DataFrame:
        df = df.filter("x <> y")
        df = df if podem is None else df.filter(podem(F.col("px"), F.col("py")))
        return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    x, px = F.col("id").alias("x"), F.col("peso").alias("px")
    vistos = materializa(pares(linhas.select(x, px, F.col("centro").alias("y"), F.col("peso_centro").alias("py"))))
    links = materializa(verifica(vistos))
    if vivo is not None:
        menores = linhas.groupBy("chave").agg(F.min(tamanho("peso")).alias("__menor"))
        linhas = materializa(
            linhas.join(menores, "chave").filter(vivo(F.col("peso"), F.col("__menor"))).select("chave", "id", "peso")
        )
    total = linhas.count()
    for rodada in range(1, rodadas + 1):
        comps = componentes(links)
        marcadas = linhas.join(comps, "id", "left").select(
            "chave", "id", "peso", F.coalesce("componente", "id").alias("componente")
        )
        # how many pairs of different components each key still has
        por_chave = (
            marcadas.groupBy("chave", "componente")
            .agg(F.count("*").cast("double").alias("n"))
            .groupBy("chave")
            .agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
            .select("chave", ((F.col("s") * F.col("s") - F.col("q")) / 2).alias("p"))
            .filter("p > 0")
        )
        restam = materializa(marcadas.join(por_chave, "chave"))
        n = restam.select("chave", "p").distinct().agg(F.sum("p")).first()[0] or 0
        if not n:
            return comps
        if n <= PARES_POR_LINHA * total or rodada == rodadas:
            break
        # another centre for every key: the least id by another hash
        outro_hash = F.xxhash64("id", F.lit(rodada))
        centros = materializa(
            restam.groupBy("chave").agg(F.min_by("id", outro_hash).alias("y"), F.min_by("peso", outro_hash).alias("py"))
        )
        novos = pares(restam.select("chave", x, px).join(centros, "chave"))
        novos = materializa(novos.join(vistos, ["a", "b"], "left_anti"))
        vistos = materializa(vistos.union(novos))
        links = materializa(links.union(verifica(novos)))
    um = restam.select("chave", x, px, "componente")
    outro = restam.select("chave", F.col("id").alias("y"), F.col("peso").alias("py"), F.col("componente").alias("__outro"))
    ultimos = pares(um.join(outro, "chave").filter("componente < __outro")).join(vistos, ["a", "b"], "left_anti")
    return componentes(links.union(verifica(materializa(ultimos))))

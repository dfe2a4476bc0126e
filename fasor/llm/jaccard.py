"""Near-duplicate components by an exact Jaccard join of word shingles.

Two texts can only reach the threshold if they share a token among the first few of each, under any one order of all
tokens. Several orders are used: each puts common tokens last, by the same counts of all shingles, and breaks ties by
another hash. The first order's prefixes are the keys that make candidates; a candidate pair must then share prefix tokens
under every other order too, before the sets are compared exactly.

How many it must share follows from the sizes: of the two prefixes, the one that ends first holds all common tokens up
to its end among the shared ones, so the rest of that set bounds what else can be common. The other orders' prefixes
travel as 32-bit numbers; two tokens with one number only let a pair through to the exact comparison.

The counts are kept in 2^21 cells by hash; every shingle of every document is counted. They only choose the order, so
cells shared by several shingles cost candidates, never links.

A pair needs to be met only at the first token that it has in common, before which nothing is. There the places of the
token in the two sets bound what they can share, so most chance meetings end before anything is moved for them.

Texts of equal sets are one node. Defined results: words are runs between ASCII white space, A-Z lower-cased; a text of
fewer words than a shingle is one shingle; NULL, empty and wordless texts have none and are linked with nothing. Rows
that repeat an id are one vertex. A NULL id gets the component of its text. Further columns are not read, or travel with
their rows. Shingles are compared by 64-bit hashes within a pair, sets by 128 bits.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fasor.llm import ligacoes
from fasor.llm.comum import (
    BLOCO_CURTO,
    a_cada_linha,
    blocos,
    com_ids,
    conjuntos,
    hashes,
    janelas,
    materializa,
    mistura,
    palavras,
    pasta_compartilhada,
    sem_ids,
    semente,
)
from fasor.operators.materializa import apaga, provisorios

#: Cells of the counts, and the runs in which tasks hand them on.
CELULAS = 21
_PARTES = 64
#: Orders of the tokens: the first makes candidates, the others filter them.
ORDENS = 3
#: A token's rows are dealt to parts of about this size.
LINHAS_POR_PARTE = 4096


def sombras(bloco: bytes, inicio: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of the texts of a block: hashes and rows, sorted by row and hash."""
    ini, fim, linha, b = palavras(bloco, inicio)
    (h,) = hashes(b, (ini, fim))
    return conjuntos(*janelas(h, linha, k, len(inicio) - 1))


def prefixo(n: np.ndarray, limiar: int) -> np.ndarray:
    """How many first tokens of a set of ``n`` have to be looked at; ``limiar`` in hundredths."""
    return n - (limiar * n + 99) // 100 + 1


def prefixos(
    s: np.ndarray, linha: np.ndarray, n: np.ndarray, classe: np.ndarray, ordem: int, limiar: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the tokens (sorted by row) are in the prefix of their row under an order, and the places of these.

    Rows have ``n`` tokens.
    """
    chave = mistura(s * semente(100 + ordem))  # one to one, so no ties
    lugar = np.lexsort((chave, classe[s >> np.uint64(64 - CELULAS)], linha))
    posicao = np.empty(len(s), np.int64)
    posicao[lugar] = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)
    em = posicao < np.repeat(prefixo(n, limiar), n)
    return em, posicao[em]


def _medidas(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (doc_id, n, d1, d2: size and digest of its set), and rows of counts (parte, contas)."""

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contas = np.zeros(1 << CELULAS, np.int32)
        nomes = ["doc_id", "n", "d1", "d2", "parte", "contas"]
        for lote in lotes:
            for a, z, bloco, inicio in blocos(lote.column(1), BLOCO_CURTO):
                s, linha = sombras(bloco, inicio, k)
                n = np.bincount(linha, minlength=z - a)
                d = []
                for j in (0, 1):
                    soma = np.zeros(z - a, np.uint64)
                    if len(s):
                        corrida = np.concatenate(([np.uint64(0)], np.cumsum(mistura(s * semente(200 + j) + np.uint64(j)))))
                        fim = np.cumsum(n)
                        soma = corrida[fim] - corrida[fim - n]
                    d.append(pa.array(soma.view(np.int64)))
                cheias, vezes = np.unique(s >> np.uint64(64 - CELULAS), return_counts=True)
                contas[cheias] += vezes.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [lote.column(0).slice(a, z - a), pa.array(n), *d, pa.nulls(z - a, pa.int32()), pa.nulls(z - a, pa.binary())],
                    names=nomes,
                )
        partes = contas.reshape(_PARTES, -1)
        for i in range(_PARTES):
            if partes[i].any():
                um_vazio = pa.nulls(1, pa.int64())
                escrita = pa.array([zlib.compress(partes[i].tobytes(), 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([um_vazio] * 4 + [pa.array([i], pa.int32()), escrita], names=nomes)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("t")).mapInArrow(
        tarefa, "doc_id bigint, n bigint, d1 bigint, d2 bigint, parte int, contas binary"
    )


def _classes(medidas: DataFrame) -> np.ndarray:
    """Twice the binary logarithm of the count of every cell (2 MB, whatever the input): 0 for none, 2 for one."""

    def soma(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        somas: dict[int, np.ndarray] = {}
        for lote in lotes:
            for p, c in zip(lote.column(0).to_pylist(), lote.column(1)):
                c = np.frombuffer(zlib.decompress(c.as_py()), np.int32)
                somas[p] = somas[p] + c if p in somas else c.astype(np.int64)
        classes = [np.round(2 * np.log2(x + 1)).astype(np.uint8).tobytes() for x in somas.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(somas), pa.int32()), pa.array(classes, pa.binary())], names=["parte", "classes"]
        )

    partes = medidas.filter("parte IS NOT NULL").select("parte", "contas").repartition(_PARTES // 4, "parte")
    classes = np.zeros((_PARTES, (1 << CELULAS) // _PARTES), np.uint8)
    for r in partes.mapInArrow(soma, "parte int, classes binary").collect():
        classes[r["parte"]] = np.frombuffer(r["classes"], np.uint8)
    return classes.reshape(-1)


def _grava_textos(unicos: DataFrame, ids: DataFrame, classe, k: int, limiar: int, nome: str, pasta: str) -> None:
    """Write texts (id, n, t) and prefixes under the other orders (p1, ...) of the documents in ``ids``.

    A table bucketed by id: joins by id then move only the other side.
    """
    spark = unicos.sparkSession
    baldes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordens = range(1, ORDENS)
    nomes = ["id", "n", "t", *(f"p{o}" for o in ordens)]

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = classe.value
        for lote in lotes:
            for a, z, bloco, inicio in blocos(lote.column(1), BLOCO_CURTO):
                s, linha = sombras(bloco, inicio, k)
                n = np.bincount(linha, minlength=z - a)
                listas = []
                for o in ordens:
                    em, _ = prefixos(s, linha, n, c, o, limiar)
                    fim = np.concatenate(([0], np.cumsum(np.bincount(linha[em], minlength=z - a))))
                    listas.append(pa.ListArray.from_arrays(pa.array(fim.astype(np.int32)), pa.array(s[em].astype(np.uint32).view(np.int32))))
                yield pa.RecordBatch.from_arrays(
                    [lote.column(0).slice(a, z - a), pa.array(n), lote.column(1).slice(a, z - a), *listas], names=nomes
                )

    (
        com_ids(unicos, ids, "id")
        .repartition(baldes, "id")
        .mapInArrow(tarefa, "id bigint, n bigint, t binary" + "".join(f", p{o} array<int>" for o in ordens))
        .write.bucketBy(baldes, "id")
        .option("path", pasta)
        .saveAsTable(nome)
    )


def _podem(limiar: int):
    """Whether two sets can reach the threshold if this token, at its places, is the first that they have in common.

    Nothing before it is common, so at most it and what follows it in either set is.
    """

    def podem(a, b):
        na, nb = ligacoes.tamanho(a), ligacoes.tamanho(b)
        pedidos = F.ceil(F.lit(limiar) * (na + nb) / F.lit(100 + limiar))
        return F.least(na - ligacoes.lugar(a), nb - ligacoes.lugar(b)) >= pedidos

    return podem


def _vivo(limiar: int):
    """Whether a set can reach the threshold with one of at least the least size, if this token is the first in common."""

    def vivo(peso, menor):
        n = ligacoes.tamanho(peso)
        outro = F.greatest(menor, F.ceil(n * limiar / 100))
        return n - ligacoes.lugar(peso) >= F.ceil(F.lit(limiar) * (n + outro) / F.lit(100 + limiar))

    return vivo


def _verificador(unicos: DataFrame, classe, k: int, limiar: int):
    """Function from pairs a, b to those that pass the filters of all orders and then the threshold.

    Only the texts of the pairs move, and they are deleted when the pairs are done.
    """
    spark = unicos.sparkSession

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            ta, tb = lote.column(2), lote.column(3)
            ida, idb = np.array(lote.column(0)), np.array(lote.column(1))
            fica = np.zeros(len(lote), bool)
            i = 0
            while i < len(lote):  # runs of pairs of about a block of text; texts of equal a come together
                f, bytes_, unicos, quem = i, 0, [], []
                while f < len(lote) and (f == i or bytes_ < BLOCO_CURTO):
                    novo = f == i or ida[f] != ida[f - 1]
                    if novo:
                        unicos.append(ta[f].as_py())
                        bytes_ += len(unicos[-1])
                    a = len(unicos) - 1 if novo else quem[-1][0]
                    unicos.append(tb[f].as_py())
                    bytes_ += len(unicos[-1])
                    quem.append((a, len(unicos) - 1))
                    f += 1
                fica[i:f] = _passam(unicos, quem, k, limiar)
                i = f
            yield pa.RecordBatch.from_arrays([pa.array(ida[fica]), pa.array(idb[fica])], names=["a", "b"])

    prefixos_ = [f"p{o}" for o in range(1, ORDENS)]

    def filtra(pares: DataFrame, lado) -> DataFrame:
        com = pares.join(lado("b", "n", *prefixos_), "b").join(lado("a", "n", *prefixos_), "a")
        # common tokens that the threshold asks for, less what the rest of either set can hold
        pedidos = F.ceil(F.lit(limiar) * (F.col("na") + F.col("nb")) / F.lit(100 + limiar))
        resto = F.ceil(F.lit(limiar) * F.greatest("na", "nb") / F.lit(100)) - 1
        minimo = F.greatest(pedidos - resto, F.lit(1))
        for p in prefixos_:
            com = com.filter(F.size(F.array_intersect(f"{p}a", f"{p}b")) >= minimo)
        return materializa(com.select("a", "b"))

    def verifica(pares: DataFrame) -> DataFrame:
        if pares.isEmpty():
            return pares
        nome = f"textos_{uuid.uuid4().hex}"
        pasta = f"{pasta_compartilhada(spark)}/fasor/{nome}"
        ids = materializa(pares.select(F.col("a").alias("id")).union(pares.select("b")).distinct())
        _grava_textos(unicos, ids, classe, k, limiar, nome, pasta)
        textos = spark.table(nome)

        def lado(letra: str, *colunas: str) -> DataFrame:
            return textos.select(F.col("id").alias(letra), *[F.col(c).alias(f"{c}{letra}") for c in colunas])

        # the second text travels once per pair; the first is met where it lies
        com = filtra(pares, lado).join(lado("b", "t"), "b").join(lado("a", "t"), "a")
        links = materializa(com.select("a", "b", "ta", "tb").mapInArrow(tarefa, "a bigint, b bigint").distinct())
        apaga(spark, [pasta])
        spark.sql(f"DROP TABLE {nome}")
        return links

    return verifica


def _passam(textos: list[bytes], pares: list[tuple[int, int]], k: int, limiar: int) -> np.ndarray:
    """Which pairs of texts reach the threshold, exactly."""
    (_, _, bloco, inicio) = next(blocos(pa.array(textos, pa.binary()), alvo=1 << 62))
    s, linha = sombras(bloco, inicio, k)
    n = np.bincount(linha, minlength=len(textos))
    fim = np.cumsum(n)
    conj = [s[f - m : f] for f, m in zip(fim, n)]
    fica = np.zeros(len(pares), bool)
    for i, (a, b) in enumerate(pares):
        comuns = len(np.intersect1d(conj[a], conj[b], True))
        fica[i] = comuns and 100 * comuns >= limiar * (n[a] + n[b] - comuns)
    return fica


def junta(docs: DataFrame, k: int = 4, limiar: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id. ``limiar`` in hundredths."""
    spark = docs.sparkSession
    with provisorios() as escritos:
        medidas = materializa(_medidas(docs, k))
        classe = spark.sparkContext.broadcast(_classes(medidas))
        linhas = medidas.filter("n IS NOT NULL").select("doc_id", "n", "d1", "d2")
        conjuntos_ = materializa(
            linhas.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("id"), F.count("*").alias("copias"))
        )
        # documents that have another's set, and are not themselves the least id of some set
        repetidos = a_cada_linha(linhas.filter("n > 0"), conjuntos_, ["n", "d1", "d2"], "copias")
        sobram = materializa(
            repetidos.filter("doc_id <> id")
            .select(F.col("doc_id").alias("id"))
            .distinct()
            .join(conjuntos_.select("id"), "id", "left_anti")
        )
        com_texto = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("t"))
        unicos = sem_ids(com_texto.filter("id IS NOT NULL AND t IS NOT NULL"), sobram, "id")
        ficam = len(escritos)
        linhas_de_chaves = _grupos(unicos, classe, k, limiar)
        verifica = _verificador(unicos, classe, k, limiar)
        comps = ligacoes.liga(linhas_de_chaves, verifica, _podem(limiar), _vivo(limiar))
        nos = materializa(
            conjuntos_.join(comps, "id", "left").select(
                "n", "d1", "d2", "copias", F.coalesce("componente", "id").alias("component_id")
            )
        )
        # keys and pairs are done with; the result reads the first and the last of what was written
        apaga(spark, escritos[ficam:-1])
    todas = a_cada_linha(linhas.filter("n > 0"), nos, ["n", "d1", "d2"], "copias").drop("copias")
    return todas.unionByName(linhas.filter("n = 0").withColumn("component_id", F.col("doc_id"))).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


def _grupos(unicos: DataFrame, classe, k: int, limiar: int) -> DataFrame:
    """Prefix tokens of the first order that more than one text may have, and their groups."""

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cl = classe.value
        for lote in lotes:
            ids = np.array(lote.column(0))
            for a, z, bloco, inicio in blocos(lote.column(1), BLOCO_CURTO):
                s, linha = sombras(bloco, inicio, k)
                n = np.bincount(linha, minlength=z - a)
                em, lugar = prefixos(s, linha, n, cl, 0, limiar)
                s, linha = s[em], linha[em]
                # the rows of tokens that very many texts may have are dealt to parts by document
                c = cl[s >> np.uint64(64 - CELULAS)].astype(np.int64)
                partes = (1 << np.minimum(c // 2, 40)) // LINHAS_POR_PARTE
                sorte = mistura(s ^ ids[a:z][linha].astype(np.int64).view(np.uint64)) % np.maximum(partes, 1).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.view(np.int64)),
                        pa.array(ids[a:z][linha]),
                        pa.array((n[linha] << 32) + lugar),
                        pa.array(np.where(partes > 1, sorte.astype(np.int64) + 1, 0).astype(np.int32)),
                    ],
                    names=["chave", "id", "peso", "parte"],
                )

    return ligacoes.grupos(
        unicos.select("id", "t").mapInArrow(tarefa, "chave bigint, id bigint, peso bigint, parte int")
    )


def um_por_componente(docs: DataFrame, k: int = 4, limiar: int = 85) -> DataFrame:
    """The documents of which each component keeps one, that of the least id; all columns. Documents without shingles stay."""
    with provisorios() as escritos:
        outros = junta(docs, k, limiar).filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
        outros = materializa(outros)
        apaga(docs.sparkSession, escritos[:-1])
    return sem_ids(docs, outros, "doc_id").select(*docs.columns)


def op4_jaccard(spark: SparkSession, documentos: DataFrame) -> DataFrame:
    return junta(documentos)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + least(4, len(w)) - 1], ' ') AS g, least(4, len(w)) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pares AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
          FROM s a JOIN s b ON a.g = b.g AND a.m = b.m AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pares JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
lados AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
alcanca AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT l.y, a.r FROM alcanca a JOIN lados l ON l.x = a.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM d JOIN alcanca USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""

"""Ranked lexical search: the best documents of every query, by sparse ball trees and exact whole-number scores.

A document is a sparse vector: for each of its terms the weight of the term times a factor that grows with the term's
count and shrinks with the document's length, all in 64-bit integers. A query is the vector of its terms' counts, and a
score is their inner product.

* Queries are dealt in blocks of bounded size; a block's terms are a bounded vocabulary, which goes to the workers. One
  pass over the texts counts all terms of a document and those of the vocabulary; lengths and document frequencies are
  counted over all documents.
* Each task builds ball trees over its documents, of bounded size each. A node has a centroid and radii: documents differ
  from the centroid by at most the radius, in each band of dimensions. So a query's product with a document below is
  at most its product with the centroid plus, over the bands, its length there times the radius (one band would be the
  plain ball, which rules nothing out on texts of many common words; bands of terms of like frequency do).
* Bounds are computed in doubles and raised by more than the rounding can have cost, so no document is lost. Nodes are
  taken best bound first; once that is below the worst kept score, the tree is done. Leaves are scored in integers.
* The best of each task meet by query, in two steps of which the first is salted: no task sorts all of a query's rows.

Defined results: NULL and empty texts and texts without terms match nothing; the latter do not count as documents.
Ranks are unique from 1; equal scores by ascending id, rows without id last; of repeated rows each is ranked for itself,
and so is each query row. Queries without a match have no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fasor.llm.comum import FORA_DE_PALAVRA, MINUSCULA, materializa

K = 10
#: Queries are dealt in blocks of so many words, which bounds the vocabulary that goes to the workers.
PALAVRAS_POR_BLOCO = 16_384
#: Documents of a tree and of a leaf, and bands of dimensions with a radius each.
POR_ARVORE = 8192
POR_FOLHA = 32
FAIXAS = 4096
#: The rows of a query are first ranked in so many parts.
PARTES = 32

_TABELA = bytes(0x20 if fora else int(baixa) for fora, baixa in zip(FORA_DE_PALAVRA, MINUSCULA))
_EPS = float(np.finfo(np.float64).eps)


def termos(texto: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return (texto or b"").translate(_TABELA).split()


def peso(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Consultas:
    """A block of queries: their terms' numbers, and each query's terms and counts."""

    def __init__(self, textos: list[bytes | None]) -> None:
        self.termos: dict[bytes, int] = {}
        self.contagens: list[tuple[np.ndarray, np.ndarray]] = []
        for t in textos:
            c = Counter(self.termos.setdefault(w, len(self.termos)) for w in termos(t))
            self.contagens.append((np.array([*c], np.int64), np.array([*c.values()], np.int64)))


class Arvore:
    """Ball tree over documents with sparse vectors (offsets, dimensions, whole-number values), none of them empty."""

    def __init__(self, inicio: np.ndarray, dim: np.ndarray, valor: np.ndarray, n_dims: int, faixa: np.ndarray, n_faixas: int, por_folha: int = POR_FOLHA) -> None:
        self.inicio, self.dim, self.valor = inicio, dim, valor
        self.faixa, self.n_faixas, self.n_dims = faixa, n_faixas, n_dims
        self.real = valor.astype(np.float64)
        self.por_folha = por_folha
        self.filhos: list[tuple[int, int] | None] = []
        self.docs: list[np.ndarray] = []
        self.centros: list[np.ndarray] = []
        self.raios: list[np.ndarray] = []
        self._no(np.arange(len(inicio) - 1))
        self.centros = np.array(self.centros)
        self.raios = np.array(self.raios)
        # documents in the order of the leaves, so that a leaf's vectors lie together
        self.folha: dict[int, tuple[int, int]] = {}
        ordem, n = [], 0
        for no, filhos in enumerate(self.filhos):
            if filhos is None:
                self.folha[no] = n, n + len(self.docs[no])
                n += len(self.docs[no])
                ordem.append(self.docs[no])
        self.ordem = np.concatenate(ordem)
        lugares, self.inicio = self._lugares(self.ordem)
        self.dim, self.valor = dim[lugares], valor[lugares]
        del self.real, self.docs

    def _lugares(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of these documents lie, and the offset of each document among them."""
        n = self.inicio[docs + 1] - self.inicio[docs]
        offsets = np.concatenate(([0], np.cumsum(n)))
        return np.arange(offsets[-1]) + np.repeat(self.inicio[docs] - offsets[:-1], n), offsets

    def _no(self, docs: np.ndarray) -> int:
        lugares, offsets = self._lugares(docs)
        dim, real = self.dim[lugares], self.real[lugares]
        n = len(docs)
        centro = np.bincount(dim, real, self.n_dims) / n
        dono = np.repeat(np.arange(n), np.diff(offsets))
        # |d - c|^2 in each band: c^2 where the document has nothing, exact differences where it has something
        c = centro[dim]
        celula, qual = np.unique(dono * self.n_faixas + self.faixa[dim], return_inverse=True)
        c2 = np.bincount(self.faixa, centro * centro, self.n_faixas)
        da_faixa = celula % self.n_faixas
        dif = np.bincount(qual, (real - c) ** 2 - c * c, len(celula)) + c2[da_faixa]
        soma = np.bincount(qual, (real - c) ** 2 + c * c, len(celula)) + c2[da_faixa]
        # the sums have at most n_dims + 2 terms, whose absolute values add up to ``soma``
        certo = np.maximum(dif, 0) + 4 * (self.n_dims + 8) * _EPS * soma
        raio = np.where(np.bincount(da_faixa, minlength=self.n_faixas) < n, c2 * (1 + 4 * (self.n_dims + 8) * _EPS), 0)
        np.maximum.at(raio, da_faixa, certo)
        no = len(self.filhos)
        self.filhos.append(None)
        self.docs.append(docs)
        self.centros.append(centro)
        self.raios.append(np.sqrt(raio) * (1 + 4 * _EPS))
        if n > self.por_folha:
            quadrado = np.add.reduceat(real * real, offsets[:-1])
            a = int((quadrado - 2 * np.add.reduceat(real * c, offsets[:-1])).argmax())  # farthest from the centroid
            va = np.zeros(self.n_dims)
            va[dim[offsets[a] : offsets[a + 1]]] = real[offsets[a] : offsets[a + 1]]
            b = int((quadrado - 2 * np.add.reduceat(real * va[dim], offsets[:-1])).argmax())  # farthest from ``a``
            va[dim[offsets[b] : offsets[b + 1]]] -= real[offsets[b] : offsets[b + 1]]
            ordem = np.argsort(np.add.reduceat(real * va[dim], offsets[:-1]), kind="stable")
            meio = n // 2
            del dim, real, c, celula, qual, da_faixa, dif, soma, certo, dono, lugares
            self.docs[no] = docs[:0]
            self.filhos[no] = self._no(docs[ordem[:meio]]), self._no(docs[ordem[meio:]])
        return no

    def limites(self, consultas: Consultas) -> np.ndarray:
        """For each query and node at least the score of every document below the node."""
        limites = np.empty((len(consultas.contagens), len(self.filhos)))
        for i, (dims, q) in enumerate(consultas.contagens):
            q = q.astype(np.float64)
            normas = np.sqrt(np.bincount(self.faixa[dims], q * q, self.n_faixas)) * (1 + (len(q) + 8) * _EPS)
            usadas = np.flatnonzero(normas)
            soma = self.centros[:, dims] @ q + self.raios[:, usadas] @ normas[usadas]
            limites[i] = np.floor(soma * (1 + 4 * (len(q) + len(usadas) + 8) * _EPS) + 1e-6)
        return limites

    def pontos(self, folha: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a leaf and their exact scores; ``q`` has a count for every dimension."""
        a, b = self.folha[folha]
        i, f = self.inicio[a], self.inicio[b]
        return self.ordem[a:b], np.add.reduceat(q[self.dim[i:f]] * self.valor[i:f], self.inicio[a:b] - i)


class Melhores:
    """The k best documents of a query so far."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.linhas: list[tuple[int, bool, object]] = []  # -score, has no id, id
        self.piso = 1  # lower scores cannot enter

    def inclui(self, pontos: list[int], ids: list) -> None:
        self.linhas.extend((-p, d is None, d) for p, d in zip(pontos, ids))
        self.linhas.sort(key=lambda x: (x[0], x[1], x[2]) if not x[1] else x[:2])
        del self.linhas[self.k :]
        if len(self.linhas) == self.k:
            self.piso = max(1, -self.linhas[-1][0])


def procura(arvore: Arvore, ids: list, consultas: Consultas, melhores: list[Melhores]) -> int:
    """Take the documents of a tree into the best of every query, best bound first. Returns how many leaves were scored."""
    folhas = 0
    limites = arvore.limites(consultas)
    q = np.zeros(arvore.n_dims, np.int64)
    for i, (dims, contagem) in enumerate(consultas.contagens):
        limite, m = limites[i], melhores[i]
        if not len(dims) or limite[0] < m.piso:
            continue
        q[dims] = contagem
        fila = [(-limite[0], 0)]
        while fila:
            negativo, no = heapq.heappop(fila)
            if -negativo < m.piso:
                break
            filhos = arvore.filhos[no]
            if filhos is None:
                docs, pontos = arvore.pontos(no, q)
                folhas += 1
                bons = np.flatnonzero(pontos >= m.piso)
                if len(bons):
                    m.inclui(pontos[bons].tolist(), [ids[d] for d in docs[bons]])
            else:
                for f in filhos:
                    acima = min(limite[f], -negativo)
                    if acima >= m.piso:
                        heapq.heappush(fila, (-acima, f))
        q[dims] = 0
    return folhas


def vetores(docs: DataFrame, consultas: Consultas, id: str = "doc_id", texto: str = "text") -> DataFrame:
    """Per document the number of its terms, and the numbers and counts of those that the queries have."""
    difundido = docs.sparkSession.sparkContext.broadcast(consultas.termos)
    esquema = T.StructType(
        [
            T.StructField("id", docs.schema[id].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("dim", T.ArrayType(T.IntegerType())),
            T.StructField("tf", T.ArrayType(T.LongType())),
        ]
    )

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numero = difundido.value.get
        for lote in lotes:
            ns, dims, tfs, offsets = [], [], [], [0]
            for t in lote.column(1):
                w = termos(t.as_py())
                ns.append(len(w))
                c = Counter(map(numero, w))
                c.pop(None, None)
                dims.extend(c)
                tfs.extend(c.values())
                offsets.append(len(dims))
            o = pa.array(offsets, pa.int32())
            colunas = [
                lote.column(0),
                pa.array(ns, pa.int64()),
                pa.ListArray.from_arrays(o, pa.array(dims, pa.int32())),
                pa.ListArray.from_arrays(o, pa.array(tfs, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(colunas, names=esquema.names)

    return docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{texto}`").cast("binary").alias("t")).mapInArrow(tarefa, esquema)


def _faixas(df: np.ndarray, n: int) -> np.ndarray:
    """Bands of dimensions: neighbours by document frequency are in one band."""
    ordem = np.argsort(df, kind="stable")
    faixa = np.empty(len(df), np.int64)
    faixa[ordem] = np.arange(len(df)) * n // max(len(df), 1)
    return faixa


def _arvores(lotes: Iterator[pa.RecordBatch], por_arvore: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents in groups of at most ``por_arvore``: ids, lengths, offsets, dimensions, counts."""
    partes: list[pa.RecordBatch] = []
    n = 0

    def junta() -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(partes).combine_chunks()
        listas = [t.column(c).combine_chunks() for c in (2, 3)]
        dim, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in listas)
        o = listas[0].offsets.to_numpy()
        return t.column(0).to_pylist(), t.column(1).to_numpy(), (o - o[0]).astype(np.int64), dim, tf

    for lote in lotes:
        while lote.num_rows:
            parte = lote.slice(0, por_arvore - n)
            partes.append(parte)
            n += parte.num_rows
            lote = lote.slice(parte.num_rows)
            if n == por_arvore:
                yield junta()
                partes, n = [], 0
    if n:
        yield junta()


def impacto(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Values of terms in documents of ``n`` terms: whole numbers, divisions round down."""
    m = 25 + (75 * n * n_docs) // max(total, 1)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _bloco(docs: DataFrame, consultas: Consultas, id: str, texto: str, k: int, por_arvore: int) -> DataFrame:
    """The best documents of a block's queries: columns consulta (number in the block), rank, id, score."""
    v = materializa(vetores(docs, consultas, id, texto))
    n_docs, total = v.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(consultas.termos), np.int64)
    for dim, quantos in v.select(F.explode("dim").alias("dim")).groupBy("dim").count().collect():  # the block's vocabulary
        df[dim] = quantos
    w = np.array([peso(n_docs, int(x)) for x in df], np.int64)
    n_faixas = min(FAIXAS, len(w))
    faixa = _faixas(df, n_faixas)
    difundido = docs.sparkSession.sparkContext.broadcast((consultas, w, faixa))
    tipo = to_arrow_type(v.schema["id"].dataType)
    esquema = T.StructType(
        [T.StructField("consulta", T.IntegerType()), T.StructField("id", v.schema["id"].dataType), T.StructField("score", T.LongType())]
    )

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        consultas, w, faixa = difundido.value
        melhores = [Melhores(k) for _ in consultas.contagens]
        for ids, n, inicio, dim, tf in _arvores(lotes, por_arvore):
            valor = impacto(w[dim], tf, np.repeat(n, np.diff(inicio)), n_docs, total)
            procura(Arvore(inicio, dim, valor, len(w), faixa, n_faixas), ids, consultas, melhores)
        achados = [(i, d, -p) for i, m in enumerate(melhores) for p, _, d in m.linhas]
        if achados:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*achados), (pa.int32(), tipo, pa.int64()))], names=esquema.names
            )

    ordem = [F.desc("score"), F.asc_nulls_last("id")]
    achados = v.filter(F.size("dim") > 0).mapInArrow(tarefa, esquema)
    parte = Window.partitionBy("consulta", F.pmod(F.xxhash64("id"), F.lit(PARTES))).orderBy(*ordem)
    poucos = achados.withColumn("rank", F.row_number().over(parte)).filter(F.col("rank") <= k).drop("rank")
    todos = Window.partitionBy("consulta").orderBy(*ordem)
    return poucos.withColumn("rank", F.row_number().over(todos)).filter(F.col("rank") <= k)


def busca(
    spark: SparkSession, docs: DataFrame, itens: DataFrame, id: str = "doc_id", texto: str = "text", item: str = "item_id",
    texto_item: str = "text", k: int = K, palavras_por_bloco: int = PALAVRAS_POR_BLOCO, por_arvore: int = POR_ARVORE,
) -> DataFrame:
    """The ``k`` best documents of every query row: columns ``item``, rank, ``id``, score."""
    tipo = itens.schema[item].dataType
    blocos: list[DataFrame] = []

    def fecha(linhas: list[tuple[object, bytes]]) -> None:
        nomes = spark.createDataFrame(
            [(i, nome) for i, (nome, _) in enumerate(linhas)],
            T.StructType([T.StructField("consulta", T.IntegerType()), T.StructField("nome", tipo)]),
        )
        achados = _bloco(docs, Consultas([t for _, t in linhas]), id, texto, k, por_arvore)
        blocos.append(
            achados.join(F.broadcast(nomes), "consulta").select(  # the names of a block, bounded by its words
                F.col("nome").alias(item), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score"
            )
        )

    linhas, palavras = [], 0
    for nome, t in itens.select(F.col(f"`{item}`"), F.col(f"`{texto_item}`").cast("binary")).toLocalIterator():
        n = len(termos(t))
        if not n:
            continue
        if linhas and palavras + n > palavras_por_bloco:
            fecha(linhas)
            linhas, palavras = [], 0
        linhas.append((nome, t))
        palavras += n
    if linhas:
        fecha(linhas)
    if not blocos:
        tipo_id = docs.schema[id].dataType
        return spark.createDataFrame(
            [],
            T.StructType(
                [T.StructField(item, tipo), T.StructField("rank", T.IntegerType()), T.StructField(id, tipo_id), T.StructField("score", T.LongType())]
            ),
        )
    todos = blocos[0]
    for b in blocos[1:]:
        todos = todos.unionByName(b)
    return todos


def op12_busca(spark: SparkSession, docs: DataFrame, itens: DataFrame) -> DataFrame:
    return busca(spark, docs, itens)


_TERMOS = (
    "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), []::VARCHAR[])"
)

SQL = f"""
WITH iw AS (
  SELECT linha, item_id, t, count(*) AS q
  FROM (SELECT linha, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS linha, item_id, {_TERMOS} AS w FROM benchmark))
  GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMOS} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS nd, sum(len(w))::BIGINT AS lt FROM d),
dt AS (
  SELECT r, doc_id, n, t, count(*) AS tf
  FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM iw)
  GROUP BY ALL),
pesos AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM dt, s GROUP BY t, nd),
pontos AS (
  SELECT linha, item_id, r, doc_id,
         sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // lt))))::BIGINT AS score
  FROM iw JOIN dt USING (t) JOIN pesos USING (t), s
  GROUP BY linha, item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY linha ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM pontos WHERE score > 0)
WHERE rank <= {K}
"""

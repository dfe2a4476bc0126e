"""Language of a text by error-correcting output codes.

Each language has a codeword of +1 and -1. For every bit a linear classifier over hashed byte 2- and 3-grams is fitted
by ridge regression; a text's language is the one whose codeword is nearest to the outputs under hinge loss, the bits
weighted by their leave-one-out accuracy. Where the nearest two are close, the text is flagged ambiguous.

The classifiers are fitted on at most ``por_idioma`` documents of each language, those of least hash of the id, and on
about ``max_linhas`` in all: with many languages each gives fewer, ``MIN_POR_IDIOMA`` at least. The ``max_idiomas`` languages with most labelled
documents (ties by name) are learned; texts of rarer ones go to the nearest of these. Prediction reads every whole text.

Defined results: NULL text and text without letters are ``und`` with score 0, not ambiguous. A single language is
always predicted with score 1; without any labelled document everything is ``und``. NULL labels are not learned from.
Repeated ids are learned from once. Further columns travel with their rows; columns of the result's names are replaced.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fasor.llm.comum import BLOCO_CURTO, MINUSCULA, blocos, resto_do_id

DIMENSOES = 4096
POR_IDIOMA = 400
MAX_IDIOMAS = 1024
MAX_LINHAS = 8192
MIN_POR_IDIOMA = 8
SEM_IDIOMA = "und"

#: Letters stay, everything else that is ASCII becomes a space.
_LETRA = MINUSCULA.copy()
_LETRA[[i for i in range(128) if not chr(i).isalpha()]] = 0x20
_ASCII_LETRA = np.zeros(256, bool)
_ASCII_LETRA[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def vetores(textos: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, unit vectors of the n-gram counts' roots, and which rows have letters."""
    for a, z, bloco, inicio in blocos(textos, BLOCO_CURTO, 512):
        n = z - a
        cru = np.frombuffer(bloco, np.uint8)
        b = _LETRA[cru].astype(np.uint32)
        # rows lie at inicio[i] .. inicio[i+1]-2, with a space before and after each; an n-gram belongs to the row of
        # its first byte and must not reach beyond the space after it
        linha = np.repeat(np.arange(n), np.diff(inicio))  # of bytes 1 to the end
        b = b[1:]
        par = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
        corte = np.uint32(32 - int(math.log2(DIMENSOES)))
        contas = np.zeros(n * DIMENSOES, np.int64)
        for k, soma in ((2, par), (3, par[:-1] + b[2:] * np.uint32(0xC2B2AE3D))):
            m = len(soma)
            vale = (linha[:m] == linha[k - 1 : m + k - 1]) & (b[:m] + b[1 : m + 1] != 0x40)
            h = (soma ^ (soma >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * k)
            contas += np.bincount((linha[:m] * DIMENSOES + (h >> corte))[vale], minlength=n * DIMENSOES)
        x = np.sqrt(contas.reshape(n, DIMENSOES)).astype(np.float32)
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
        tem = np.zeros(n, bool)
        tem[linha[_ASCII_LETRA[cru[1:]]]] = True
        for i in np.flatnonzero(~tem):
            resto = bloco[inicio[i] : inicio[i + 1] - 1]
            tem[i] = any(c.isalpha() for c in resto.decode("utf-8", "replace")) if not resto.isascii() else False
        yield a, z, x, tem


def codigo(k: int) -> np.ndarray:
    """Codewords of ``k`` languages: all distinct splits for up to six, else the best of 50 random codes."""
    if k <= 6:
        colunas = [(1, *c) for c in itertools.product((1, -1), repeat=k - 1) if -1 in c]
        return np.array(colunas, np.float64).reshape(-1, k).T
    gerador = np.random.default_rng(k)
    bits = math.ceil(10 * math.log2(k))

    def distancia(c: np.ndarray) -> float:
        iguais = c @ c.T
        np.fill_diagonal(iguais, -bits)
        return -iguais.max()

    codigos = [gerador.choice((1.0, -1.0), (k, bits)) for _ in range(50)]
    codigos = [c for c in codigos if (abs(c.sum(0)) < k).all()] or codigos
    return max(codigos, key=distancia)


@dataclass(frozen=True)
class Modelo:
    idiomas: list[str]
    codigo: np.ndarray  # languages x bits
    pesos: np.ndarray  # dimensions x bits
    vies: np.ndarray
    peso_do_bit: np.ndarray
    margem: float  # nearest two codewords closer than this: ambiguous

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, score, ambiguous: for each row of ``x``."""
        if len(self.idiomas) < 2:
            n = len(x)
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
        saida = x @ self.pesos + self.vies
        # hinge loss of every bit for +1 and for -1, then summed over the bits of each codeword
        de_mais, de_menos = np.maximum(0, 1 - saida) * self.peso_do_bit, np.maximum(0, 1 + saida) * self.peso_do_bit
        perda = de_mais @ (self.codigo.T > 0) + de_menos @ (self.codigo.T < 0)
        ordem = np.argsort(perda, axis=1, kind="stable")
        linhas = np.arange(len(x))
        p = np.exp(-4 * (perda - perda.min(1, keepdims=True)))
        folga = perda[linhas, ordem[:, 1]] - perda[linhas, ordem[:, 0]]
        return ordem[:, 0], p[linhas, ordem[:, 0]] / p.sum(1), folga < self.margem


def treina(x: np.ndarray, idiomas: list[str], regulariza: float = 0.05, margem: float = 0.05) -> Modelo:
    """Fit the bit classifiers to unit vectors and their languages."""
    nomes = sorted(set(idiomas))
    c = codigo(len(nomes)) if nomes else np.zeros((0, 0))
    if len(nomes) < 2:
        return Modelo(nomes, c, np.zeros((DIMENSOES, 0)), np.zeros(0), np.zeros(0), margem)
    numero = {nome: i for i, nome in enumerate(nomes)}
    y = c[[numero[i] for i in idiomas]]
    vies = y.mean(0)
    centro = x.mean(0, dtype=np.float64)
    xc = (x - centro).astype(np.float64)
    # of the two equal solutions the one that inverts the smaller matrix; ``fora``: each document's output without itself
    if len(x) <= DIMENSOES:
        inversa = np.linalg.inv(xc @ xc.T + regulariza * np.eye(len(x)))
        a = inversa @ (y - vies)
        pesos = xc.T @ a
        fora = y - a / np.diag(inversa)[:, None]
    else:
        inversa = np.linalg.inv(xc.T @ xc + regulariza * np.eye(DIMENSOES))
        pesos = inversa @ (xc.T @ (y - vies))
        peso_de_si = np.concatenate([((p @ inversa) * p).sum(1) for p in np.array_split(xc, len(x) // 1024 + 1)])
        fora = y - (y - vies - xc @ pesos) / (1 - peso_de_si)[:, None]
    acerto = (np.sign(fora) == y).mean(0)
    peso = np.maximum(acerto - 0.5, 0.01)
    return Modelo(nomes, c, pesos.astype(np.float32), (vies - centro @ pesos), peso / peso.sum(), margem)


def _primeiros(n: int, de: int) -> int:
    """A hash below which more than ``n`` of ``de`` documents lie, but for a chance of less than one in 10^20."""
    return min((1 << 63) - 1, int((n + 10 * math.sqrt(n) + 50) / de * 2**64) - (1 << 63))


def amostra(
    docs: DataFrame, treino: Column, por_idioma: int = POR_IDIOMA, max_idiomas: int = MAX_IDIOMAS, max_linhas: int = MAX_LINHAS
) -> tuple[np.ndarray, list[str]]:
    """Vectors and languages of the bounded sample of ``docs`` where ``treino`` holds."""
    candidatos = docs.filter(treino & F.col("lang").isNotNull()).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    maiores = candidatos.groupBy("__lang").count().orderBy(F.desc("count"), "__lang").limit(max_idiomas).collect()
    cada = min(por_idioma, max(MIN_POR_IDIOMA, max_linhas // max(1, len(maiores))))
    # only hashes that may be among the least are dealt by language, so that no task takes all rows of one
    limites = docs.sparkSession.createDataFrame([(r["__lang"], _primeiros(cada, r["count"])) for r in maiores], "__lang string, __limite bigint")
    ordem = Window.partitionBy("__lang").orderBy(F.xxhash64("__id"), "__id")
    ids = (
        candidatos.join(F.broadcast(limites), "__lang")
        .filter(F.xxhash64("__id") <= F.col("__limite"))
        .withColumn("n", F.row_number().over(ordem))
        .filter(F.col("n") <= cada)
        .select("__id", "__lang")
    )

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            for a, z, x, _ in vetores(lote.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [lote.column(0).slice(a, z - a), lote.column(1).slice(a, z - a), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["__id", "__lang", "x"],
                )

    # max_linhas rows, or MIN_POR_IDIOMA x max_idiomas, at most: the bound of the broadcast and of what comes to the driver
    tipo = docs.schema["doc_id"].dataType.simpleString()
    linhas = (
        docs.select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), F.col("text").cast("binary").alias("t"))
        .join(F.broadcast(ids.distinct()), ["__id", "__lang"])
        .mapInArrow(tarefa, f"__id {tipo}, __lang string, x binary")
        .dropDuplicates(["__id", "__lang"])
        .orderBy("__id", "__lang")
        .collect()
    )
    x = np.frombuffer(b"".join(r["x"] for r in linhas), np.float32).reshape(-1, DIMENSOES)
    return x, [r["__lang"] for r in linhas]


_SAIDA = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)


def prediz(docs: DataFrame, modelo: Modelo, texto: str = "text") -> DataFrame:
    """Add lang_pred, score and ambiguous to every document."""
    b = docs.sparkSession.sparkContext.broadcast(modelo)
    colunas = [c for c in docs.columns if c not in _SAIDA.names]
    onde = len(colunas)
    campos = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("ambiguous", pa.bool_())]

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = b.value
        nomes = np.array([*m.idiomas, SEM_IDIOMA], object)
        for lote in lotes:
            for a, z, x, tem in vetores(lote.column(onde)):
                if not m.idiomas:
                    tem[:] = False
                qual, score, duvida = m.decide(x)
                yield pa.RecordBatch.from_arrays(
                    [lote.column(i).slice(a, z - a) for i in range(onde)]
                    + [
                        pa.array(nomes[np.where(tem, qual, len(nomes) - 1)], pa.string()),
                        pa.array(np.where(tem, score, 0.0)),
                        pa.array(duvida & tem),
                    ],
                    schema=pa.schema([lote.schema.field(i) for i in range(onde)] + campos),
                )

    esquema = T.StructType([docs.schema[c] for c in colunas] + list(_SAIDA))
    return docs.select(*colunas, F.col(texto).cast("binary").alias("__texto")).mapInArrow(tarefa, esquema)


def identifica(docs: DataFrame) -> DataFrame:
    """Fit on the documents whose remainder is not 1, then add the prediction to all."""
    return prediz(docs, treina(*amostra(docs, resto_do_id(F.col("doc_id")) != 1)))


def op3_idioma(documentos: DataFrame) -> DataFrame:
    modelo = treina(*amostra(documentos, resto_do_id(F.col("doc_id")) != 1))
    return prediz(documentos.select("doc_id", F.col("text").alias("__t")), modelo, "__t").select(
        "doc_id", (resto_do_id(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score", "ambiguous"
    )

"""Toxicity by a factorisation machine over hashed terms.

The terms of a text are its distinct words and the first four and five bytes of its longer words, each hashed to 18 bits. The
score is the logistic function of a bias, a weight per term, and for every pair of terms the product of two short
vectors, so that a pair can mean more than its parts: an insult beside the mention of a group, say.

The machine is fitted by AdaGrad on at most ``por_classe`` labelled documents of each class, those of least hash of the
id, weighted so that the classes keep the shares they have among all labelled documents; documents of equal terms count
once. Terms in at least ``MIN_DOCS`` documents of the sample whose presence depends on the class (chi-square of at least
``MIN_QUI``, which one term in ten thousand reaches by chance) get weights and vectors. What this machine leaves
unexplained is then tested for every pair of terms that stand together in ``MIN_JUNTOS`` documents (score test, at a
level that no pair of all reaches by chance in 99 of 100 samples); terms of such pairs, neutral as they may be alone, get
weights and vectors too, and the machine is fitted again. Scoring reads every whole text.

Defined results: NULL and wordless texts have no terms and get the score of the bias. NULL labels and labels without a
document are not learned from; an id labelled twice counts once, with its highest label. Without labels the score is 0.
Further columns travel with their rows; columns of the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fasor.llm.comum import FORA_DE_PALAVRA, blocos, hashes, palavras, resto_do_id

BITS = 18
INICIOS = (4, 5)
POR_CLASSE = 6000
FATORES = 4
MIN_DOCS = 4
MIN_QUI = 15.0
MIN_JUNTOS = 20
LIMIAR = 0.7


def termos(textos: pa.Array, uteis: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, then the distinct terms of the rows, sorted by row: rows and terms.

    ``uteis`` says which terms are wanted.
    """
    for a, z, bloco, inicio in blocos(textos):
        ini, fim, linha, b = palavras(bloco, inicio, FORA_DE_PALAVRA)
        longas = np.flatnonzero(fim - ini > max(INICIOS) + 1)
        inteiras, *comecos = hashes(b, (ini, fim), *((ini[longas], ini[longas] + k) for k in INICIOS))
        # the start of a word is another term than the same letters as a word
        todos = [inteiras] + [c * np.uint64(3) + np.uint64(1) for c in comecos]
        termo = (np.concatenate(todos) >> np.uint64(64 - BITS)).astype(np.int64)
        dono = np.concatenate([linha] + [linha[longas]] * len(INICIOS))
        if uteis is not None:
            fica = uteis[termo]
            termo, dono = termo[fica], dono[fica]
        juntos = np.unique((dono << BITS) | termo)
        yield a, z, juntos >> BITS, juntos & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Maquina:
    vies: float
    uteis: np.ndarray  # of all terms, those with weights
    lugar: np.ndarray  # of a term among them
    pesos: np.ndarray
    fatores: np.ndarray

    def pontua(self, linha: np.ndarray, termo: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` rows from the (row, term) pairs whose terms have weights, sorted by row."""
        s = np.full(n, self.vies)
        if len(linha):
            t = self.lugar[termo]
            s += np.bincount(linha, self.pesos[t], n)
            s += _pares(linha, self.fatores[t], n)[1]
        return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def _pares(linha: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the vectors of each row, and the sum over its pairs of their products."""
    somas = np.stack([np.bincount(linha, v[:, f], n) for f in range(v.shape[1])], 1)
    quadrados = np.bincount(linha, (v * v).sum(1), n)
    return somas, 0.5 * ((somas * somas).sum(1) - quadrados)


def _dependentes(listas: list[np.ndarray], rotulos: np.ndarray) -> np.ndarray:
    """Which terms are frequent enough and depend on the class."""
    n, positivos = len(listas), rotulos.sum()
    com = np.bincount(np.concatenate(listas), minlength=1 << BITS).astype(float)
    toxicos = [t for t, y in zip(listas, rotulos) if y]
    a = np.bincount(np.concatenate(toxicos), minlength=1 << BITS) if toxicos else np.zeros(1 << BITS)
    # of the 2 x 2 table of presence and class
    desvio = a * n - com * positivos
    margens = com * (n - com) * positivos * (n - positivos)
    qui = np.divide(n * desvio * desvio, margens, out=np.zeros_like(com), where=margens > 0)
    return (com >= MIN_DOCS) & (qui >= MIN_QUI)


def _em_pares(listas: list[np.ndarray], residuos: np.ndarray, variancias: np.ndarray) -> np.ndarray:
    """Which terms belong to a pair whose joint presence goes with the residuals."""
    com = np.bincount(np.concatenate(listas), minlength=1 << BITS)
    frequentes = np.flatnonzero(com >= MIN_JUNTOS)
    frequentes = frequentes[np.argsort(-com[frequentes], kind="stable")]  # the rarer a term, the fewer come after it
    k = len(frequentes)
    sim = np.zeros(1 << BITS, bool)
    if k < 2:
        return sim
    limite = 2 * np.log(100 * k * (k - 1) / 2)  # a chi-square of one degree exceeds x with a chance below exp(-x / 2)
    lugar = np.full(1 << BITS, -1)
    lugar[frequentes] = np.arange(k)
    listas = [np.sort(p[p >= 0]) for p in (lugar[t] for t in listas)]
    tamanhos = np.array([len(t) for t in listas])
    # where each term stands: its documents and its place in their lists
    doc = np.repeat(np.arange(len(listas)), tamanhos)
    ordem = np.argsort(np.concatenate(listas), kind="stable")
    doc, onde = doc[ordem], (np.arange(len(doc)) - np.repeat(np.cumsum(tamanhos) - tamanhos, tamanhos))[ordem]
    cortes = np.concatenate([[0], np.cumsum(com[frequentes])])
    for a in range(k - 1):
        docs, i = doc[cortes[a] : cortes[a + 1]], onde[cortes[a] : cortes[a + 1]] + 1
        outros = np.concatenate([listas[d][j:] for d, j in zip(docs, i)]) - (a + 1)
        vezes = tamanhos[docs] - i
        juntos = np.bincount(outros, minlength=k - a - 1)
        if not (juntos >= MIN_JUNTOS).any():
            continue
        u = np.bincount(outros, np.repeat(residuos[docs], vezes), k - a - 1)
        v = np.bincount(outros, np.repeat(variancias[docs], vezes), k - a - 1)
        achados = np.flatnonzero((juntos >= MIN_JUNTOS) & (u * u >= limite * v) & (v > 0))
        if len(achados):
            sim[frequentes[a]] = True
            sim[frequentes[achados + a + 1]] = True
    return sim


def treina(listas: list[np.ndarray], rotulos: np.ndarray, pesos_doc: np.ndarray, fatores: int = FATORES, voltas: int = 40) -> Maquina:
    """Fit to documents given as arrays of distinct terms."""
    unicos = list({(t.tobytes(), y): i for i, (t, y) in enumerate(zip(listas, rotulos))}.values())
    listas, rotulos, pesos_doc = [listas[i] for i in unicos], rotulos[unicos], pesos_doc[unicos]
    uteis = _dependentes(listas, rotulos) if listas else np.zeros(1 << BITS, bool)
    maquina = _ajusta(listas, rotulos, pesos_doc, uteis, fatores, voltas)
    if not listas:
        return maquina
    juntas = [t[uteis[t]] for t in listas]
    linha = np.repeat(np.arange(len(juntas)), [len(t) for t in juntas])
    p = maquina.pontua(linha, np.concatenate(juntas), len(juntas))
    mais = _em_pares(listas, pesos_doc * (rotulos - p), pesos_doc**2 * p * (1 - p)) & ~uteis
    return _ajusta(listas, rotulos, pesos_doc, uteis | mais, fatores, voltas) if mais.any() else maquina


def _ajusta(listas: list[np.ndarray], rotulos: np.ndarray, pesos_doc: np.ndarray, uteis: np.ndarray, fatores: int, voltas: int) -> Maquina:
    lugar = np.cumsum(uteis) - 1
    k = int(uteis.sum())
    media = float((rotulos * pesos_doc).sum() / pesos_doc.sum()) if listas else 0.0
    vies = np.log(media / (1 - media)) if 0 < media < 1 else (500.0 if media else -500.0)
    if not k:
        return Maquina(float(vies), uteis, lugar, np.zeros(1), np.zeros((1, fatores)))
    listas = [lugar[t[uteis[t]]] for t in listas]
    gerador = np.random.default_rng(7)
    w, v = np.zeros(k), gerador.normal(0, 0.01, (k, fatores))
    gw, gv, gb = np.full(k, 1e-3), np.full((k, fatores), 1e-3), 1e-3
    ritmo, encolhe, lote = 0.4, 1e-4, 128
    for _ in range(voltas):
        ordem = gerador.permutation(len(listas))
        for c in range(0, len(ordem), lote):
            quais = ordem[c : c + lote]
            n = len(quais)
            tamanhos = [len(listas[i]) for i in quais]
            t, linha = np.concatenate([listas[i] for i in quais]), np.repeat(np.arange(n), tamanhos)
            somas, pares = _pares(linha, v[t], n)
            s = vies + np.bincount(linha, w[t], n) + pares
            erro = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - rotulos[quais]) * pesos_doc[quais] / n
            vistos, t = np.unique(t, return_inverse=True)
            g = np.bincount(t, erro[linha], len(vistos)) + encolhe / n * w[vistos]
            gw[vistos] += g * g
            w[vistos] -= ritmo * g / np.sqrt(gw[vistos])
            vv = v[vistos]
            for f in range(fatores):
                g = np.bincount(t, erro[linha] * (somas[linha, f] - vv[t, f]), len(vistos)) + encolhe * vv[:, f]
                gv[vistos, f] += g * g
                v[vistos, f] -= 0.1 * ritmo * g / np.sqrt(gv[vistos, f])
            gb += erro.sum() ** 2
            vies -= ritmo * erro.sum() / np.sqrt(gb)
    return Maquina(float(vies), uteis, lugar, w, v)


def amostra(docs: DataFrame, rotulos: DataFrame, por_classe: int = POR_CLASSE) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Terms, labels and weights of the bounded sample of labelled documents whose remainder is not 1."""
    todos = (
        rotulos.filter(F.col("toxic").isin(0, 1) & (resto_do_id(F.col("doc_id")) != 1))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max("toxic").cast("int").alias("__rotulo"))
    )
    quantos = {r[0]: r[1] for r in todos.groupBy("__rotulo").count().collect()}
    ordem = Window.partitionBy("__rotulo").orderBy(F.xxhash64("__id"), "__id")
    ids = todos.withColumn("n", F.row_number().over(ordem)).filter(F.col("n") <= por_classe).drop("n")

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            for a, z, linha, termo in termos(lote.column(2)):
                cortes = np.searchsorted(linha, np.arange(z - a + 1))
                partes = [termo[i:j].astype(np.int32).tobytes() for i, j in zip(cortes, cortes[1:])]
                yield pa.RecordBatch.from_arrays(
                    [lote.column(0).slice(a, z - a), lote.column(1).slice(a, z - a), pa.array(partes, pa.binary())],
                    names=["__id", "__rotulo", "t"],
                )

    tipo = docs.schema["doc_id"].dataType.simpleString()
    linhas = (
        docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("binary").alias("t"))
        .join(F.broadcast(ids), "__id")
        .select("__id", "__rotulo", "t")
        .mapInArrow(tarefa, f"__id {tipo}, __rotulo int, t binary")
        .dropDuplicates(["__id"])
        .orderBy("__id")
        .collect()
    )
    y = np.array([r["__rotulo"] for r in linhas], float)
    na_amostra = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    peso = np.array([quantos.get(int(c), 0) / na_amostra[int(c)] for c in y])
    if len(peso):
        peso /= peso.mean()
    return [np.frombuffer(r["t"], np.int32) for r in linhas], y, peso


_SAIDA = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def pontua(docs: DataFrame, maquina: Maquina, texto: str = "text", limiar: float = LIMIAR) -> DataFrame:
    """Add score and predicted to every document."""
    b = docs.sparkSession.sparkContext.broadcast(maquina)
    colunas = [c for c in docs.columns if c not in _SAIDA.names]
    onde = len(colunas)
    campos = [pa.field("score", pa.float64()), pa.field("predicted", pa.int32())]

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = b.value
        for lote in lotes:
            for a, z, linha, termo in termos(lote.column(onde), m.uteis):
                s = m.pontua(linha, termo, z - a)
                yield pa.RecordBatch.from_arrays(
                    [lote.column(i).slice(a, z - a) for i in range(onde)] + [pa.array(s), pa.array((s >= limiar).astype(np.int32))],
                    schema=pa.schema([lote.schema.field(i) for i in range(onde)] + campos),
                )

    esquema = T.StructType([docs.schema[c] for c in colunas] + list(_SAIDA))
    return docs.select(*colunas, F.col(texto).cast("binary").alias("__texto")).mapInArrow(tarefa, esquema)


def op8_toxicidade(documentos: DataFrame, rotulos: DataFrame) -> DataFrame:
    maquina = treina(*amostra(documentos, rotulos))
    return pontua(documentos.select("doc_id", F.col("text").alias("__t")), maquina, "__t").select(
        "doc_id", (resto_do_id(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted"
    )

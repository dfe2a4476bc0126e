"""What the operators share: the shared folder, columns without clashes, words and hashes of whole batches of texts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fasor.operators.materializa import materializa, pasta_compartilhada

__all__ = ["materializa", "pasta_compartilhada"]

#: Bytes of text that are turned into numbers at once. A longer text is a block of its own.
BLOCO = 1 << 20
#: The same where the arrays of a block are many times its bytes: a worker keeps the memory that its largest block took.
BLOCO_CURTO = 1 << 18
#: Session setting of the bytes that Python workers get at once, and its value where several operators follow each other.
#: Spark's own is 64 MB, which the executor holds beside its heap, and the worker, for every task and column of texts.
CHAVE_DO_LOTE = "spark.sql.execution.arrow.maxBytesPerBatch"
LOTE = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

#: Two primes, and for each a base of which powers are taken. Polynomials modulo a prime have no families
#: of words that meet whatever the base, as those modulo a power of two have.
PRIMOS = ((np.uint64((1 << 31) - 1), 1_414_213_562), (np.uint64(2_147_483_629), 1_732_050_807))
#: Sums of so many products of a byte and a power stay below 2^64.
_SEM_RESTO = 1 << 23
_potencias: dict[tuple[int, bool], np.ndarray] = {}

ESPACO = np.zeros(256, bool)
ESPACO[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of words that are made of ASCII digits, ASCII letters and all characters beyond ASCII.
FORA_DE_PALAVRA = np.ones(256, bool)
FORA_DE_PALAVRA[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
MINUSCULA = np.arange(256, dtype=np.uint8)
MINUSCULA[0x41:0x5B] += 32


#: A key that more than one row in so many has is joined by broadcast: at most so many such keys exist.
QUENTES = 64
#: Ids are broadcast up to this number (8 bytes each), beyond it they are shuffled.
MAX_IDS = 500_000


def a_cada_linha(linhas: DataFrame, nos: DataFrame, chave: list[str], copias: str) -> DataFrame:
    """Inner join of rows with one row per key, which counts the rows of the key in ``copias``.

    Keys that hold a large share of all rows are at most QUENTES and go by broadcast, so that no task gets all the rows
    of one key; the others are shuffled. ``nos`` should have been written out: it is read several times.
    """
    limite = (nos.agg(F.sum(copias)).first()[0] or 0) // QUENTES + 1
    quentes = F.broadcast(nos.filter(F.col(copias) >= limite))
    outras = nos.filter(F.col(copias) < limite)
    return linhas.join(quentes, chave).unionByName(
        linhas.join(quentes.select(*chave), chave, "left_anti").join(outras, chave)
    )


def sem_ids(df: DataFrame, ids: DataFrame, coluna: str, como: str = "left_anti") -> DataFrame:
    """Rows of ``df`` whose ``coluna`` is not in ``ids``, which has been written out."""
    poucos = ids.limit(MAX_IDS + 1).count() <= MAX_IDS
    return df.join(F.broadcast(ids) if poucos else ids, coluna, como)


def com_ids(df: DataFrame, ids: DataFrame, coluna: str) -> DataFrame:
    """Rows of ``df`` whose ``coluna`` is in ``ids``, which has been written out."""
    return sem_ids(df, ids, coluna, "left_semi")


_LEVADO: set[str] = set()


def leva_codigo(spark: SparkSession) -> None:
    """Hand this package to the Python workers of the session, once, as ``--py-files`` would."""
    aplicacao = spark.sparkContext.applicationId
    if aplicacao in _LEVADO:
        return
    raiz = Path(__file__).resolve().parents[2]
    pasta = tempfile.mkdtemp(prefix="fasor-codigo-")  # Spark serves it from the driver
    atexit.register(shutil.rmtree, pasta, ignore_errors=True)
    arquivo = f"{pasta}/fasor_llm.zip"
    with zipfile.ZipFile(arquivo, "w") as z:
        for f in sorted((raiz / "fasor").rglob("*.py")):
            z.write(f, f.relative_to(raiz))
    spark.sparkContext.addPyFile(arquivo)
    _LEVADO.add(aplicacao)


def lotes_curtos(spark: SparkSession) -> None:
    """Hand rows to the Python workers of the session in batches of about LOTE bytes, if it says nothing of them itself."""
    if spark.conf.get(CHAVE_DO_LOTE, None) is None:
        spark.conf.set(CHAVE_DO_LOTE, str(LOTE))


def le(spark: SparkSession, pasta: str, tabela: str) -> DataFrame:
    return spark.read.parquet(f"{pasta.rstrip('/')}/{tabela}.parquet")


def minusculas(texto: Column) -> Column:
    """Lower-case A-Z only; NULL counts as empty. Text that is ASCII throughout takes the faster function."""
    t = F.coalesce(texto, F.lit(""))
    so_ascii = F.octet_length(t) == F.char_length(t)
    return F.when(so_ascii, F.lower(t)).otherwise(
        F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def resto_do_id(id: Column) -> Column:
    """crc32 of the id as text, modulo 3; NULL counts as empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % 3


def mistura(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def semente(n: int) -> np.uint64:
    """The n-th odd constant."""
    return mistura(np.array([n + 1], np.uint64) * _BASE)[0] | np.uint64(1)


def _potencia(qual: int, n: int, inversa: bool = False) -> np.ndarray:
    """The first ``n`` powers of a base, or of its inverse, modulo its prime."""
    p = _potencias.get((qual, inversa))
    if p is None or len(p) < n:
        primo, base = PRIMOS[qual]
        base = pow(base, -1, int(primo)) if inversa else base
        p = np.ones(1, np.uint64)
        while len(p) < n:
            p = np.concatenate((p, p * np.uint64(pow(base, len(p), int(primo))) % primo))
        if len(p) <= 4 * BLOCO:
            _potencias[qual, inversa] = p
    return p[:n]


def blocos(textos: pa.Array, alvo: int = BLOCO, max_linhas: int = 1 << 20) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Cut a column of binary texts into runs of rows of about ``alvo`` bytes and at most ``max_linhas`` rows.

    Yields first row, end row, the texts joined by spaces with a space at both ends, and the offset of each text
    (one more at the end). NULL counts as empty.
    """
    linhas, tamanho, primeira = [], 0, 0
    n = len(textos)
    for i in range(n):
        t = textos[i].as_py() or b""
        if linhas and (tamanho + len(t) > alvo or len(linhas) >= max_linhas):
            yield primeira, i, *_junta(linhas)
            linhas, tamanho, primeira = [], 0, i
        linhas.append(t)
        tamanho += len(t) + 1
    if linhas:
        yield primeira, n, *_junta(linhas)


def _junta(linhas: list[bytes]) -> tuple[bytes, np.ndarray]:
    inicio = np.concatenate(([1], np.cumsum([len(t) + 1 for t in linhas]) + 1))
    return b" " + b" ".join(linhas) + b" ", inicio


def palavras(bloco: bytes, inicio: np.ndarray, separador: np.ndarray = ESPACO):
    """Offsets of first and end byte of all words of a block, the row of each, and the bytes."""
    b = np.frombuffer(bloco, np.uint8)
    fora = separador[b]
    muda = np.flatnonzero(fora[1:] != fora[:-1]) + 1
    ini, fim = muda[0::2], muda[1::2]
    return ini, fim, np.searchsorted(inicio, ini, "right") - 1, b


def hashes_de(numeros: np.ndarray, *faixas: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """64-bit hashes of the ranges [first, end) of whole numbers: two polynomials modulo two primes of 31 bits."""
    saida = [np.zeros(len(ini), np.uint64) for ini, _ in faixas]
    n = len(numeros)
    s = np.empty(n + 1, np.uint64)
    s[0] = 0
    pequenos = numeros.dtype == np.uint8 and n <= _SEM_RESTO
    for qual, (primo, _) in enumerate(PRIMOS):
        if pequenos:
            termos = (numeros.astype(np.uint64) + np.uint64(1)) * _potencia(qual, n)
        else:
            termos = (numeros.astype(np.uint64) % primo + np.uint64(1)) * _potencia(qual, n) % primo
        np.cumsum(termos, out=s[1:])
        inv = _potencia(qual, n, True)
        for h, (ini, fim) in zip(saida, faixas):
            h <<= np.uint64(31)
            h |= (s[fim] - s[ini]) % primo * inv[ini] % primo
    return [mistura(h) for h in saida]


def hashes(b: np.ndarray, *faixas: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """64-bit hashes of the byte ranges [first, end), A-Z lower-cased."""
    return hashes_de(MINUSCULA[b], *faixas)


def janelas(h: np.ndarray, linha: np.ndarray, k: int, n_linhas: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie in one row, and their rows.

    A row of fewer words, but not none, gives one hash of all its words.
    """
    partes, donos = [], []
    n = len(h) - k + 1
    if n > 0:
        mesma = linha[:n] == linha[k - 1 :]
        s = np.zeros(n, np.uint64)
        for j in range(k):
            s += h[j : j + n] * semente(j)
        partes.append(mistura(s[mesma]))
        donos.append(linha[:n][mesma])
    quantas = np.bincount(linha, minlength=n_linhas)
    curtas = np.flatnonzero((quantas > 0) & (quantas < k))
    if len(curtas):
        primeira = np.searchsorted(linha, curtas)
        s = quantas[curtas].astype(np.uint64) * semente(k + 1)
        for j in range(k - 1):
            tem = quantas[curtas] > j
            s[tem] += h[primeira[tem] + j] * semente(j)
        partes.append(mistura(s + np.uint64(k)))
        donos.append(curtas)
    if not partes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(partes), np.concatenate(donos)


def conjuntos(s: np.ndarray, linha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, sorted by row and hash."""
    ordem = np.lexsort((s, linha))
    s, linha = s[ordem], linha[ordem]
    novo = np.ones(len(s), bool)
    novo[1:] = (s[1:] != s[:-1]) | (linha[1:] != linha[:-1])
    return s[novo], linha[novo]

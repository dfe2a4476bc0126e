"""Text lines of the exports inside a folder of ZIP files.

Spark has no ZIP codec, so Python unpacks, in two steps that never hold a ZIP: a first ``mapInPandas`` reads only the
directory at the end of each ZIP (ZIP64 too) and cuts its members into parts of bounded compressed size; the parts are
dealt to tasks, and a second one opens its members by ranged reads, streams them and hands lines on in bounded batches. A ZIP
of many members is many tasks; one member is one task, since a compressed member cannot be cut. A task that is lost reads
its parts again.

Ranged reads need a file system that executors can open: local (shared) folders, and those that Arrow knows (``hdfs``,
``s3``, ``gs``). Where an executor cannot open the folder, ``le_zips`` goes back to whole ZIPs as ``binaryFile`` values of
at most 2 GB. Both ways give the same lines. A read that fails raises; only what the ZIP itself gets wrong is marked.
"""

from __future__ import annotations

import io
import lzma
import math
import os
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ESQUEMA = "arquivo string, membro string, nr_linha bigint, linha string, situacao string"
COLUNAS = ["arquivo", "membro", "nr_linha", "linha", "situacao"]
LINHAS_POR_LOTE = 50_000
BYTES_POR_LEITURA = 1 << 20
#: Compressed bytes of the members of a part; a larger member is a part of its own.
BYTES_POR_PARTE = 16 << 20
#: Members of a part, however small they are.
MEMBROS_POR_PARTE = 1000
#: Most tasks of one read; beyond it a task takes several parts, one after another.
MAX_TAREFAS = 20_000

# Marker rows (``nr_linha`` = -1) for what gives no line.
VAZIO, SEM_TXT, ZIP_INVALIDO, MEMBRO_INVALIDO = "vazio", "sem_txt", "zip_invalido", "membro_invalido"

_DIRETORIO_RUIM = (zipfile.BadZipFile, NotImplementedError, UnicodeDecodeError)
_MEMBRO_RUIM = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, RuntimeError, NotImplementedError, OSError, EOFError, UnicodeDecodeError)

Abre = Callable[[str], BinaryIO]


class FalhaDeLeitura(Exception):
    """The file system failed; that says nothing about the ZIP, so the task is run again."""


class _Intervalos(io.RawIOBase):
    """A seekable file whose failures are told apart from those of the ZIP in it."""

    def __init__(self, arquivo: BinaryIO):
        self._arquivo = arquivo
        self._tamanho = self._tenta(arquivo.seek, 0, os.SEEK_END)

    @staticmethod
    def _tenta(f: Callable, *args):
        try:
            return f(*args)
        except Exception as erro:
            raise FalhaDeLeitura(str(erro)) from erro

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._tenta(self._arquivo.tell)

    def seek(self, onde: int, de: int = os.SEEK_SET) -> int:
        alvo = onde + (0 if de == os.SEEK_SET else self.tell() if de == os.SEEK_CUR else self._tamanho)
        if alvo < 0:
            raise OSError("before the start")  # a place that the ZIP names and does not have
        return self._tenta(self._arquivo.seek, alvo)

    def readinto(self, b) -> int:
        lido = self._tenta(self._arquivo.read, len(b))
        b[: len(lido)] = lido
        return len(lido)

    def close(self) -> None:
        self._arquivo.close()
        super().close()


def abre_caminho(caminho: str) -> BinaryIO:
    """A path as ``binaryFile`` names it, opened for ranged reads."""
    esquema, separador, resto = caminho.partition(":")
    if not separador or "/" in esquema:
        return open(caminho, "rb")
    if esquema == "file":
        return open("/" + resto.lstrip("/"), "rb")
    from pyarrow import fs

    sistema, dentro = fs.FileSystem.from_uri(quote(caminho.replace("s3a:", "s3:", 1).replace("s3n:", "s3:", 1), safe=":/@?&=%"))
    return sistema.open_input_file(dentro)


def linhas_de(texto: io.BufferedIOBase) -> Iterator[str]:
    """Lines of a latin-1 stream, cut at every line boundary ``str.splitlines`` knows."""
    resto = ""
    while bloco := texto.read(BYTES_POR_LEITURA):
        partes = (resto + bloco.decode("latin-1")).splitlines(keepends=True)
        # the last part may go on in the next block, also as the second half of "\\r\\n"
        resto = partes.pop()
        for parte in partes:
            yield parte.splitlines()[0]
    yield from resto.splitlines()


def _membros(pacote: zipfile.ZipFile) -> list[tuple[int, zipfile.ZipInfo]]:
    return [(i, m) for i, m in enumerate(pacote.infolist()) if m.filename.endswith(".txt")]


def _partes(membros: list[tuple[int, zipfile.ZipInfo]], bytes_por_parte: int) -> Iterator[tuple[int, int]]:
    """First and last member of each part: consecutive, bounded in bytes and in number."""
    primeiro, ultimo, soma, quantos = -1, -1, 0, 0
    for i, m in membros:
        if quantos and (soma + m.compress_size > bytes_por_parte or quantos == MEMBROS_POR_PARTE):
            yield primeiro, ultimo
            soma = quantos = 0
        if not quantos:
            primeiro = i
        ultimo, soma, quantos = i, soma + m.compress_size, quantos + 1
    if quantos:
        yield primeiro, ultimo


def _linhas_dos_membros(nome_zip: str, pacote: zipfile.ZipFile, membros: list[tuple[int, zipfile.ZipInfo]]) -> Iterator[tuple]:
    for i, membro in membros:
        # sorts by ZIP name, then by place in the ZIP: the load order
        arquivo = f"{nome_zip}#{i:09d}"
        try:
            _confere(pacote, membro)
        except _MEMBRO_RUIM:
            yield arquivo, membro.filename, -1, None, MEMBRO_INVALIDO
            continue
        nr = -1
        with pacote.open(membro) as texto:
            for nr, linha in enumerate(linhas_de(texto)):
                yield arquivo, membro.filename, nr, linha, None
        if nr < 0:
            yield arquivo, membro.filename, -1, None, VAZIO


def _linhas_do_zip(caminho: str, conteudo: bytes) -> Iterator[tuple]:
    nome_zip = os.path.basename(caminho)
    try:
        pacote = zipfile.ZipFile(io.BytesIO(conteudo))
    except _DIRETORIO_RUIM:
        yield nome_zip, None, -1, None, ZIP_INVALIDO
        return
    with pacote:
        membros = _membros(pacote)
        if not membros:
            yield nome_zip, None, -1, None, SEM_TXT
        yield from _linhas_dos_membros(nome_zip, pacote, membros)


def _confere(pacote: zipfile.ZipFile, membro: zipfile.ZipInfo) -> None:
    """Read a member through: a wrong checksum, a password or an unknown method raise before any line is handed on."""
    with pacote.open(membro) as texto:
        while texto.read(BYTES_POR_LEITURA):
            pass


def _em_lotes(linhas: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    pendentes: list[tuple] = []
    for linha in linhas:
        pendentes.append(linha)
        if len(pendentes) == LINHAS_POR_LOTE:
            yield pd.DataFrame(pendentes, columns=COLUNAS)
            pendentes = []
    if pendentes:
        yield pd.DataFrame(pendentes, columns=COLUNAS)


def _desempacota(lotes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for lote in lotes:
        for caminho, conteudo in zip(lote["path"], lote["content"]):
            yield from _em_lotes(_linhas_do_zip(caminho, conteudo))


def linhas_dos_zips(binarios: DataFrame) -> DataFrame:
    """Lines of whole ZIPs in a ``binaryFile`` DataFrame, batch or stream: one task and one value each."""
    return binarios.select("path", "content").mapInPandas(_desempacota, ESQUEMA)


def partes_dos_zips(caminhos: DataFrame, abre: Abre = abre_caminho, bytes_por_parte: int = BYTES_POR_PARTE) -> DataFrame:
    """Parts (path, primeiro, ultimo, situacao) of the ZIPs at the paths: a ZIP without parts gives one row with a mark."""

    def le_diretorios(lotes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lote in lotes:
            for caminho in lote["path"]:
                with _Intervalos(abre(caminho)) as cru, io.BufferedReader(cru, BYTES_POR_LEITURA) as arquivo:
                    try:
                        with zipfile.ZipFile(arquivo) as pacote:
                            partes = [(caminho, a, b, None) for a, b in _partes(_membros(pacote), bytes_por_parte)]
                            partes = partes or [(caminho, -1, -1, SEM_TXT)]
                    except (*_DIRETORIO_RUIM, OSError):
                        partes = [(caminho, -1, -1, ZIP_INVALIDO)]
                yield pd.DataFrame(partes, columns=["path", "primeiro", "ultimo", "situacao"])

    return caminhos.select("path").mapInPandas(le_diretorios, "path string, primeiro bigint, ultimo bigint, situacao string")


def linhas_das_partes(partes: DataFrame, tarefas: int, abre: Abre = abre_caminho) -> DataFrame:
    """Lines of the parts, dealt to so many tasks whatever ZIP they are of."""

    def le_membros(lotes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lote in lotes:
            for p in lote.itertuples():
                nome_zip = os.path.basename(p.path)
                if p.situacao is not None:
                    yield from _em_lotes(iter([(nome_zip, None, -1, None, p.situacao)]))
                    continue
                with _Intervalos(abre(p.path)) as cru, io.BufferedReader(cru, BYTES_POR_LEITURA) as arquivo, zipfile.ZipFile(arquivo) as pacote:
                    membros = [(i, m) for i, m in _membros(pacote) if p.primeiro <= i <= p.ultimo]
                    yield from _em_lotes(_linhas_dos_membros(nome_zip, pacote, membros))

    return partes.repartition(tarefas, "path", "primeiro").mapInPandas(le_membros, ESQUEMA)


def linhas_dos_caminhos(caminhos: DataFrame, abre: Abre = abre_caminho, bytes_por_parte: int = BYTES_POR_PARTE) -> DataFrame:
    """Lines of the ZIPs of a batch of (path, length), by ranged reads."""
    total = caminhos.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    # about one part a task: every ZIP may end with a part that is not full
    tarefas = min(MAX_TAREFAS, total["n"] + math.ceil(total["bytes"] / bytes_por_parte))
    tarefas = max(1, tarefas, caminhos.sparkSession.sparkContext.defaultParallelism)
    return linhas_das_partes(partes_dos_zips(caminhos, abre, bytes_por_parte), tarefas, abre)


def abre_em_tarefas(caminhos: DataFrame, abre: Abre = abre_caminho) -> bool:
    """Whether a task can open one of the paths (True without paths)."""

    def tenta(lotes: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lote in lotes:
            for caminho in lote["path"]:
                try:
                    with _Intervalos(abre(caminho)) as arquivo:
                        arquivo.read(1)
                    abriu = True
                except Exception:  # a missing file system shows itself in many ways; whole ZIPs are read then
                    abriu = False
                yield pd.DataFrame({"abriu": [abriu]})

    return all(r.abriu for r in caminhos.select("path").limit(1).mapInPandas(tenta, "abriu boolean").collect())


def le_zips(spark: SparkSession, pasta: str, intervalos: bool | None = None, abre: Abre = abre_caminho) -> DataFrame:
    """Lines of every ``*.zip`` right under ``pasta`` (the suffix is case-sensitive), by ranged reads where a task can open
    the folder (or as ``intervalos`` says), else by whole ZIPs."""
    binarios = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(pasta)
    caminhos = binarios.select("path", "length")
    if intervalos is None:
        intervalos = abre_em_tarefas(caminhos, abre)
    return linhas_dos_caminhos(caminhos, abre) if intervalos else linhas_dos_zips(binarios)

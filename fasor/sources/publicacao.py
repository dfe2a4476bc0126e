"""Which files a base consists of: one small manifest per load, published whole or not at all.

A load writes new folders only (``medicoes/carga=<id>``, ``presenca/carga=<id>``, ``catalogo/carga=<id>``) and then
publishes ``manifestos/<number>.json``: the folder of the catalogue, and for every partition the load that holds it now.
Publishing is a rename that fails if the number is taken. So a reader takes the newest manifest and sees rows, counts
and catalogue of one state; a load that dies before leaves folders that nobody reads, and running it again replays it;
of two loads that started from the same state the second one to end is told so and starts over from the new state.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

Particao = tuple[int, ...]


class CargaConcorrente(RuntimeError):
    """Another load has published since this one read the base."""


@dataclass(frozen=True)
class Estado:
    """What a manifest says. Number 0 is the empty base."""

    numero: int = 0
    catalogo: str | None = None
    particoes: dict[Particao, str] = field(default_factory=dict)  # partition: load
    notas: dict[str, str] = field(default_factory=dict)

    def depois(self, carga: str, tocadas: Iterable[Particao], catalogo: str | None) -> Estado:
        return Estado(self.numero + 1, catalogo or self.catalogo, self.particoes | dict.fromkeys(tocadas, carga), self.notas)

    def nos_meses(self, meses: Iterable[tuple[int, int]]) -> Estado:
        """The same state, of some months only."""
        meses = set(meses)
        return Estado(self.numero, self.catalogo, {p: c for p, c in self.particoes.items() if p[:2] in meses}, self.notas)

    def cargas(self) -> set[str]:
        return {*self.particoes.values(), *([self.catalogo] if self.catalogo else [])}


def nova_carga() -> str:
    return uuid.uuid4().hex


def _fs(spark: SparkSession, caminho: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(caminho)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numeros(spark: SparkSession, base: str) -> list[int]:
    p, fs = _fs(spark, f"{base}/manifestos/*.json")
    nomes = [a.getPath().getName() for a in fs.globStatus(p) or []]
    return sorted(int(m[1]) for n in nomes if (m := re.fullmatch(r"(\d+)\.json", n)))


def _le(spark: SparkSession, base: str, numero: int) -> Estado:
    p, fs = _fs(spark, f"{base}/manifestos/{numero:010d}.json")
    entrada = fs.open(p)
    try:
        texto = spark._jvm.org.apache.commons.io.IOUtils.toString(entrada, "UTF-8")
    finally:
        entrada.close()
    lido = json.loads(texto)
    particoes = {tuple(x): carga for carga, todas in lido["particoes"].items() for x in todas}
    return Estado(lido["numero"], lido["catalogo"], particoes, lido["notas"])


def estado(spark: SparkSession, base: str) -> Estado:
    """The newest published state."""
    numeros = _numeros(spark, base)
    return _le(spark, base, numeros[-1]) if numeros else Estado()


def publica(spark: SparkSession, base: str, novo: Estado) -> None:
    """Make ``novo`` the state that readers see. Raises CargaConcorrente if its number is taken."""
    por_carga: dict[str, list[Particao]] = {}
    for particao, carga in sorted(novo.particoes.items()):
        por_carga.setdefault(carga, []).append(particao)
    texto = json.dumps({"numero": novo.numero, "catalogo": novo.catalogo, "particoes": por_carga, "notas": novo.notas})
    provisorio, fs = _fs(spark, f"{base}/manifestos/_{uuid.uuid4().hex}")
    fs.mkdirs(provisorio.getParent())
    saida = fs.create(provisorio, False)
    try:
        saida.write(bytearray(texto.encode()))
    finally:
        saida.close()
    jvm = spark._jvm
    destino = jvm.org.apache.hadoop.fs.Path(f"{base}/manifestos/{novo.numero:010d}.json")
    contexto = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    sem_opcoes = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        contexto.rename(provisorio, destino, sem_opcoes)
    except Py4JJavaError as erro:
        fs.delete(provisorio, False)
        if "FileAlreadyExistsException" in str(erro.java_exception.getClass()):
            raise CargaConcorrente(f"state {novo.numero} of {base} was published by another load") from None
        raise


def limpa(spark: SparkSession, base: str, manter: int = 2, ociosas_ha_horas: float = 24) -> list[str]:
    """Delete folders of loads that none of the newest ``manter`` states reads; returns their paths.

    Folders that changed within the last hours stay, as a load that still runs may be writing them. Older states can no
    longer be read, so their manifests go first.
    """
    import time

    numeros = _numeros(spark, base)
    for numero in numeros[:-manter]:
        p, fs = _fs(spark, f"{base}/manifestos/{numero:010d}.json")
        fs.delete(p, False)
    vivas = set().union(*(_le(spark, base, n).cargas() for n in numeros[-manter:]))
    apagadas = []
    for nome in ("medicoes", "presenca", "catalogo", "linhas", "definicoes"):
        p, fs = _fs(spark, f"{base}/{nome}/carga=*")
        for pasta in fs.globStatus(p) or []:
            carga = pasta.getPath().getName().removeprefix("carga=")
            ociosa = time.time() * 1000 - pasta.getModificationTime() >= ociosas_ha_horas * 3_600_000
            if carga not in vivas and ociosa:
                fs.delete(pasta.getPath(), True)
                apagadas.append(pasta.getPath().toString())
    return apagadas

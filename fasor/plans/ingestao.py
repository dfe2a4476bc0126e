"""Folder of ZIP exports to stored measurement tables.

    python -m fasor.plans.ingestao <folder> <base>
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from fasor.functions.tempo import FORMATO_PADRAO
from fasor.operators import blocos, carga, limpeza
from fasor.operators.materializa import apaga, materializa, provisorios
from fasor.sources import tabelas, zips
from fasor.sources.publicacao import CargaConcorrente, Estado, estado, nova_carga, publica

#: A load that others overtake starts over from their state so many times.
TENTATIVAS = 5


@dataclass
class Resultado:
    """What a load leaves to look at; nothing here is collected. ``descarta`` deletes what it was computed from."""

    auditoria: DataFrame
    rejeitados: DataFrame
    colunas_novas: DataFrame
    colunas_omitidas: DataFrame
    chaves_duplicadas: DataFrame
    _escritos: list[str] = field(default_factory=list, repr=False)

    def descarta(self) -> None:
        apaga(self.auditoria.sparkSession, self._escritos)


def carrega_linhas(
    spark: SparkSession,
    linhas: DataFrame,
    base: str,
    formatos: str | Sequence[str] = FORMATO_PADRAO,
    modo: str = "linha",
    dedup: str = "hora",
) -> Resultado:
    """Clean, sum to the hour and upsert export lines into the tables under ``base``.

    The lines are read once and parsed once: data, rejects and audit come from the same written rows. Only the stored
    partitions that the new rows touch are read; their merged rows, counts and, if a column is new, the catalogue are
    written beside the stored ones and take effect together, when the manifest is published. Of several ``formatos`` each
    file is read in the one that reads most of its lines; the audit names it, and files that two formats read differently.
    """
    with provisorios() as escritos:
        with provisorios() as crus:
            linhas = materializa(linhas)
        cab = materializa(limpeza.cabecalhos(linhas))
        varios = not isinstance(formatos, str) and len(formatos) > 1
        escolhidos = materializa(limpeza.formatos_dos_arquivos(linhas, cab, formatos)) if varios else None
        examinadas = materializa(limpeza.examina(linhas, cab, formatos, escolhidos))
        marcas = materializa(limpeza.marcas(linhas))
        apaga(spark, crus)
        interpretadas = examinadas.filter("valido AND NOT rodape")
        colunas = materializa(limpeza.colunas_dos_arquivos(cab))

        largas = materializa(limpeza.horas_largas(limpeza.leituras(interpretadas), dedup))
        for tentativa in range(TENTATIVAS):
            try:
                novas_colunas, duplicadas = _funde(spark, base, largas, colunas, modo)
                break
            except CargaConcorrente:  # another load was published meanwhile: the same hours into the new state
                if tentativa == TENTATIVAS - 1:
                    raise
        auditoria = limpeza.auditoria(examinadas, cab, marcas)
        if escolhidos is not None:
            nome = F.get(F.array(*[F.lit(f) for f in formatos]), F.col("formato"))
            auditoria = auditoria.join(escolhidos.select("arquivo", nome.alias("formato"), "ambiguo"), "arquivo", "left")
        return Resultado(
            auditoria=auditoria,
            rejeitados=limpeza.rejeitados(interpretadas),
            colunas_novas=novas_colunas,
            colunas_omitidas=limpeza.colunas_omitidas(cab),
            chaves_duplicadas=duplicadas,
            _escritos=escritos,
        )


def _funde(spark: SparkSession, base: str, largas: DataFrame, colunas: DataFrame, modo: str) -> tuple[DataFrame, DataFrame]:
    """Merge hourly rows into the newest state and publish the next one: the new columns, and keys that repeat."""
    antes = estado(spark, base)
    anterior = tabelas.le_catalogo(spark, base, antes)
    carga.confere_lugares(anterior)
    sem_casas = anterior.drop("casa", "inteiro")
    novas_colunas = materializa(carga.colunas_novas(colunas, sem_casas))
    mudou = not novas_colunas.isEmpty()
    catalogo = materializa(blocos.com_casas(carga.cresce_catalogo(sem_casas, colunas), anterior)) if mudou else anterior

    novas = materializa(tabelas.com_particoes(blocos.em_blocos(carga.alinha(largas, colunas, catalogo), catalogo)))
    tocadas = materializa(novas.select(*tabelas.PARTICOES).distinct())
    particoes = [tuple(r) for r in tocadas.collect()]  # at most a year's months times the classes, for each year
    atuais = tabelas.nas_particoes(tabelas.le_medicoes(spark, base, antes), tocadas)

    depois = _publica(spark, base, antes, carga.upsert(atuais, novas, modo) if particoes else None, particoes, catalogo if mudou else None)
    gravadas = tabelas.nas_particoes(tabelas.le_medicoes(spark, base, depois), tocadas)
    return novas_colunas, carga.chaves_duplicadas(gravadas)


def _publica(
    spark: SparkSession, base: str, antes: Estado, prontas: DataFrame | None, particoes: list[tuple], catalogo: DataFrame | None
) -> Estado:
    """Write whole partitions of blocks and a catalogue, where there are any, and publish the state that has them."""
    esta = nova_carga()
    if catalogo is not None:
        tabelas.grava_catalogo(catalogo, base, esta)
    if prontas is not None:
        tabelas.grava_medicoes(prontas, base, esta)
    if prontas is None and catalogo is None:
        return antes
    depois = antes.depois(esta, particoes, None if catalogo is None else esta)
    publica(spark, base, depois)
    return depois


def guarda(spark: SparkSession, base: str, largas: DataFrame, catalogo: DataFrame) -> Estado:
    """Store wide rows ``(tabela, data_hora, valores)``; the partitions that they touch are replaced as a whole."""
    antes = estado(spark, base)
    with provisorios() as escritos:
        catalogo = materializa(blocos.com_casas(catalogo, tabelas.le_catalogo(spark, base, antes)))
        prontas = materializa(tabelas.com_particoes(blocos.em_blocos(largas, catalogo)))
        particoes = [tuple(r) for r in prontas.select(*tabelas.PARTICOES).distinct().collect()]
        depois = _publica(spark, base, antes, prontas, particoes, catalogo)
    apaga(spark, escritos)
    return depois


def carrega_pasta(spark: SparkSession, pasta: str, base: str, **opcoes) -> Resultado:
    """Load every ZIP of a folder. Loading the same folder again changes nothing."""
    return carrega_linhas(spark, zips.le_zips(spark, pasta), base, **opcoes)


if __name__ == "__main__":
    from fasor.session import sessao

    resultado = carrega_pasta(sessao("ingestao"), sys.argv[1], sys.argv[2])
    resultado.auditoria.orderBy(F.col("situacao"), F.col("arquivo")).show(50, truncate=False)

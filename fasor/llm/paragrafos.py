"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a run of words between two cuts. Sentence ends and line ends can cut, and one place in eight elsewhere,
chosen by the words before it; of those within ``PASSO`` words of each other only the one of least hash does, and none
within ``MINIMO`` words of a text's ends. So the cuts depend on nothing but the words nearby, and a passage inside other
text is cut there as elsewhere; copies of a text have the same paragraphs whatever rows lie beside them.

Equal paragraphs (A-Z lower-cased, white space alike) are one content. Contents meet by MinHash bands of their five-word
shingles, with as many rows as the recall at the threshold allows for ``MAX_BANDAS`` bands. A band key that many
contents have, as those do that share one frequent phrase, is replaced within it by the rarest shingles of each content,
as many as any two that reach the threshold must share one of: no pair that the key has is lost. Contents that collide are compared by exact Jaccard similarity, and the links' components are clusters.
Before their sets move, sizes and cells rule out pairs that cannot reach the threshold (see ``_podem``); no pair that can
is lost by that.
Repeated are the paragraphs of a cluster that more than one document has, where those that follow each other in a
document make up ``PASSAGEM`` words or the whole text. A cluster stays in the document of the least id and can be removed from the others.

Defined results: NULL and empty texts, and texts shorter than ``MINIMO`` words, have none. A passage repeated
only inside one document is not a cluster. Rows that repeat an id count as one document. NULL ids take no part. Further
columns are not read, or travel with their rows. Contents are told apart by 62-bit hashes modulo primes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fasor.llm import ligacoes
from fasor.llm.comum import a_cada_linha, blocos, com_ids, hashes, hashes_de, materializa, mistura, palavras, semente

PASSO = 5
MINIMO = PASSO + 1
#: Words of a repeated passage; of a whole text that is repeated fewer will do.
PASSAGEM = 20
TEXTO_INTEIRO = 12
SOMBRA = 5
LIMIAR = 0.8
#: Share of pairs at the threshold that meet; more similar ones meet more often.
RECALL = 0.98
MAX_BANDAS = 4
#: A key of more contents is replaced by finer ones, which lose no pair that can reach the threshold.
CONTEUDOS_POR_CHAVE = 32
#: Contents of a batch of texts that share a key, from which on the key's rows are dealt to several tasks.
QUENTE_NO_LOTE = 2000
#: Rows of a finer key are dealt to parts of about this size.
LINHAS_POR_PARTE = 4096
#: Words of 64 cells, into which a content's shingles fall.
PALAVRAS_DE_CELULAS = 4

_FIM_DE_FRASE = np.zeros(256, bool)
_FIM_DE_FRASE[[0x21, 0x2E, 0x3F]] = True


def bandas(limiar: float = LIMIAR, recall: float = RECALL, maximo: int = MAX_BANDAS) -> tuple[int, int]:
    """Bands and rows of each: the most rows with which ``maximo`` bands reach the recall at the threshold."""
    for r in range(8, 0, -1):
        b = math.ceil(math.log(1 - recall) / math.log(1 - limiar**r))
        if b <= maximo or r == 1:
            return b, r


def paragrafos(bloco: bytes, inicio: np.ndarray):
    """Paragraphs of a block: row, first and end word (of the block), hash; and the words' hashes and rows."""
    ini, fim, linha, b = palavras(bloco, inicio)
    (h,) = hashes(b, (ini, fim))
    n = len(h)
    if not n:
        vazio = np.empty(0, np.int64)
        return vazio, vazio, vazio, np.empty(0, np.uint64), h, linha
    ultima = np.ones(n, bool)
    ultima[:-1] = linha[1:] != linha[:-1]
    primeira = np.concatenate(([True], ultima[:-1]))
    anterior = np.where(primeira, np.uint64(0), np.concatenate(([np.uint64(0)], h[:-1])))  # never another text's word
    marca = mistura(anterior * semente(7) + h)
    pode = _FIM_DE_FRASE[b[fim - 1]] | (marca >> np.uint64(61) == 0)
    linhas_novas = np.cumsum(b == 0x0A)
    pode[:-1] |= linhas_novas[ini[1:]] > linhas_novas[fim[:-1] - 1]
    # no cut leaves fewer than MINIMO words at either end of a text
    lugar = np.arange(n) - np.flatnonzero(primeira)[np.cumsum(primeira) - 1]
    falta = np.flatnonzero(ultima)[np.cumsum(primeira) - 1] - np.arange(n)
    c = np.flatnonzero(pode & (lugar >= MINIMO - 1) & (falta >= MINIMO))
    marca, fica = marca[c], np.ones(len(c), bool)
    for d in range(1, min(PASSO, len(c) - 1) + 1):
        perto = c[d:] - c[:-d] <= PASSO
        perto &= linha[c[d:]] == linha[c[:-d]]
        fica[d:] &= ~(perto & (marca[:-d] <= marca[d:]))
        fica[:-d] &= ~(perto & (marca[d:] < marca[:-d]))
    cortes = np.union1d(c[fica], np.flatnonzero(ultima)) + 1
    comeco = np.concatenate(([0], cortes[:-1]))
    longo = cortes - comeco >= MINIMO
    comeco, final = comeco[longo], cortes[longo]
    (hash_,) = hashes_de(h, (comeco, final))
    hash_ = mistura(hash_ + (final - comeco).astype(np.uint64))
    return linha[comeco], comeco, final, hash_, h, linha


def _sombras(h: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of word runs [a, z), one after the other, and where those of each run begin."""
    n = len(h) - SOMBRA + 1
    s = np.zeros(n, np.uint64)
    for j in range(SOMBRA):
        s += h[j : j + n] * semente(j)
    s = mistura(s)
    quantas = z - a - SOMBRA + 1
    primeira = np.cumsum(quantas) - quantas
    return s[np.arange(quantas.sum()) - np.repeat(primeira - a, quantas)], primeira


def _peso() -> Column:
    """What rules pairs out, from the set ``s``: its size, and a bit for each cell that a shingle falls in."""
    um, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def palavra(i: int) -> Column:
        def junta(a: Column, x: Column) -> Column:
            celula = F.pmod(x, F.lit(64 * PALAVRAS_DE_CELULAS)).cast("int")
            bit = F.call_function("shiftleft", um, celula - 64 * i)
            return F.when(F.floor(celula / 64) == i, a.bitwiseOR(bit)).otherwise(a)

        return F.aggregate("s", zero, junta).alias(f"c{i}")

    return F.struct(F.size("s").alias("n"), *[palavra(i) for i in range(PALAVRAS_DE_CELULAS)])


def _podem(limiar: float) -> Callable[[Column, Column], Column]:
    """Whether two sets can reach the threshold.

    Of two sets of m and n elements that do, at most (1 - t) / (1 + t) * (m + n) elements are in one only. Each of these
    makes the cells differ in one bit at most, so more differing bits than that exclude the pair. This loses none.
    """
    sobra = (1 - limiar) / (1 + limiar) + 1e-9

    def podem(a: Column, b: Column) -> Column:
        m, n = a["n"], b["n"]
        diferem = sum((F.bit_count(a[f"c{i}"].bitwiseXOR(b[f"c{i}"])) for i in range(PALAVRAS_DE_CELULAS)), F.lit(0))
        return (F.abs(m - n) <= sobra * (m + n)) & (diferem <= sobra * (m + n))

    return podem


def ocorrencias(docs: DataFrame) -> DataFrame:
    """Paragraphs of all documents: h, doc_id, lugar (first word, and in the lower half the end word), ultimo (whether
    the text ends with it)."""

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            ids = np.array(lote.column(0))
            for a, z, bloco, inicio in blocos(lote.column(1)):
                dono, comeco, final, hash_, _, linha = paragrafos(bloco, inicio)
                base = np.searchsorted(linha, dono)
                fim = np.searchsorted(linha, dono, "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hash_.view(np.int64)),
                        pa.array(ids[a:z][dono]),
                        pa.array(((comeco - base) << 32) + (final - base)),
                        pa.array(final == fim),
                    ],
                    names=["h", "doc_id", "lugar", "ultimo"],
                )

    return _entrada(docs).mapInArrow(tarefa, "h bigint, doc_id bigint, lugar bigint, ultimo boolean")


def _entrada(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("t")).filter(
        "doc_id IS NOT NULL AND t IS NOT NULL"
    )


def _chaves(docs: DataFrame, b: int, r: int) -> DataFrame:
    """Band keys of the contents: chave, id, parte. A content occurs once for each batch of texts that has it.

    A key that very many contents of a batch have is dealt to parts by its share, so that none of its groups is large.
    Part 0, where other batches have it, is told by a row without id.
    """
    partes = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            ids, todas = [], []
            for _, _, bloco, inicio in blocos(lote.column(0)):
                _, comeco, final, hash_, h, _ = paragrafos(bloco, inicio)
                if not len(hash_):
                    continue
                hash_, quais = np.unique(hash_, return_index=True)
                s, primeira = _sombras(h, comeco[quais], final[quais])
                for banda in range(b):
                    chave = np.full(len(hash_), semente(300 + banda))
                    for k in range(r):
                        chave = mistura(chave + np.minimum.reduceat(mistura(s * semente(400 + banda * r + k)), primeira))
                    ids.append(hash_)
                    todas.append(chave)
            if not ids:
                continue
            chave, id = np.concatenate(todas), np.concatenate(ids)
            distintas, qual, vezes = np.unique(chave, return_inverse=True, return_counts=True)
            em = np.where(vezes >= QUENTE_NO_LOTE, 4 * partes * vezes * b // len(chave) + 1, 0)[qual].astype(np.uint64)
            parte = np.where(em > 0, 1 + mistura(id) % np.maximum(em, 1), 0)
            dadas = distintas[vezes >= QUENTE_NO_LOTE]
            avisos = np.arange(len(id) + len(dadas)) >= len(id)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([chave, dadas]).view(np.int64)),
                    pa.array(np.concatenate([id, dadas]).view(np.int64), mask=avisos),
                    pa.array(np.concatenate([parte, np.zeros(len(dadas), parte.dtype)]).astype(np.int32)),
                ],
                names=["chave", "id", "parte"],
            )

    # one exchange serves the distinct rows here and the groups by key that follow
    return _entrada(docs).select("t").mapInArrow(tarefa, "chave bigint, id bigint, parte int").repartition(partes, "chave", "parte").distinct()


def _grupos(chaves: DataFrame) -> DataFrame:
    """Rows of keys that more than one content has: chave, id, centro (one of them), quente (more than a few, or dealt to
    parts anywhere, see ``_chaves``)."""
    grupo = Window.partitionBy("chave", "parte")
    dada = (F.col("parte") > 0) | (F.col("__linhas") > F.col("__n"))  # the row without id
    return materializa(
        chaves.withColumns({"__n": F.count("id").over(grupo), "__linhas": F.count("*").over(grupo), "centro": F.min("id").over(grupo)})
        .filter(F.col("id").isNotNull() & ((F.col("__n") > 1) | dada))
        .select("chave", "id", "centro", ((F.col("__n") > CONTEUDOS_POR_CHAVE) | dada).alias("quente"))
    )


def _chaves_finas(quentes: DataFrame, conjuntos: DataFrame, limiar: float) -> DataFrame:
    """Keys within the keys that many contents share: the rarest shingles of each content.

    A set of n elements shares at least t * n of them with any set that reaches the threshold with it, so the first
    n - t * n + 1 of both, in one order of all shingles, have an element in common. Rare shingles come first.
    """
    usados = conjuntos.join(quentes.select("id").distinct(), "id", "left_semi")
    sombras = materializa(usados.select("id", F.explode("s").alias("sombra")))
    contas = materializa(sombras.groupBy("sombra").agg(F.count("*").alias("n")))
    n = F.size("m")
    primeiras = F.slice("m", 1, (n - F.ceil(F.lit(limiar) * n - F.lit(1e-9)) + 1).cast("int"))
    finas = materializa(
        a_cada_linha(sombras, contas, ["sombra"], "n")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("n", "sombra"))).alias("m"))
        .select("id", primeiras.alias("finas"))
    )
    partes = F.floor(F.col("fina.n") / LINHAS_POR_PARTE)
    parte = F.when(partes > 1, 1 + F.pmod(F.xxhash64("id"), partes)).otherwise(0)
    return (
        quentes.select("chave", "id").distinct().join(finas, "id").select("chave", "id", F.explode("finas").alias("fina"))
        .select(F.xxhash64("chave", "fina.sombra").alias("chave"), "id", parte.cast("int").alias("parte"))
        .distinct()
    )


def _conjuntos(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """Shingle sets of contents (id, d0, lugar): columns id, s. A document's places come together, then its text."""
    lugares = contents.groupBy("d0").agg(F.collect_list(F.struct("id", "lugar")).alias("lugares"))

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            ids, conj = [], []
            for t, onde in zip(lote.column(0), lote.column(1).to_pylist()):
                (_, _, bloco, inicio) = next(blocos(pa.array([t.as_py()], pa.binary()), alvo=1 << 62))
                ini, fim, _, b = palavras(bloco, inicio)
                (h,) = hashes(b, (ini, fim))
                for x in onde:
                    a, z = x["lugar"] >> 32, x["lugar"] & 0xFFFFFFFF
                    if z > len(h):  # another row of the same id
                        continue
                    ids.append(x["id"])
                    conj.append(np.unique(_sombras(h[a:z], np.array([0]), np.array([z - a]))[0]).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(conj, pa.list_(pa.int64()))], names=["id", "s"]
            )

    lugares = materializa(lugares.withColumnRenamed("d0", "doc_id"))
    entrada = com_ids(_entrada(docs), materializa(lugares.select("doc_id")), "doc_id")  # only these texts move
    com_texto = entrada.join(lugares, "doc_id").select("t", "lugares")
    return com_texto.mapInArrow(tarefa, "id bigint, s array<bigint>")


def agrupa(docs: DataFrame, limiar: float = LIMIAR) -> DataFrame:
    """Paragraphs of passages that more than one document has: doc_id, first_word, end_word, cluster_id, cluster_doc, removed.

    ``cluster_id`` is the least content of the cluster; words are counted from 0, between white space.
    """
    vistas = materializa(ocorrencias(docs))
    conteudos = materializa(
        vistas.groupBy(F.col("h").alias("id")).agg(
            F.count("*").alias("copias"),
            F.min("doc_id").alias("d0"),
            F.max("doc_id").alias("d1"),
            F.min_by("lugar", "doc_id").alias("lugar"),
        )
    )
    grupos = _grupos(_chaves(docs, *bandas(limiar)))
    ids = materializa(grupos.select("id").distinct())
    conjuntos = _conjuntos(docs, conteudos.join(ids, "id", "left_semi").select("id", "d0", "lugar"))
    conjuntos = materializa(conjuntos.withColumn("peso", _peso()))
    finas = _grupos(_chaves_finas(grupos.filter("quente"), conjuntos, limiar))
    pesos = conjuntos.select("id", "peso")
    linhas = materializa(
        grupos.filter("NOT quente").unionByName(finas).select("chave", "id", "centro")
        .join(pesos, "id")
        .join(pesos.select(F.col("id").alias("centro"), F.col("peso").alias("peso_centro")), "centro")
    )

    def verifica(pares: DataFrame) -> DataFrame:
        comuns = F.size(F.array_intersect("sa", "sb"))
        return materializa(
            pares.join(conjuntos.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(conjuntos.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
            .filter(comuns >= F.lit(limiar) * (F.size("sa") + F.size("sb") - comuns))
            .select("a", "b")
        )

    comps = ligacoes.liga(linhas, verifica, _podem(limiar))
    marcados = conteudos.join(comps, "id", "left").withColumn("c", F.coalesce("componente", "id"))
    clusters = marcados.groupBy("c").agg(
        F.min("d0").alias("cluster_doc"), F.max("d1").alias("ultimo"), F.sum("copias").alias("n")
    )
    repetidos = materializa(
        marcados.join(clusters.filter("cluster_doc < ultimo"), "c").select(F.col("id").alias("h"), "c", "copias", "cluster_doc")
    )
    do_documento = Window.partitionBy("doc_id").orderBy("first_word")
    corrida = Window.partitionBy("doc_id", "__corrida")
    inteiro = (F.min("first_word").over(corrida) == 0) & F.max("ultimo").over(corrida)
    return (
        a_cada_linha(vistas, repetidos, ["h"], "copias")
        .select(
            "doc_id",
            F.shiftright("lugar", 32).alias("first_word"),
            F.col("lugar").bitwiseAND(F.lit(0xFFFFFFFF)).alias("end_word"),
            F.col("c").alias("cluster_id"),
            "cluster_doc",
            (F.col("doc_id") != F.col("cluster_doc")).alias("removed"),
            "ultimo",
        )
        # paragraphs that follow each other in a document
        .withColumn("__novo", F.coalesce(F.lag("end_word").over(do_documento) < F.col("first_word"), F.lit(True)))
        .withColumn("__corrida", F.sum(F.col("__novo").cast("int")).over(do_documento))
        .withColumns({"__palavras": F.sum(F.col("end_word") - F.col("first_word")).over(corrida), "__inteiro": inteiro})
        .filter(F.col("__palavras") >= F.when(F.col("__inteiro"), TEXTO_INTEIRO).otherwise(PASSAGEM))
        .drop("__novo", "__corrida", "__palavras", "__inteiro", "ultimo")
    )


def remove(docs: DataFrame, limiar: float = LIMIAR) -> DataFrame:
    """``docs`` without the paragraphs that are removed, the same columns; what is left of a text joins by a space.

    Documents that lose all their words stay, with empty text.
    """
    faixas = (
        agrupa(docs, limiar)
        .filter("removed")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("first_word", "end_word")).alias("__faixas"))
    )
    colunas = docs.columns
    onde = colunas.index("text")

    def corta(texto: str | None, faixas: list[dict] | None) -> str | None:
        if texto is None or not faixas:
            return texto
        (_, _, bloco, inicio) = next(blocos(pa.array([texto.encode()], pa.binary()), alvo=1 << 62))
        ini, fim, _, _ = palavras(bloco, inicio)
        partes, ultimo = [], 1
        for a, z in sorted((f["first_word"], f["end_word"]) for f in faixas):
            if z <= len(ini) and fim[z - 1] > ultimo:
                partes.append(bloco[ultimo : max(ultimo, ini[a])])
                ultimo = int(fim[z - 1])
        partes.append(bloco[ultimo:-1])
        return b" ".join(p.strip() for p in partes if p.strip()).decode()

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            textos = [corta(t.as_py(), f.as_py()) for t, f in zip(lote.column(onde), lote.column(len(colunas)))]
            saida = [lote.column(i) for i in range(len(colunas))]
            saida[onde] = pa.array(textos, lote.schema.field(onde).type)
            yield pa.RecordBatch.from_arrays(saida, schema=pa.schema([lote.schema.field(i) for i in range(len(colunas))]))

    return docs.join(faixas, "doc_id", "left").select(*colunas, "__faixas").mapInArrow(tarefa, docs.schema)


def op7_paragrafos(documentos: DataFrame) -> DataFrame:
    return agrupa(documentos)

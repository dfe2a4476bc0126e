"""Benchmark passages in documents, by a generalised suffix automaton of the items.

Words are runs of ASCII digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. The automaton of the
items' words is built on the driver and sent to the tasks; its input is bounded by ``max_palavras`` and refused beyond
it, never cut. Each task streams the words of its documents through it: the automaton knows at every word the longest
run ending there that occurs in some item. A run of at least ``janela`` words is a hit; an item of fewer words is hit
where all of it occurs.

Defined results: NULL and wordless texts have no words and no hits. Rows of one item_id are one item, and rows without
one hit words but are not counted; an item without words is never hit. Without items nothing is hit. Further columns of both tables are not read, or travel with their rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fasor.llm.comum import FORA_DE_PALAVRA

JANELA = 10
MAX_PALAVRAS = 5_000_000

_TABELA = bytes(0x20 if FORA_DE_PALAVRA[i] else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))
_PALAVRA = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def palavras(texto: bytes | None) -> list[bytes]:
    return texto.translate(_TABELA).split() if texto else []


class Automato:
    """Suffix automaton of several word sequences. State 0 is empty; ``proximo[s]`` maps a word to a state."""

    def __init__(self, itens: list[tuple[object, list[bytes]]], janela: int = JANELA):
        self.janela = janela
        self.proximo: list[dict[bytes, int]] = [{}]
        self.elo = [-1]
        self.tamanho = [0]
        for _, seq in itens:
            fim = 0
            for p in seq:
                fim = self._estende(fim, p)
        self.ids = [i for i, _ in itens]
        # A run of m words that ends at a word is the state, among the suffixes of that word's state, whose lengths
        # include m. Cloning moves runs between states, so the places are found when all states exist.
        self.janelas: dict[int, set[int]] = {}
        self.curtos: dict[int, dict[int, set[int]]] = {}
        for n, (_, seq) in enumerate(itens):
            if not seq:
                continue
            m = min(len(seq), janela)
            s = 0
            for i, p in enumerate(seq):
                s = self.proximo[s][p]  # the state of the whole prefix of the item
                if i + 1 >= m:
                    v = self._sufixo(s, m)
                    if m == janela:
                        self.janelas.setdefault(v, set()).add(n)
                    else:
                        self.curtos.setdefault(v, {}).setdefault(m, set()).add(n)
        # for each state, the nearest state up the links (itself included) that is a whole short item
        self.curto_perto: list[int | None] = [None] * len(self.elo)
        infinito = 1 << 60
        self.minimo = [infinito] * len(self.elo)  # least matching length at which the state has something to report
        for s in sorted(range(len(self.elo)), key=self.tamanho.__getitem__):
            m = self.minimo[self.elo[s]] if s else infinito
            self.curto_perto[s] = s if s in self.curtos else self.curto_perto[self.elo[s]] if s else None
            if s in self.curtos:
                m = min(m, *self.curtos[s])
            if self.tamanho[s] >= janela:
                m = min(m, janela)
            self.minimo[s] = m

    def _sufixo(self, s: int, m: int) -> int:
        while self.tamanho[self.elo[s]] >= m:
            s = self.elo[s]
        return s

    def _estende(self, ultimo: int, p: bytes) -> int:
        proximo, elo, tamanho = self.proximo, self.elo, self.tamanho
        q = proximo[ultimo].get(p)
        if q is not None:  # the run exists already: it may need a state of its own
            return q if tamanho[q] == tamanho[ultimo] + 1 else self._clona(ultimo, p, q)
        novo = len(elo)
        proximo.append({})
        tamanho.append(tamanho[ultimo] + 1)
        elo.append(0)
        s = ultimo
        while s != -1 and p not in proximo[s]:
            proximo[s][p] = novo
            s = elo[s]
        if s != -1:
            q = proximo[s][p]
            elo[novo] = q if tamanho[q] == tamanho[s] + 1 else self._clona(s, p, q)
        return novo

    def _clona(self, s: int, p: bytes, q: int) -> int:
        c = len(self.elo)
        self.proximo.append(dict(self.proximo[q]))
        self.tamanho.append(self.tamanho[s] + 1)
        self.elo.append(self.elo[q])
        self.elo[q] = c
        while s != -1 and self.proximo[s].get(p) == q:
            self.proximo[s][p] = c
            s = self.elo[s]
        return c

    def procura(self, seq: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words (first, end), which may overlap, and the numbers of the items that occur."""
        proximo, elo, tamanho, minimo, janela = self.proximo, self.elo, self.tamanho, self.minimo, self.janela
        faixas: list[tuple[int, int]] = []
        estados: set[int] = set()
        curtos: set[tuple[int, int]] = set()
        s = n = 0
        for i, p in enumerate(seq):
            t = proximo[s].get(p)
            if t is None:
                while t is None and s:
                    s = elo[s]
                    t = proximo[s].get(p)
                if t is None:
                    n = 0
                    continue
                n = tamanho[s]
            s = t
            n += 1
            if n < minimo[s]:
                continue
            if n >= janela:
                faixas.append((i + 1 - n, i + 1))
                estados.add(self._sufixo(s, janela))
            v = self.curto_perto[s]
            while v is not None:
                for m in self.curtos[v]:
                    if m <= n:
                        faixas.append((i + 1 - m, i + 1))
                        curtos.add((v, m))
                v = self.curto_perto[elo[v]] if v else None
        achados = set().union(*(self.janelas.get(v, ()) for v in estados), *(self.curtos[v][m] for v, m in curtos))
        return faixas, achados


def _une(faixas: list[tuple[int, int]]) -> list[tuple[int, int]]:
    unidas: list[list[int]] = []
    for a, b in sorted(faixas):
        if unidas and a <= unidas[-1][1]:
            unidas[-1][1] = max(unidas[-1][1], b)
        else:
            unidas.append([a, b])
    return [(a, b) for a, b in unidas]


def automato(itens: DataFrame, id: str = "item_id", texto: str = "text", janela: int = JANELA, max_palavras: int = MAX_PALAVRAS) -> Automato:
    """The automaton of all items. Raises ValueError if they may have more than ``max_palavras`` words.

    Twice as many bytes bound the words: each takes one at least, and a separator. A larger set is used in parts, one
    after the other: removing the spans of one part leaves the documents ready for the next.
    """
    limite = itens.agg(F.sum(F.octet_length(texto)).alias("b"), F.count("*").alias("n")).first()
    if ((limite["b"] or 0) + limite["n"]) // 2 > max_palavras:
        raise ValueError(f"the items may have more than {max_palavras} words: use them in parts")
    linhas = itens.select(F.col(id), F.col(texto).cast("binary")).collect()
    return Automato([(i, palavras(t)) for i, t in linhas], janela)


_ACHADOS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("text_clean", T.StringType()),
    ]
)


def examina(docs: DataFrame, automato: Automato, texto: str = "text", limpa: bool = True) -> DataFrame:
    """Add what the automaton finds in each document.

    n_words, n_hit, n_items, items_sha256, spans (runs of hit words: first, end), and with ``limpa`` text_clean: the
    text without these runs; NULL where nothing is removed.
    Columns of the documents keep their place; columns of these names are replaced.
    """
    b = docs.sparkSession.sparkContext.broadcast(automato)
    colunas = [c for c in docs.columns if c not in _ACHADOS.names]
    esquema = T.StructType([docs.schema[c] for c in colunas] + list(_ACHADOS))
    campos = pa.schema(
        [
            pa.field("n_words", pa.int64()),
            pa.field("n_hit", pa.int64()),
            pa.field("n_items", pa.int64()),
            pa.field("items_sha256", pa.string()),
            pa.field("spans", pa.list_(pa.list_(pa.int32()))),
            pa.field("text_clean", pa.string()),
        ]
    )
    onde = len(colunas)

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b.value
        for lote in lotes:
            saida: list[list] = [[] for _ in campos]
            for t in lote.column(onde):
                t = t.as_py() or b""
                seq = palavras(t)
                faixas, itens = a.procura(seq)
                unidas = _une(faixas)
                nomes = sorted({str(a.ids[n]) for n in itens if a.ids[n] is not None})
                for coluna, v in zip(
                    saida,
                    (
                        len(seq),
                        sum(f - i for i, f in unidas),
                        len(nomes),
                        hashlib.sha256(",".join(nomes).encode()).hexdigest(),
                        [list(f) for f in unidas],
                        _sem(t, unidas) if limpa and unidas else None,
                    ),
                ):
                    coluna.append(v)
            yield pa.RecordBatch.from_arrays(
                [lote.column(i) for i in range(onde)] + [pa.array(v, c.type) for v, c in zip(saida, campos)],
                schema=pa.schema([lote.schema.field(i) for i in range(onde)] + list(campos)),
            )

    return docs.select(*colunas, F.col(texto).cast("binary").alias("__texto")).mapInArrow(tarefa, esquema)


def _sem(texto: bytes, faixas: list[tuple[int, int]]) -> str:
    """The text without the words of the runs and what stands between them; what is left joins by a space."""
    lugares = [m.span() for m in _PALAVRA.finditer(texto.translate(_TABELA))]
    partes, ultimo = [], 0
    for i, f in faixas:
        partes.append(texto[ultimo : lugares[i][0]])
        ultimo = lugares[f - 1][1]
    partes.append(texto[ultimo:])
    return b" ".join(p.strip() for p in partes if p.strip()).decode()


def descontamina(
    docs: DataFrame, itens: DataFrame, texto: str = "text", janela: int = JANELA, cobertura: float = 0.5, max_palavras: int = MAX_PALAVRAS
) -> DataFrame:
    """``docs`` without benchmark passages, the same columns: hit runs are cut out of the text, and a document goes
    where more than ``cobertura`` of its words were hit. ``n_chars``, if there, follows the text."""
    # the other columns travel in one, so that none of them is taken for a result
    outras = [F.col(f"`{c}`") for c in docs.columns if c != texto]
    inteiros = docs.select(F.struct(F.lit(0).alias("__vazio"), *outras).alias("__doc"), F.col(f"`{texto}`").alias("__texto_original"))
    achados = examina(inteiros, automato(itens, janela=janela, max_palavras=max_palavras), "__texto_original")
    mudou = F.col("text_clean").isNotNull()

    def coluna(c: str):
        if c == texto:
            return F.coalesce("text_clean", "__texto_original").alias(c)
        antes = F.col("__doc").getField(c)
        if c == "n_chars":
            return F.when(mudou, F.char_length("text_clean").cast(docs.schema[c].dataType)).otherwise(antes).alias(c)
        return antes.alias(c)

    return achados.filter(F.col("n_hit") <= cobertura * F.col("n_words")).select(*[coluna(c) for c in docs.columns])


def op6_descontaminacao(documentos: DataFrame, itens: DataFrame) -> DataFrame:
    return examina(documentos.select("doc_id", "text"), automato(itens), limpa=False).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_MINUSCULAS = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LISTA = f"coalesce(regexp_extract_all({_MINUSCULAS}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []::VARCHAR[])"

SQL = f"""
WITH i AS (SELECT item_id, {_LISTA} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[k : k + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k
        FROM i WHERE len(w) > 0)),
tamanhos AS (SELECT DISTINCT m FROM iw),
d AS (SELECT doc_id, row_number() OVER () AS r, {_LISTA} AS w FROM documents),
dk AS (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, tamanhos WHERE len(w) >= m),
dw AS (SELECT r, m, k, array_to_string(w[k : k + m - 1], ' ') AS g FROM dk),
achados AS (SELECT dw.r, dw.k, dw.m, iw.item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.g = iw.g),
palavras AS (SELECT r, count(DISTINCT p) AS n_hit
             FROM (SELECT r, unnest(range(k, k + m)) AS p FROM achados) GROUP BY r),
itens AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS lista
          FROM achados GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(lista, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN palavras USING (r) LEFT JOIN itens USING (r)
"""

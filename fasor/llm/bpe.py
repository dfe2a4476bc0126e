"""BPE encoding and decoding with the vocabulary file of a public tokenizer.

A word is encoded by dynamic programming over its prefixes. A sequence of tokens is what BPE makes of its string exactly
if every two neighbours are what BPE makes of theirs. So every prefix of a word has one last token, and it is the one
token among those that end there which fits behind the last token of the prefix before it:

* A generalised suffix automaton of all tokens reads the word; the tokens that end at a place are found by going up the
  suffix links. It is built once in a Python worker and is linear in the vocabulary.
* Two tokens fit if no merge crosses their border before both are complete. The pieces at the border are followed from
  the last merge back to the first, so the test takes as many steps as the two tokens have merges there.
* The last tokens of all prefixes are stored; going back from the end gives the ids.

The time is linear in the length of a word for any text, also for a word of a million letters, and no text is cut. Words
are remembered while there is room, which changes no result. The file's normaliser and word splitter run before; the
strings of special tokens in a text become those tokens, as the file says.

``caminho`` names the file on the driver, which hands its bytes (a fixed few MB) to the workers.

Defined results: NULL and empty texts, and texts of white space, have no ids; the text of no ids is empty. Ids that the
file lacks, and NULL ids, give nothing when decoded; NULL lists count as empty. Repeated rows are kept, every row is
encoded for itself. Other columns travel with their rows; a column of the result's name is replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

ARQUIVO = "word_bpe_49k.json"

#: Rows are handed on when so many ids have come together.
IDS_POR_LOTE = 1 << 20
#: Words of up to so many bytes are remembered: the latest ones, between once and twice so many; likewise pairs of tokens.
BYTES_LEMBRADOS = 40
PALAVRAS_LEMBRADAS = 300_000
PARES_LEMBRADOS = 250_000

# The normaliser and the splitter of the file that is split here without the library, for texts whose
# characters all lie below U+0180, where composing changes nothing and small letters are below U+0180, too.
_NORMALIZADOR = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SEPARADOR = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_BRANCO = r"\t-\r \x85\xa0"


def _classe(propriedade: str) -> str:
    """The characters below U+0180 of a property, for a character class of ``re``, which is faster and has no properties."""
    propria = regex.compile(propriedade)
    return "".join(re.escape(c) for c in map(chr, range(0x180)) if propria.fullmatch(c))


_L, _N = _classe(r"\p{L}"), _classe(r"\p{N}")
_PALAVRA = re.compile(rf"[{_L}]+|'(?:[stmd]|re|ve|ll)|[{_N}]|[^{_BRANCO}{_L}{_N}]+")


def caminho_publico(nome: str = ARQUIVO) -> str:
    """Place of a vocabulary file of the public tokenizers installed here."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(nome))


def _letras_dos_bytes() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from U+0100 on."""
    visiveis = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letras, proxima = [], 0x100
    for b in range(256):
        letras.append(chr(b if b in visiveis else proxima))
        proxima += b not in visiveis
    return letras


class Automato:
    """Generalised suffix automaton of sequences of symbols, each with a number."""

    def __init__(self) -> None:
        self.proximo: list[dict[int, int]] = [{}]
        self.elo = [-1]
        self.tamanho = [0]
        self.numero = [-1]

    def _estado(self, tamanho: int, proximo: dict[int, int], elo: int) -> int:
        self.proximo.append(proximo)
        self.elo.append(elo)
        self.tamanho.append(tamanho)
        self.numero.append(-1)
        return len(self.elo) - 1

    def _separa(self, p: int, q: int, s: int) -> int:
        """State of the strings of ``q`` that are no longer than those of ``p`` and ``s``."""
        if self.tamanho[q] == self.tamanho[p] + 1:
            return q
        copia = self._estado(self.tamanho[p] + 1, dict(self.proximo[q]), self.elo[q])
        self.elo[q] = copia
        while p >= 0 and self.proximo[p].get(s) == q:
            self.proximo[p][s] = copia
            p = self.elo[p]
        return copia

    def inclui(self, simbolos: tuple[int, ...], numero: int) -> None:
        atual = 0
        for s in simbolos:
            p = atual
            if s in self.proximo[p]:
                atual = self._separa(p, self.proximo[p][s], s)
                continue
            atual = self._estado(self.tamanho[p] + 1, {}, 0)
            while p >= 0 and s not in self.proximo[p]:
                self.proximo[p][s] = atual
                p = self.elo[p]
            if p >= 0:
                self.elo[atual] = self._separa(p, self.proximo[p][s], s)
        self.numero[atual] = numero

    def termina(self) -> None:
        """``acima``: the nearest state up the links that is a whole sequence, or 0."""
        self.acima = [0] * len(self.elo)
        for e in sorted(range(1, len(self.elo)), key=self.tamanho.__getitem__):
            elo = self.elo[e]
            self.acima[e] = elo if self.numero[elo] >= 0 else self.acima[elo]


class Vocabulario:
    def __init__(self, conteudo: bytes) -> None:
        arquivo = json.loads(conteudo)
        modelo = arquivo["model"]
        if modelo["type"] != "BPE" or modelo.get("continuing_subword_prefix") or modelo.get("ignore_merges"):
            raise ValueError("the file must hold a BPE model without prefixes whose merges are all used")
        self.biblioteca = Tokenizer.from_str(conteudo.decode())
        self.sem_biblioteca = arquivo["normalizer"] == _NORMALIZADOR and arquivo["pre_tokenizer"] == _SEPARADOR
        ids: dict[str, int] = modelo["vocab"]
        especiais = {t["content"]: t["id"] for t in arquivo["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in arquivo["added_tokens"]):
            raise ValueError("added tokens must be matched as they stand")
        self.especiais = especiais
        maiores_antes = sorted(especiais, key=len, reverse=True)
        self._especial = re.compile("(" + "|".join(map(re.escape, maiores_antes)) + ")") if especiais else None
        self.textos: list[str | None] = [None] * (max([*ids.values(), *especiais.values()]) + 1)
        for texto, n in (ids | especiais).items():
            self.textos[n] = texto
        self.decodificador = arquivo["decoder"]
        # one None more, for ids that the file lacks
        self.tabela = pa.array([*self.textos, None], pa.string())

        fim = modelo.get("end_of_word_suffix") or ""
        letras = _letras_dos_bytes()
        self._letra = {c: b for b, c in enumerate(letras)}
        try:
            self.meio = [ids[c] for c in letras]
            self.final = [ids[c + fim] for c in letras]
        except KeyError as erro:
            raise ValueError(f"the vocabulary lacks the byte {erro}") from None
        simbolos = {n: (n,) for n in (*self.meio, *self.final)}
        self.regra: dict[tuple[int, int], int] = {}
        self.ordem = dict.fromkeys(simbolos, -1)
        self.partes: dict[int, tuple[int, int]] = {}
        for n, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in modelo["merges"]):
            esquerda, direita, todo = ids[a], ids[b], ids[a + b]
            if todo in self.ordem or esquerda not in self.ordem or direita not in self.ordem:
                raise ValueError(f"merge {n} does not make a new token of earlier ones")
            self.regra[esquerda, direita] = n
            self.ordem[todo] = n
            self.partes[todo] = esquerda, direita
            simbolos[todo] = simbolos[esquerda] + simbolos[direita]
        self.automato = Automato()
        for n, s in simbolos.items():
            self.automato.inclui(s, n)
        self.automato.termina()
        self._pares: dict[tuple[int, int], bool] = {}
        self._palavras: dict[str, tuple[int, ...]] = {}
        self._antigas: dict[str, tuple[int, ...]] = {}

    def cabem(self, a: int, b: int) -> bool:
        """Whether BPE makes the tokens ``a`` and ``b`` of their joined string."""
        sabido = self._pares.get((a, b))
        if sabido is not None:
            return sabido
        x, y, nunca = a, b, len(self.regra)
        ate_x = ate_y = nunca  # the merges that take the pieces at the border away
        cabem = True
        while True:
            n = self.regra.get((x, y))
            # of equal merges the left one comes first: that inside ``a``, but after it the one across the border
            if n is not None and n < ate_x and n <= ate_y:
                cabem = False
                break
            if self.ordem[x] < 0 and self.ordem[y] < 0:
                break
            if self.ordem[x] > self.ordem[y]:
                ate_x, x = self.ordem[x], self.partes[x][1]
            else:
                ate_y, y = self.ordem[y], self.partes[y][0]
        if len(self._pares) >= PARES_LEMBRADOS:
            self._pares.clear()
        self._pares[a, b] = cabem
        return cabem

    def _ids_dos_bytes(self, b: bytes) -> list[int]:
        simbolos = [self.meio[x] for x in b[:-1]]
        simbolos.append(self.final[b[-1]])
        aut = self.automato
        proximo, elo, tamanho, numero, acima = aut.proximo, aut.elo, aut.tamanho, aut.numero, aut.acima
        cabem = self.cabem
        ultimo = [-1]
        comprimento = [0]
        e = n = 0
        for i, s in enumerate(simbolos, 1):
            while (p := proximo[e].get(s)) is None:
                e = elo[e]
                n = tamanho[e]
            e = p
            n += 1
            c = e if n == tamanho[e] and numero[e] >= 0 else acima[e]
            while True:  # a token of one symbol ends everywhere, and one token of those that end here fits
                t, antes = numero[c], i - tamanho[c]
                if not antes or cabem(ultimo[antes], t):
                    break
                c = acima[c]
            ultimo.append(t)
            comprimento.append(tamanho[c])
        ids, i = [], len(simbolos)
        while i:
            ids.append(ultimo[i])
            i -= comprimento[i]
        ids.reverse()
        return ids

    def _palavra(self, palavra: str) -> tuple[int, ...]:
        """Ids of a word that is not among the latest ones."""
        ids = self._antigas.get(palavra)
        if ids is None:
            b = palavra.encode()
            ids = tuple(self._ids_dos_bytes(b))
            if len(b) > BYTES_LEMBRADOS:
                return ids
        if len(self._palavras) >= PALAVRAS_LEMBRADAS:
            self._antigas = self._palavras.copy()
            self._palavras.clear()  # whoever looks words up holds this very dictionary
        self._palavras[palavra] = ids
        return ids

    def _separadas(self, texto: str) -> list[str]:
        if self.sem_biblioteca and (texto.isascii() or max(texto) < "ƀ"):
            return _PALAVRA.findall(texto.lower())
        norm, sep = self.biblioteca.normalizer, self.biblioteca.pre_tokenizer
        texto = norm.normalize_str(texto) if norm else texto
        letra = self._letra
        return [bytes(map(letra.__getitem__, p)).decode("utf-8", "surrogateescape") for p, _ in sep.pre_tokenize_str(texto)]

    def ids(self, texto: str | None) -> list[int]:
        pedacos = self._especial.split(texto or "") if self._especial else [texto or ""]
        lembra, resto = self._palavras.get, self._palavra
        todos: list[int] = []
        for i, pedaco in enumerate(pedacos):
            if i % 2:
                todos.append(self.especiais[pedaco])
            elif pedaco:
                todos.extend(chain.from_iterable([lembra(p) or resto(p) for p in self._separadas(pedaco)]))
        return todos

    def decodifica(self, listas: pa.ListArray) -> pa.Array:
        """Texts of lists of ids."""
        offsets = listas.offsets.to_numpy(zero_copy_only=False)
        planos = np.asarray(pc.fill_null(listas.values, -1))[offsets[0] : offsets[-1]].astype(np.int64)
        planos[(planos < 0) | (planos >= len(self.textos))] = len(self.textos)
        tokens = self.tabela.take(pa.array(planos))
        bons = np.concatenate(([0], np.cumsum(np.asarray(pc.is_valid(tokens)))))[offsets - offsets[0]]
        tokens = tokens.drop_null()
        if self.decodificador is None:  # tokens with a space between
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(bons, pa.int32()), tokens), " ")
        planos = planos[planos < len(self.textos)].tolist()
        um_a_um = [planos[a:b] for a, b in zip(bons, bons[1:])]
        return pa.array(self.biblioteca.decode_batch(um_a_um, skip_special_tokens=False), pa.string())


_FEITOS: dict[int, Vocabulario] = {}


def vocabulario(conteudo: bytes) -> Vocabulario:
    chave = hash(conteudo)
    if chave not in _FEITOS:
        _FEITOS.clear()
        _FEITOS[chave] = Vocabulario(conteudo)
    return _FEITOS[chave]


def _por_lotes(
    df: DataFrame, coluna: str, novas: dict[str, T.DataType], conteudo: bytes,
    faz: Callable[[Vocabulario, pa.Array], Iterator[list[pa.Array]]],
) -> DataFrame:
    """Add columns that ``faz`` makes of slices of ``coluna``, in order."""
    ficam = [c for c in df.columns if c not in novas]
    esquema = T.StructType([*df.select(*[f"`{c}`" for c in ficam]).schema.fields, *[T.StructField(n, t) for n, t in novas.items()]])
    entrada = df.select(*[f"`{c}`" for c in ficam], F.col(f"`{coluna}`").alias("__entrada"))
    difundido = df.sparkSession.sparkContext.broadcast(conteudo)

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulario(difundido.value)
        for lote in lotes:
            *outras, alvo = lote.columns
            feitas = 0
            for colunas in faz(v, alvo):
                n = len(colunas[0])
                yield pa.RecordBatch.from_arrays([c.slice(feitas, n) for c in outras] + colunas, names=esquema.names)
                feitas += n

    return entrada.mapInArrow(tarefa, esquema)


def _listas(v: Vocabulario, textos: pa.Array) -> Iterator[pa.ListArray]:
    ids: list[int] = []
    offsets = [0]
    for t in textos:
        ids.extend(v.ids(t.as_py()))
        offsets.append(len(ids))
        if len(ids) >= IDS_POR_LOTE:
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            ids, offsets = [], [0]
    if len(offsets) > 1:
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def codifica(df: DataFrame, coluna: str = "text", caminho: str | None = None, ids: str = "ids", decodificado: str | None = None) -> DataFrame:
    """Add the ids of the texts of ``coluna``, and if asked what they decode to."""
    with open(caminho or caminho_publico(), "rb") as f:
        conteudo = f.read()
    novas: dict[str, T.DataType] = {ids: T.ArrayType(T.IntegerType())}
    if decodificado:
        novas[decodificado] = T.StringType()

    def faz(v: Vocabulario, textos: pa.Array) -> Iterator[list[pa.Array]]:
        for listas in _listas(v, textos):
            yield [listas, v.decodifica(listas)] if decodificado else [listas]

    return _por_lotes(df, coluna, novas, conteudo, faz)


def decodifica(df: DataFrame, coluna: str = "ids", caminho: str | None = None, texto: str = "texto") -> DataFrame:
    """Add the text of the ids of ``coluna``."""
    with open(caminho or caminho_publico(), "rb") as f:
        conteudo = f.read()

    def faz(v: Vocabulario, listas: pa.Array) -> Iterator[list[pa.Array]]:
        for i in range(0, len(listas), 1024):
            parte = listas.slice(i, 1024)
            yield [v.decodifica(pc.if_else(pc.is_null(parte), pa.scalar([], parte.type), parte))]

    return _por_lotes(df, coluna, {texto: T.StringType()}, conteudo, faz)


def op13_bpe(docs: DataFrame, caminho: str | None = None) -> DataFrame:
    """Per document the number and digest of its ids, and the digest of the text that they decode to."""
    feitos = codifica(docs.select("doc_id", "text"), caminho=caminho, decodificado="decodificado")
    return feitos.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decodificado", 256).alias("decoded_sha256"),
    )

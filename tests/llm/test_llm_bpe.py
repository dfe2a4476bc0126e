import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fasor.llm import bpe
from fasor.llm.consultas import CONSULTAS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def biblioteca():
    return Tokenizer.from_file(bpe.caminho_publico())


@pytest.fixture(scope="module")
def vocab():
    with open(bpe.caminho_publico(), "rb") as f:
        return bpe.vocabulario(f.read())


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_query_against_the_library(spark, biblioteca):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    linhas = CONSULTAS["op13_bpe"](spark, SF).collect()
    assert len(linhas) == len(docs)
    for r in linhas:
        ids = biblioteca.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), _sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == _sha(biblioteca.decode(ids, skip_special_tokens=False))


ALFABETOS = [
    "ab", "aab ", "the in on ", "abcdefghijklmnopqrstuvwxyz", "'stdrevlm ", "0123 45.,!?", "éüßñ çà ",
    "Σσς İIıÉé가각　中文​", "".join(map(chr, range(1, 0x250))), "éäo ", "\U0001f600 ab‍",
]


@pytest.mark.parametrize("alfabeto", ALFABETOS)
def test_random_texts_against_the_library(alfabeto, vocab, biblioteca):
    sorte = random.Random(5)
    for n in (1, 2, 3, 7, 40, 400):
        for _ in range(25):
            t = "".join(sorte.choice(alfabeto) for _ in range(n))
            assert vocab.ids(t) == biblioteca.encode(t, add_special_tokens=False).ids, t


def test_special_tokens_and_white_space(vocab, biblioteca):
    for t in ("<|endoftext|>", "a<|startoftext|>B <|endoftext|><|endoftext|>c", "<|ENDOFTEXT|>", "<|endoftext", " \t\n\x85\xa0 ", "\x1c\x1d a"):
        assert vocab.ids(t) == biblioteca.encode(t, add_special_tokens=False).ids


def test_every_token_is_the_encoding_of_itself(vocab):
    """Then the last token of every prefix is unique, which the method rests on."""
    for todo, (a, b) in vocab.partes.items():
        assert vocab.cabem(a, b) is False and vocab.textos[a] + vocab.textos[b] == vocab.textos[todo]
    final = set(vocab.final)
    for n in list(vocab.partes)[::37]:
        texto = vocab.textos[n]
        if texto.endswith("</w>"):
            letras = bytes(vocab._letra[c] for c in texto[:-4])
            assert vocab._ids_dos_bytes(letras) == [n]
    assert len(final) == 256


def test_one_very_long_word_takes_linear_time(vocab, biblioteca):
    t = "abcab" * 60_000
    assert vocab.ids(t) == biblioteca.encode(t, add_special_tokens=False).ids


def test_edges_clashes_and_round_trip(spark, biblioteca):
    textos = [None, "", " \n", "Hello, world's 12", "Hello, world's 12", "x" * 50_000]
    docs = spark.createDataFrame([(i, t, 7, "k") for i, t in enumerate(textos)], "doc_id long, text string, ids int, n_tokens string")
    feitos = bpe.codifica(docs)
    assert feitos.columns == ["doc_id", "text", "n_tokens", "ids"]
    r = {x.doc_id: x for x in feitos.collect()}
    assert [len(r[i].ids) for i in range(3)] == [0, 0, 0] and r[3].ids == r[4].ids and r[3].n_tokens == "k"
    for i in range(3, 6):
        assert r[i].ids == biblioteca.encode(textos[i], add_special_tokens=False).ids
    for x in bpe.decodifica(feitos).collect():
        assert x.texto == biblioteca.decode(x.ids, skip_special_tokens=False)
    estranhos = spark.createDataFrame([(1, None), (2, []), (3, [-1, 512, None, 10**9, 49407, 49408])], "i int, ids array<int>")
    textos = {x.i: x.texto for x in bpe.decodifica(estranhos).collect()}
    assert textos == {1: "", 2: "", 3: biblioteca.decode([512, 49407], skip_special_tokens=False)}
    assert bpe.op13_bpe(docs.filter("false")).collect() == []
    assert bpe.op13_bpe(docs).agg(F.sum("n_tokens")).first()[0] == sum(len(x.ids) for x in r.values())


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulario(b'{"model": {"type": "WordPiece"}}')

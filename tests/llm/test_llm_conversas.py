import hashlib
import heapq
import random
import re
import zlib

import pytest

from fasor.llm import conversas
from fasor.llm.comum import leva_codigo

ESQUEMA = "conv_id bigint, turn bigint, role string, text string, cost string, id int"


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def tabela(spark, linhas):
    return spark.createDataFrame([(*x, "z", 9) for x in linhas], ESQUEMA).repartition(5)


def em_ordem(linhas):
    """Rows of one conversation (turn, role, text) as the docstring sorts them."""
    sha = lambda x: hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()
    return sorted(linhas, key=lambda x: (x[0] is not None, x[0] or 0, sha(x)))


def danos(linhas):
    saem = []
    for conv, turn, role, text in linhas:
        role, text = (" " if x is None else x for x in (role, text))
        chave = ":".join(" " if x is None else str(x) for x in (conv, turn))
        d = zlib.crc32(chave.encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        saem += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return saem


def falhas(linhas):
    vistos, fs = set(), []
    for _, role, text in linhas:
        letras = re.findall(r"[^\x20\x09-\x0D]", text)
        fs.append("blank" if not letras else "duplicate" if (role, text) in vistos else "truncated" if letras[-1] not in ".!?" else "")
        vistos.add((role, text))
    return fs


def cheapest(linhas, fs):
    """Uniform-cost search over (rows used, state), whole audits compared as strings."""
    fila = [(0, "", 0, "", ())]
    feitos = set()
    while fila:
        custo, audit, i, estado, saida = heapq.heappop(fila)
        if (i, estado) in feitos:
            continue
        feitos.add((i, estado))
        if i == len(linhas) and estado in ("", "a"):
            return custo, audit, list(saida)
        proximo = "a" if estado == "u" else "u"
        nome = {"u": "user", "a": "assistant"}[proximo]
        heapq.heappush(fila, (custo + 3, audit + "I", i, proximo, (*saida, f"{nome}:")))
        if i == len(linhas):
            continue
        _, role, text = linhas[i]
        heapq.heappush(fila, (custo + 4, audit + "D", i + 1, estado, saida))
        if fs[i] in ("blank", "duplicate"):
            continue
        mais = 3 if fs[i] == "truncated" else 0
        heapq.heappush(fila, (custo + 3 + mais, audit + "R", i + 1, proximo, (*saida, f"{nome}:{text}")))
        if role[:1] == proximo or role[:1] == "s" and estado == "":
            heapq.heappush(fila, (custo + mais, audit + "K", i + 1, role[:1], (*saida, f"{role}:{text}")))
    raise AssertionError


def simples(linhas, todas):
    r = {}
    for conv in {x[0] for x in todas}:
        dela = em_ordem([x[1:] for x in linhas if x[0] == conv])
        fs = falhas(dela)
        turnos = [x[0] for x in dela if x[0] is not None]
        custo, audit, saida = cheapest(dela, fs)
        iniciais = [x[1][:1] for x in dela]
        r[conv] = (
            max(turnos) - min(turnos) + 1 - len(set(turnos)) if turnos else 0,
            *(fs.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(iniciais, iniciais[1:])),
            custo, audit, hashlib.sha256("\n".join(saida).encode()).hexdigest(),
        )
    return r


def conferido(spark, linhas):
    df = conversas.op11_conversas(tabela(spark, linhas))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    r = {x[0]: tuple(x)[1:] for x in df.collect()}
    assert r == simples(danos(linhas), linhas)
    return r


PAPEIS = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
TEXTOS = ["Oi.", "Oi.", "Sim!", "cut", "cut off\n", " \t", "", None, "fim?\x0b ", ". x", "é.", "Ω"]


def ao_acaso(sorte, convs, linhas):
    return [(c, sorte.choice([t, t, t, None, 7]), sorte.choice(PAPEIS), sorte.choice(TEXTOS)) for c in range(convs) for t in range(sorte.randint(0, linhas))]


@pytest.mark.parametrize("bits", [12, 1])
def test_random_conversations(spark, bits, monkeypatch):
    monkeypatch.setattr(conversas, "BITS_DO_TRECHO", bits)
    sorte = random.Random(bits)
    conferido(spark, ao_acaso(sorte, 150, 9) + [(None, t, "user", "x.") for t in range(4)])


def test_one_long_conversation_over_many_stretches_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversas, "BITS_DO_TRECHO", 3)
    sorte = random.Random(4)
    longa = [(5, t, sorte.choice(PAPEIS[:5]), f"t{sorte.randint(0, 900)}" + sorte.choice(".!?x")) for t in range(1500)]
    so_sistema = [(6, t, "system", f"s{t}.") for t in range(400)]  # the states' audits never meet
    iguais = [(7, None, "user", "same.") for _ in range(300)]
    r = conferido(spark, longa + so_sistema + iguais + ao_acaso(sorte, 5, 4))
    assert r[7][2] in (0, 299, 599) and len(r[5][6]) >= 1300


def test_edges(spark):
    extremos = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    df = conversas.op11_conversas(tabela(spark, extremos)).collect()
    assert len(df) == 1
    if df[0].audit.count("K") == 2:
        assert df[0].gaps is None
    todas_fora = next(t for t in range(1000) if zlib.crc32(f"2:{t}".encode()) % 20 == 0)
    r = conferido(spark, [(2, todas_fora, "user", "gone."), (3, None, None, None), (4, 0, "user", "x" * 200_000)])
    assert r[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversas.op11_conversas(tabela(spark, [])).collect() == []


def test_repaired_rows(spark):
    linhas = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c"), (1, 3, "user", "a."), (2, 0, "", "x."), (3, 0, "user", " ")]
    r = {}
    for x in conversas.repara(tabela(spark, linhas)).orderBy("conv_id", "place").collect():
        r.setdefault(x.conv_id, []).append((x.place, x.turn, x.role, x.text, x.edit))
    assert r == {
        1: [(0, 0, "user", "a.", "K"), (1, None, "assistant", "", "I"), (2, 1, "user", "b.", "K"), (3, 2, "assistant", "c", "K")],
    }  # of conversation 2 the row goes: 4 is less than 3 + 3


def test_order_of_the_table_does_not_matter(spark):
    linhas = ao_acaso(random.Random(8), 30, 8)
    um = sorted(conversas.op11_conversas(tabela(spark, linhas).repartition(1)).collect(), key=str)
    outro = sorted(conversas.op11_conversas(tabela(spark, linhas[::-1]).repartition(7)).collect(), key=str)
    assert um == outro


@pytest.mark.parametrize("modulo", [conversas._MODULO, 3, 1])
def test_comparisons_of_audits(modulo):
    """Also where hashes collide, and after dead nodes are dropped."""
    sorte = random.Random(modulo)
    nos = conversas.Auditorias(modulo)
    vivos = [(0, "")]
    for passo in range(1500):
        no, texto = sorte.choice(vivos[-12:])
        letra = sorte.choice("DIKR" if passo % 3 else "D")
        igual = next((x for x in vivos if x[1] == texto + letra), None)
        vivos.append(igual or (nos.nova(no, letra), texto + letra))
        if passo % 400 == 399:
            vivos = list(dict(vivos[-40:]).items())
            vivos = list(zip(nos.limpa([n for n, _ in vivos]), [t for _, t in vivos]))
    for _ in range(3000):
        (a, ta), (b, tb) = sorte.choice(vivos), sorte.choice(vivos)
        assert nos.menor(a, b) == (ta < tb)
        assert nos.texto(a) == ta


def test_dead_nodes_are_dropped(monkeypatch):
    sorte = random.Random(2)
    codigos = [sorte.randrange(16) for _ in range(3000)]
    inteiro = conversas.Reparo()
    monkeypatch.setattr(conversas, "NOS_ATE_LIMPAR", 200)
    limpo = conversas.Reparo()
    for c in codigos:
        inteiro.linha(c)
        limpo.linha(c)
    assert inteiro.fim() == limpo.fim()
    assert len(limpo.nos.pai) < len(inteiro.nos.pai) / 2

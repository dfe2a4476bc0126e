"""Secrets in texts: three surface patterns, and encodings that are confirmed by decoding them.

Surface kinds are reported as they match: ``assign`` (a name, a sign and a value), ``access`` (access key ids), ``hex``
(long runs of hexadecimal digits). The others are reported only if their structure holds:

* ``jwt``: three base64url parts; the first decodes to a JSON object with a text ``alg``, the second to a JSON object,
  the third to some bytes unless ``alg`` is ``none``. Headers are found by decoding, however their object is written.
* ``pem``: an armoured private key whose body decodes to a key encoding (or, with an encryption header, to whole cipher
  blocks).
* ``key``: base64 or hexadecimal digits, on one line or wrapped into lines of one width, that decode to a key encoding, to an
  armoured private key or to a signed token. A key may be glued to a path or a name by ``/``, ``-``, ``_`` or ``+``, and hexadecimal digits may
  follow ``0x``; the span begins where the decoded digits do and ends where they or their padding do.

A key encoding is a DER sequence whose nested lengths add up exactly and whose members are those of an RSA, DSA, EC,
PKCS#8 or encrypted PKCS#8 key, or an OpenSSH key whose nested lengths do.

Defined results: NULL and empty texts have no spans. Spans are code points, end exclusive, of the whole match, sorted by
start and then by kind in the order above; spans of different kinds may overlap. Further columns travel with their rows.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIPOS = ("assign", "access", "hex", "jwt", "pem", "key")
BASE = TIPOS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_NOMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[^-]|-(?!----))*)-----END \1-----")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
#: A token's header is a JSON object: ``{`` gives the digit ``e``, a quote, space or line break after it ``y`` or ``w``.
_CABECALHO = re.compile(r"(?<![A-Za-z0-9])e[yw][A-Za-z0-9_-]*")
_CABECALHO_COLADO = re.compile(r"(?<=[_-])e[yw]")
_CORPO = re.compile(r"\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
#: First digits of a DER sequence, an OpenSSH key, an armour and a token, in base64; of the first two in hexadecimal.
_INICIO = re.compile(r"(?<![A-Za-z0-9])(?:M[A-P]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi|ZX[klcd])")
_INICIO_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-9A-Fa-f]{38}|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd])")
#: What the first digits of an armour, a token and an OpenSSH key decode to, if they are worth decoding on.
_COMECOS = {
    "L": re.compile(rb"-----BEGIN [A-Z0-9 ]{0,40}PRIV"),
    "Z": re.compile(rb"[A-Za-z0-9_.-]{40}"),
    "b": re.compile(rb"openssh-key-v1\x00\x00\x00\x00[\x01-\x40]"),
}
_DIGITOS = re.compile(r"[A-Za-z0-9+/_-]+")
_DIGITOS_HEX = re.compile(r"[0-9A-Fa-f]+")
_QUEBRA = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[ \t]*")
#: No key is longer, in bytes, unless it fills its run of digits from the first to the last; no header of a glued token in digits.
MAX_CHAVE = 1 << 16
MAX_CABECALHO = 1 << 14

_SEQUENCIA, _INTEIRO, _OCTETOS, _OID = 0x30, 0x02, 0x04, 0x06


def _der(b: bytes) -> list[tuple[int, bytes]] | None:
    """Members (tag, content) that fill ``b`` exactly, or None."""
    membros, i = [], 0
    while i < len(b):
        if i + 2 > len(b):
            return None
        tipo, n = b[i], b[i + 1]
        i += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or i + k > len(b):
                return None
            n = int.from_bytes(b[i : i + k], "big")
            if n < 0x80 or n >> (8 * (k - 1)) == 0:  # not the shortest form
                return None
            i += k
        if i + n > len(b):
            return None
        membros.append((tipo, b[i : i + n]))
        i += n
    return membros


def _chave_der(b: bytes) -> bool:
    fora = _der(b)
    if not fora or len(fora) != 1 or fora[0][0] != _SEQUENCIA:
        return False
    membros = _der(fora[0][1])
    if not membros:
        return False
    tipos = [t for t, _ in membros]
    if tipos[:2] == [_SEQUENCIA, _OCTETOS] and len(tipos) == 2:  # encrypted PKCS#8
        return _algoritmo(membros[0][1])
    if tipos[0] != _INTEIRO or len(membros[0][1]) != 1:
        return False
    versao = membros[0][1][0]
    if tipos[1:3] == [_SEQUENCIA, _OCTETOS]:  # PKCS#8
        return versao in (0, 1) and _algoritmo(membros[1][1]) and all(t in (0xA0, 0xA1, 0x81) for t in tipos[3:])
    if versao == 1 and tipos[1:2] == [_OCTETOS]:  # EC
        return len(membros[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tipos[2:])
    if versao in (0, 1) and set(tipos[1:]) == {_INTEIRO} and len(tipos) in (6, 9):  # DSA, RSA
        return len(membros[1][1]) >= 32
    return False


def _algoritmo(b: bytes) -> bool:
    membros = _der(b)
    return bool(membros) and membros[0][0] == _OID and len(membros[0][1]) >= 3


def _fim_ssh(b: bytes) -> int:
    """Length of the OpenSSH key that ``b`` begins with, or 0."""
    marca = b"openssh-key-v1\x00"
    if not b.startswith(marca):
        return 0
    i = len(marca)
    for campo in range(3):  # cipher, key derivation, its options
        n = int.from_bytes(b[i : i + 4], "big")
        i += 4 + n
        if i + 4 > len(b) or campo < 2 and not n:
            return 0
    quantas = int.from_bytes(b[i : i + 4], "big")
    i += 4
    if not 1 <= quantas <= 16:
        return 0
    for _ in range(quantas + 1):  # public keys, then the private block
        if i + 4 > len(b):
            return 0
        i += 4 + int.from_bytes(b[i : i + 4], "big")
    return i if i <= len(b) else 0


def _fim_der(b: bytes) -> int:
    """Length that the DER sequence at the start of ``b`` claims, or 0 if its first member is none of a private key."""
    if len(b) < 8 or b[0] != _SEQUENCIA:
        return 0
    k = b[1] & 0x7F if b[1] & 0x80 else 0
    if k > 4 or len(b) < 5 + k:
        return 0
    n = int.from_bytes(b[2 : 2 + k], "big") if k else b[1]
    dentro = b[2 + k :]
    if dentro[0] == _SEQUENCIA or dentro[0] == _INTEIRO and dentro[1] == 1 and dentro[2] < 2:
        return 2 + k + n
    return 0


def _chave(b: bytes | None) -> bool:
    return bool(b) and (_chave_der(b) or _fim_ssh(b) == len(b))


def _de_base64(s: str) -> bytes | None:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _objeto(s: str) -> dict | None:
    try:
        o = json.loads(_de_base64(s) or b"")
    except (ValueError, RecursionError):
        return None
    return o if isinstance(o, dict) else None


def _jwt(cabecalho: str, corpo: str, assinatura: str) -> bool:
    h = _objeto(cabecalho)
    if h is None or not isinstance(h.get("alg"), str) or _objeto(corpo) is None:
        return False
    return h["alg"].lower() == "none" or bool(_de_base64(assinatura))


def _tokens(texto: str) -> Iterator[tuple[int, int]]:
    """Spans of signed tokens: dotted runs whose first, from its start or from a sign that glues it to a name, is a header."""
    livre = 0
    for m in _CABECALHO.finditer(texto):
        resto = _CORPO.match(texto, m.end()) if m.start() >= livre else None
        if resto is None:
            continue
        colados = (c.start() for c in _CABECALHO_COLADO.finditer(texto, max(m.start() + 1, m.end() - MAX_CABECALHO), m.end()))
        for inicio in (m.start(), *colados):
            if _jwt(texto[inicio : m.end()], resto.group(1), resto.group(2)):
                livre = resto.end()
                yield inicio, livre
                break


def _pem(corpo: str) -> bool:
    linhas = corpo.replace("\\r", "").replace("\\n", "\n").split("\n")
    dados = _de_base64("".join("".join(x.split()) for x in linhas if ":" not in x))
    if any(x.startswith("DEK-Info:") for x in map(str.strip, linhas)):
        return bool(dados) and len(dados) % 8 == 0
    return _chave(dados)


def _junta(texto: str, i: int, quantos: int, digitos: re.Pattern) -> tuple[str, int]:
    """Up to so many digits from ``i`` on, over line breaks and indentation, and where they end."""
    partes, fim = [], i
    while quantos and (m := digitos.match(texto, i, i + quantos)):
        partes.append(m.group())
        fim = m.end()
        quantos -= fim - i
        quebra = _QUEBRA.match(texto, fim) if quantos else None
        if quebra is None:
            break
        i = quebra.end()
    return "".join(partes), fim


def _cifras(n: int) -> int:
    """Base64 digits of ``n`` bytes, without padding."""
    return (4 * n + 2) // 3


def _prefixo(s: str) -> bytes:
    return _de_base64(s[: len(s) - (len(s) % 4 == 1)]) or b""


def _fim_em_base64(texto: str, i: int, fim_da_corrida: int) -> int:
    """End of the key, armour or token whose base64 digits begin at ``i``, or 0."""
    limite = _cifras(MAX_CHAVE)
    if texto[i] == "M":
        n = _fim_der(_prefixo(_junta(texto, i, 24, _DIGITOS)[0]))
        if not n or _cifras(n) > max(limite, fim_da_corrida - i):
            return 0
        s, fim = _junta(texto, i, _cifras(n), _DIGITOS)
        if len(s) < _cifras(n) or not _chave_der(_de_base64(s) or b""):
            return 0
        inteira = True
    else:
        if not _COMECOS[texto[i]].match(_prefixo(_junta(texto, i, 80, _DIGITOS)[0])):
            return 0
        dados = _prefixo(_junta(texto, i, max(limite, fim_da_corrida - i), _DIGITOS)[0])
        n, inteira = _fim_ssh(dados), True
        if not n:
            escrito, inteira = dados.decode("latin-1"), False
            if texto[i] == "L":
                n = next((m.end() for m in _PEM.finditer(escrito) if _pem(m.group(2))), 0)
            elif primeiro := next(_tokens(escrito), None):
                n = primeiro[1] if primeiro[0] == 0 else 0
            while 0 < n < len(dados) and dados[n] in b"\r\n\t ":
                n += 1
        if not n:
            return 0
        fim = _junta(texto, i, _cifras(n), _DIGITOS)[1]
    enche = 0
    while enche < -_cifras(n) % 4 and texto[fim : fim + 1] == "=":
        fim, enche = fim + 1, enche + 1
    # digits that go on behind a key belong to something longer
    return 0 if inteira and not enche and texto[fim : fim + 1].isalnum() and texto[fim].isascii() else fim


def _fim_em_hex(texto: str, i: int) -> int:
    """End of the key whose hexadecimal digits begin at ``i``, or 0."""
    m = _DIGITOS_HEX.match(texto, i)
    limite = max(2 * MAX_CHAVE, m.end() - i)
    if texto[i] == "3":
        n = _fim_der(bytes.fromhex(texto[i : i + 40]))
    else:
        s = _junta(texto, i, limite, _DIGITOS_HEX)[0]
        n = _fim_ssh(bytes.fromhex(s[: len(s) // 2 * 2]))
    if not n or 2 * n > limite:
        return 0
    s, fim = _junta(texto, i, 2 * n, _DIGITOS_HEX)
    if len(s) < 2 * n or not _chave(bytes.fromhex(s)):
        return 0
    return 0 if _DIGITOS_HEX.match(texto, fim) else fim


def _chaves(texto: str) -> Iterator[tuple[int, int]]:
    """Spans of encoded keys, armours and tokens; of overlapping ones the first, base64 and hexadecimal apart."""
    livre = 0
    for corrida in _BASE64.finditer(texto):
        for m in _INICIO.finditer(texto, corrida.start(), corrida.end()):
            if m.start() >= livre and (fim := _fim_em_base64(texto, m.start(), corrida.end())):
                livre = fim
                yield m.start(), fim
    livre = 0
    for m in _INICIO_HEX.finditer(texto):
        if m.start() >= livre and (fim := _fim_em_hex(texto, m.start())):
            livre = fim
            yield m.start(), fim


def procura(texto: str | None) -> list[tuple[int, int, int]]:
    """Spans (start, number of the kind, end) of a text, sorted."""
    if not texto:
        return []
    achados = []
    baixo = texto.lower()
    if any(n in baixo for n in _NOMES):
        achados += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(texto) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in texto:
        achados += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(texto) if m.end() - m.start() >= 16]
    achados += [(m.start(), 2, m.end()) for m in _HEX.finditer(texto)]
    achados += [(a, 3, z) for a, z in _tokens(texto)]
    if "-----BEGIN " in texto:
        achados += [(m.start(), 4, m.end()) for m in _PEM.finditer(texto) if _pem(m.group(2))]
    achados += [(a, 5, z) for a, z in _chaves(texto)]
    return sorted(achados)


_SAIDA = T.StructType(
    [T.StructField(f"n_{t}", T.LongType()) for t in TIPOS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def segredos(docs: DataFrame, texto: str = "text") -> DataFrame:
    """Add to each document the number of spans of each kind, the digest of the surface spans, and all spans as
    ``kind:start:end`` joined by commas. Columns of these names are replaced."""
    colunas = [c for c in docs.columns if c not in _SAIDA.names]
    campos = [pa.field(f"n_{t}", pa.int64()) for t in TIPOS] + [pa.field("base_sha256", pa.string()), pa.field("spans", pa.string())]
    onde = len(colunas)

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            saida: list[list] = [[] for _ in campos]
            for t in lote.column(onde):
                achados = procura(t.as_py())
                escritos = [f"{TIPOS[k]}:{a}:{b}" for a, k, b in achados]
                base = ",".join(e for e, (_, k, _) in zip(escritos, achados) if k < len(BASE))
                quantos = [0] * len(TIPOS)
                for _, k, _ in achados:
                    quantos[k] += 1
                for coluna, v in zip(saida, (*quantos, hashlib.sha256(base.encode()).hexdigest(), ",".join(escritos))):
                    coluna.append(v)
            yield pa.RecordBatch.from_arrays(
                [lote.column(i) for i in range(onde)] + [pa.array(v, c.type) for v, c in zip(saida, campos)],
                schema=pa.schema([lote.schema.field(i) for i in range(onde)] + campos),
            )

    esquema = T.StructType([docs.schema[c] for c in colunas] + list(_SAIDA))
    return docs.select(*colunas, F.col(texto).cast("string").alias("__texto")).mapInArrow(tarefa, esquema)


def op2_segredos(documentos: DataFrame) -> DataFrame:
    return segredos(documentos.select("doc_id", F.col("text").alias("__t")), "__t").drop("__t")

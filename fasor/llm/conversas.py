"""Repair of conversations: the cheapest edits that give every conversation a legal order of roles.

A legal conversation is empty, or pairs of user and assistant after at most one system row. Rows may be kept (cost 0),
given the role user or assistant (3) or deleted (4, required for blank rows and repetitions), and empty rows of user or
assistant may be inserted anywhere (3); a truncated row that stays adds 3. Of equally cheap edits the audit, one letter
an edit, that is least in ASCII counts.

The dynamic program keeps, for each of four states of the order of roles, the least cost and the audit so far. Audits are
linked nodes that share their prefixes: a node has its parent, its letter, a rolling hash of all letters up to it, and
ancestors at distances of powers of two (as many as its depth is divisible by). Audits of equal cost are compared by
looking for their longest common prefix with these ancestors and hashes; equal hashes of different nodes are checked
letter by letter. So a row costs a few nodes and steps, however long the audits are.

How it is dealt out: rows are sorted by conversation and turn over all tasks, so a conversation of any size is spread;
repetitions are those that are not the first of their text, found by a minimum per text; up to 4096 neighbouring rows
become a string of one letter each. Only these strings of a conversation meet in one task, in order, as its audit (one
string of the result) must; texts then stream past their edits, one row at a time, as the digest of all must.

Defined results: NULL role and text count as one space. Turns are sorted with NULL first; rows of one turn by the digest
of role and text, so that the order of the table does not matter and equal rows are neighbours. Roles count by their
first character (none if empty); a row whose role begins otherwise than s, u, a cannot be kept as it is. NULL is a
conversation of its own. Gaps that no bigint holds are NULL. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fasor.llm.comum import materializa
from fasor.operators.materializa import apaga, provisorios

#: Rows of a stretch, as a power of two.
BITS_DO_TRECHO = 12
#: Dead nodes are dropped when so many nodes have been added.
NOS_ATE_LIMPAR = 1 << 17

_MODULO = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % _MODULO
_SEM_CUSTO = 1 << 60

#: States: nothing yet, after a system row, after a user, after an assistant. By state the one a user or assistant leads to.
INICIO, SISTEMA, USUARIO, ASSISTENTE = range(4)
_SEGUINTE = (USUARIO, USUARIO, ASSISTENTE, USUARIO)
_MANTER, _TROCAR, _APAGAR, _INSERIR = 0, 3, 4, 3
_TRUNCADA = 3
_PAPEIS = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}

#: A row is one letter: 65 + 4 * fault (none, blank, duplicate, truncated) + initial (other, s, u, a).
FALHAS = ("", "blank", "duplicate", "truncated")
INICIAIS = " sua"


class Auditorias:
    """Strings that share prefixes, as nodes of a tree. Node 0 is the empty string."""

    def __init__(self, modulo: int = _MODULO) -> None:
        self.modulo = modulo
        self.pai = [0]
        self.letra = [""]
        self.fundo = [0]
        self.hash = [0]
        self.inicio = [0]  # of a node's farther ancestors
        self.acima = array("q")  # 2, 4, 8, ... above

    def nova(self, pai: int, letra: str) -> int:
        no = len(self.pai)
        fundo = self.fundo[pai] + 1
        self.pai.append(pai)
        self.letra.append(letra)
        self.fundo.append(fundo)
        self.hash.append((self.hash[pai] * _BASE + ord(letra)) % self.modulo)
        self.inicio.append(len(self.acima))
        k = 1
        while not fundo & ((1 << k) - 1):
            self.acima.append(self._acima(self._acima(no, k - 1), k - 1))
            k += 1
        return no

    def _acima(self, no: int, k: int) -> int:
        """Ancestor 2 ** k above; the depth is divisible by that."""
        return self.acima[self.inicio[no] + k - 1] if k else self.pai[no]

    def _ate(self, no: int, fundo: int) -> int:
        """Ancestor at a depth."""
        while (falta := self.fundo[no] - fundo) > 0:
            h = self.fundo[no]
            no = self._acima(no, min((h & -h).bit_length(), falta.bit_length()) - 1)
        return no

    def iguais(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are one string; what the hashes say is checked."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letra[a] != self.letra[b]:
                return False
            a, b = self.pai[a], self.pai[b]
        return True

    def menor(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` is less than that of ``b``."""
        fa, fb = self.fundo[a], self.fundo[b]
        comum = min(fa, fb)
        x, y = self._ate(a, comum), self._ate(b, comum)
        if self.iguais(x, y):
            return fa < fb
        while True:  # x and y differ: go as far up as they still do
            h = self.fundo[x]
            for k in range((h & -h).bit_length() - 1, -1, -1):
                p, q = self._acima(x, k), self._acima(y, k)
                if not self.iguais(p, q):
                    x, y = p, q
                    break
            else:
                return self.letra[x] < self.letra[y]

    def texto(self, no: int) -> str:
        letras = []
        while no:
            letras.append(self.letra[no])
            no = self.pai[no]
        return "".join(reversed(letras))

    def limpa(self, vivos: list[int]) -> list[int]:
        """Keep only the nodes on the way to ``vivos``; returns their new numbers."""
        ficam = {0}
        for no in vivos:
            while no not in ficam:
                ficam.add(no)
                no = self.pai[no]
        novo = {0: 0}
        velhos = self.pai, self.letra
        self.__init__(self.modulo)
        for no in sorted(ficam - {0}):  # parents have smaller numbers
            novo[no] = self.nova(novo[velhos[0][no]], velhos[1][no])
        return [novo[no] for no in vivos]


class Reparo:
    """The dynamic program over the rows of one conversation, in order."""

    def __init__(self) -> None:
        self.nos = Auditorias()
        self.custo = [0, _SEM_CUSTO, _SEM_CUSTO, _SEM_CUSTO]
        self.no = [0, 0, 0, 0]
        self._limite = NOS_ATE_LIMPAR
        self._insere()

    def _melhor(self, estado: int, ofertas: list[tuple[int, int, str]]) -> tuple[int, int]:
        """The least of (cost, node before, letter); no letter means that the node is already the whole."""
        custo = min(o[0] for o in ofertas)
        if custo >= _SEM_CUSTO:
            return _SEM_CUSTO, 0
        melhor = -1
        for c, pai, letra in ofertas:
            if c == custo:
                no = self.nos.nova(pai, letra) if letra else pai
                if melhor < 0 or self.nos.menor(no, melhor):
                    melhor = no
        return custo, melhor

    def _insere(self) -> None:
        """Insertions at this place. More than a user and an assistant in a row lead back, and so are never cheapest."""
        for estado, de in ((USUARIO, (INICIO, SISTEMA, ASSISTENTE)), (ASSISTENTE, (USUARIO,))):
            ofertas = [(self.custo[e] + _INSERIR, self.no[e], "I") for e in de if self.custo[e] + _INSERIR <= self.custo[estado]]
            if ofertas:
                ofertas.append((self.custo[estado], self.no[estado], ""))
                self.custo[estado], self.no[estado] = self._melhor(estado, ofertas)

    def linha(self, codigo: int) -> None:
        falha, inicial = divmod(codigo, 4)
        ofertas: list[list[tuple[int, int, str]]] = [[], [], [], []]
        for e in range(4):
            c = self.custo[e]
            if c >= _SEM_CUSTO:
                continue
            no = self.no[e]
            ofertas[e].append((c + _APAGAR, no, "D"))
            if falha in (1, 2):
                continue
            fica = c + (_TRUNCADA if falha == 3 else 0)
            seguinte = _SEGUINTE[e]
            ofertas[seguinte].append((fica + _TROCAR, no, "R"))
            if inicial == seguinte or inicial == SISTEMA and e == INICIO:
                ofertas[inicial].append((fica + _MANTER, no, "K"))
        for e, dele in enumerate(ofertas):
            self.custo[e], self.no[e] = self._melhor(e, dele) if dele else (_SEM_CUSTO, 0)
        self._insere()
        if len(self.nos.pai) > self._limite:
            self.no = self.nos.limpa(self.no)
            self._limite = len(self.nos.pai) + NOS_ATE_LIMPAR

    def fim(self) -> tuple[int, str]:
        """Least cost and audit of all rows so far."""
        fins = [(self.custo[e], self.no[e], "") for e in (INICIO, ASSISTENTE)]
        custo, no = self._melhor(INICIO, fins)
        return custo, self.nos.texto(no)


def pecas(auditoria: str, codigos: bytes) -> tuple[list[str], str]:
    """What the edits make of each row: roles of rows inserted before it (u, a), then K, D, or the new role (U, A).
    The second part are the roles of rows inserted after the last one."""
    feitas, antes, estado, i = [], "", INICIO, 0
    for letra in auditoria:
        if letra == "I":
            estado = _SEGUINTE[estado]
            antes += INICIAIS[estado]
            continue
        if letra == "K":
            estado = (codigos[i] - 65) % 4
        elif letra == "R":
            estado = _SEGUINTE[estado]
            letra = INICIAIS[estado].upper()
        feitas.append(antes + letra)
        antes = ""
        i += 1
    return feitas, antes


_LEGAIS = {(SISTEMA, USUARIO), (USUARIO, ASSISTENTE), (ASSISTENTE, USUARIO)}

_PLANO = "id bigint, pecas array<string>, fim string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_TOTAIS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _plano_da_conversa(trechos: list[dict]) -> Iterator[dict]:
    """Edits of each stretch; the totals stand with the first one."""
    codigos = "".join(t["codigos"] for t in trechos).encode()
    reparo = Reparo()
    for c in codigos:
        reparo.linha(c - 65)
    cost, audit = reparo.fim()
    falhas = [sum(codigos.count(65 + 4 * f + i) for i in range(4)) for f in range(4)]
    iniciais = [(c - 65) % 4 for c in codigos]
    vistos = [t for t in trechos if t["minimo"] is not None]
    gaps = 0
    if vistos:
        distintos = sum(t["distintos"] for t in vistos) - sum(a["maximo"] == b["minimo"] for a, b in zip(vistos, vistos[1:]))
        gaps = vistos[-1]["maximo"] - vistos[0]["minimo"] + 1 - distintos
    totais = {
        "gaps": gaps if -(1 << 63) <= gaps < 1 << 63 else None,
        "blank": falhas[1],
        "duplicate": falhas[2],
        "truncated": falhas[3],
        "illegal": sum(p not in _LEGAIS for p in zip(iniciais, iniciais[1:])),
        "cost": cost,
        "audit": audit,
    }
    todas, fim = pecas(audit, codigos)
    feitas = 0
    for n, t in enumerate(trechos, 1):
        quantas = len(t["codigos"])
        yield {"id": t["id"], "pecas": todas[feitas : feitas + quantas], "fim": fim if n == len(trechos) else "", **totais}
        feitas += quantas
        totais = dict.fromkeys(totais)


def _grupos(lotes: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict]]]:
    """Rows of each conversation; those of one follow each other."""
    grupo: list[dict] = []
    for lote in lotes:
        for linha in lote.to_pylist():
            if grupo and grupo[0]["conv_id"] != linha["conv_id"]:
                yield grupo[0]["conv_id"], grupo
                grupo = []
            grupo.append(linha)
    if grupo:
        yield grupo[0]["conv_id"], grupo


def _em_lotes(linhas: Iterator[dict], esquema: pa.Schema, n: int = 1024) -> Iterator[pa.RecordBatch]:
    juntas: list[dict] = []
    for linha in linhas:
        juntas.append(linha)
        if len(juntas) == n:
            yield pa.RecordBatch.from_pylist(juntas, schema=esquema)
            juntas = []
    if juntas:
        yield pa.RecordBatch.from_pylist(juntas, schema=esquema)


def _esquema(tipo_conv: T.DataType, resto: str) -> tuple[T.StructType, pa.Schema]:
    spark = T.StructType([T.StructField("conv_id", tipo_conv), *T._parse_datatype_string(resto).fields])
    return spark, pa.schema([(c.name, to_arrow_type(c.dataType)) for c in spark])


def _ordenadas(conversas: DataFrame) -> DataFrame:
    """All rows in order with an id that grows along a task's rows, written out: conv_id, turn, role, text, igual, id."""
    vazio = F.lit(" ")
    role, text = F.coalesce("role", vazio), F.coalesce("text", vazio)
    igual = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    linhas = conversas.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    chaves = ["conv_id", "turn", "igual", "__copia"]  # equal rows of one turn may be spread over tasks, too
    linhas = linhas.withColumns({"igual": igual, "__copia": F.monotonically_increasing_id()})
    linhas = linhas.repartitionByRange(*chaves).sortWithinPartitions(*chaves)
    return materializa(linhas.drop("__copia").withColumn("id", F.monotonically_increasing_id()))


def _codigo(primeira: Column) -> Column:
    """The letter of a row."""
    branco = " \t\n\x0b\x0c\r"
    resto = F.rtrim("text", F.lit(branco))
    falha = (
        F.when(resto == "", 1)
        .when(~primeira, 2)
        .when(~F.right(resto, F.lit(1)).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    inicial = F.greatest(F.instr(F.lit(INICIAIS), F.substring("role", 1, 1)) - 1, F.lit(0))
    return F.char(65 + 4 * falha + F.when(F.length("role") == 0, 0).otherwise(inicial))


def _planos(linhas: DataFrame) -> DataFrame:
    """Edits of every stretch of every conversation, and the totals of the conversation with its first one. Written out."""
    primeiras = linhas.groupBy("conv_id", "igual").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("__primeira"))
    letras = linhas.select("conv_id", "turn", "id", "role", "text", "igual").join(primeiras, "id", "left")
    letras = letras.select("conv_id", "turn", "id", _codigo(F.coalesce("__primeira", F.lit(False))).alias("letra"))
    trechos = letras.groupBy("conv_id", F.shiftright("id", BITS_DO_TRECHO).alias("trecho")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "letra"))), lambda x: x["letra"]), "").alias("codigos"),
        F.min("id").alias("id"),
        F.min("turn").alias("minimo"),
        F.max("turn").alias("maximo"),
        F.size(F.collect_set("turn")).cast("bigint").alias("distintos"),
    )
    esquema, arrow = _esquema(linhas.schema["conv_id"].dataType, _PLANO)

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def planos() -> Iterator[dict]:
            for conv, grupo in _grupos(lotes):
                for plano in _plano_da_conversa(grupo):
                    yield {"conv_id": conv, **plano}

        yield from _em_lotes(planos(), arrow, 64)

    return materializa(trechos.repartition("conv_id").sortWithinPartitions("conv_id", "id").mapInArrow(tarefa, esquema))


def _com_planos(linhas: DataFrame, planos: DataFrame) -> DataFrame:
    """Rows behind the edits of their stretch, in order, each conversation in one task."""
    juntas = planos.unionByName(linhas.select("conv_id", "id", "turn", "role", "text"), allowMissingColumns=True)
    return juntas.repartition("conv_id").sortWithinPartitions("conv_id", "id", F.col("pecas").isNull())


def _editadas(lotes: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, object, object, str, str, str]]:
    """Repaired rows from the rows of ``_com_planos``: totals (with the first of a conversation's rows, which may be no
    repaired row: then without an edit), conversation, turn, role, text, edit."""
    plano: dict = {}
    primeiro = feitas = 0
    for lote in lotes:
        for x in lote.to_pylist():
            conv = x["conv_id"]
            if x["pecas"] is not None:
                plano, primeiro, feitas = x, x["id"], 0
                if x["cost"] is not None:
                    yield {k: x[k] for k in _TOTAIS}, conv, None, "", "", ""
                continue
            peca = plano["pecas"][x["id"] - primeiro]
            for p in peca[:-1]:
                yield None, conv, None, _PAPEIS[p], "", "I"
            if peca[-1] != "D":
                trocada = _PAPEIS.get(peca[-1])
                yield None, conv, x["turn"], trocada or x["role"], x["text"], "R" if trocada else "K"
            feitas += 1
            if feitas == len(plano["pecas"]):
                for p in plano["fim"]:
                    yield None, conv, None, _PAPEIS[p], "", "I"


def repara(conversas: DataFrame) -> DataFrame:
    """The repaired conversations: columns conv_id, place (from 0), turn (NULL if inserted), role, text, edit (K, R, I).

    ``conversas`` has conv_id, turn, role and text.
    """
    linhas = _ordenadas(conversas)
    esquema, arrow = _esquema(conversas.schema["conv_id"].dataType, "place bigint, turn bigint, role string, text string, edit string")

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linhas() -> Iterator[dict]:
            lugar = 0
            for totais, conv, turn, role, text, edit in _editadas(lotes):
                if totais is not None:
                    lugar = 0
                    continue
                yield {"conv_id": conv, "place": lugar, "turn": turn, "role": role, "text": text, "edit": edit}
                lugar += 1

        yield from _em_lotes(linhas(), arrow)

    return _com_planos(linhas, _planos(linhas)).mapInArrow(tarefa, esquema)


def audita(conversas: DataFrame) -> DataFrame:
    """Per conversation with rows: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    with provisorios() as escritos:
        linhas = _ordenadas(conversas)
        planos = _planos(linhas)
    campos = ", ".join(c for c in _PLANO.split(", ") if c.split()[0] in _TOTAIS)
    esquema, arrow = _esquema(conversas.schema["conv_id"].dataType, campos + ", repaired_sha256 string")

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def feitas() -> Iterator[dict]:
            atual: dict | None = None
            soma, vazia = hashlib.sha256(), True
            for totais, conv, _, role, text, _ in _editadas(lotes):
                if totais is not None:
                    if atual is not None:
                        yield {**atual, "repaired_sha256": soma.hexdigest()}
                    atual, soma, vazia = {"conv_id": conv, **totais}, hashlib.sha256(), True
                    continue
                soma.update(f"{'' if vazia else '\n'}{role}:{text}".encode())
                vazia = False
            if atual is not None:
                yield {**atual, "repaired_sha256": soma.hexdigest()}

        yield from _em_lotes(feitas(), arrow, 256)

    feitas = materializa(_com_planos(linhas, planos).mapInArrow(tarefa, esquema))
    apaga(conversas.sparkSession, escritos)
    return feitas


def danifica(conversas: DataFrame) -> DataFrame:
    """Damage rows by the crc32 of conversation and turn, modulo 20; NULLs become one space."""
    vazio = F.lit(" ")
    em_texto = [F.coalesce(F.col(c).cast("string"), vazio) for c in ("conv_id", "turn")]
    linhas = conversas.select(
        "conv_id", "turn", F.coalesce("role", vazio).alias("role"), F.coalesce("text", vazio).alias("text"),
        (F.crc32(F.concat_ws(":", *em_texto)) % 20).alias("__dano"),
    ).filter("__dano <> 0")
    dano = F.col("__dano")
    texto = F.when(dano == 1, "").when(dano == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    linhas = linhas.withColumns({"text": texto, "role": F.when(dano == 4, "user").otherwise(F.col("role"))})
    vezes = F.when(dano == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return linhas.select("conv_id", "turn", "role", "text", F.explode(vezes).alias("__vez")).drop("__vez")


def op11_conversas(conversas: DataFrame) -> DataFrame:
    """The damaged conversations repaired: one row per original conversation."""
    auditadas = audita(danifica(conversas.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")))
    todas = conversas.select(F.col("conv_id").alias("__conv")).distinct()
    juntas = todas.join(auditadas, F.col("__conv").eqNullSafe(F.col("conv_id")), "left")
    sem = F.col("cost").isNull()
    return juntas.select(
        F.col("__conv").alias("conv_id"),
        F.when(sem, F.lit(0)).otherwise(F.col("gaps")).cast("bigint").alias("gaps"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _TOTAIS[1:-1]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


_CHAVE = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

# the candidates of each state hold cost and audit; the least struct is the cheapest, then the least audit
_INSERCOES = """
  SELECT *, CASE WHEN u0 IS NULL THEN a0 ELSE list_min([a0, {'c': u0.c + 3, 'a': u0.a || 'I'}]) END AS a FROM (
    SELECT *, u1 AS u0 FROM (
      SELECT *, list_min([u9, CASE WHEN e IS NULL THEN NULL ELSE {'c': e.c + 3, 'a': e.a || 'I'} END,
                          CASE WHEN s IS NULL THEN NULL ELSE {'c': s.c + 3, 'a': s.a || 'I'} END,
                          CASE WHEN a0 IS NULL THEN NULL ELSE {'c': a0.c + 3, 'a': a0.a || 'I'} END]) AS u1 FROM (%s)))
"""
_VALOR = "STRUCT(c BIGINT, a VARCHAR)"


def _mais(estado: str, custo: str, letra: str, se: str = "true") -> str:
    return f"CASE WHEN {se} AND d.{estado} IS NOT NULL THEN {{'c': d.{estado}.c + {custo}, 'a': d.{estado}.a || '{letra}'}} END"


_FICA = "f NOT IN (1, 2)"
_PESO = "CASE WHEN f = 3 THEN 3 ELSE 0 END"
_PASSO = f"""
  SELECT l.conv, l.i,
    list_min([{_mais("e", "4", "D")}]) AS e,
    list_min([{_mais("s", "4", "D")}, {_mais("e", _PESO, "K", f"{_FICA} AND p = 's'")}]) AS s,
    list_min([{_mais("u", "4", "D")},
              {", ".join(_mais(x, f"3 + {_PESO}", "R", _FICA) for x in "esa")},
              {", ".join(_mais(x, _PESO, "K", f"{_FICA} AND p = 'u'") for x in "esa")}]) AS u9,
    list_min([{_mais("a", "4", "D")}, {_mais("u", f"3 + {_PESO}", "R", _FICA)},
              {_mais("u", _PESO, "K", f"{_FICA} AND p = 'a'")}]) AS a0
  FROM dp d JOIN linhas l ON l.conv = d.conv AND l.i = d.i + 1"""

SQL = f"""
WITH RECURSIVE bruto AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CHAVE} AS chave FROM conversations),
somadas AS (
  SELECT *, xor(list_reduce(flatten([[4294967295::BIGINT]] || list_transform(range(1, length(chave) + 1),
           lambda k: [ascii(chave[k])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
         lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS dano
  FROM bruto),
danificadas AS (
  SELECT conv_id, turn, CASE WHEN dano = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN dano = 1 THEN '' WHEN dano = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN dano = 3 THEN 2 ELSE 1 END)) AS vez
  FROM somadas WHERE dano <> 0),
convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
ordenadas AS (
  SELECT c.conv, turn, role, text, left(role, 1) AS p,
         row_number() OVER (PARTITION BY c.conv ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i
  FROM danificadas d JOIN convs c ON d.conv_id IS NOT DISTINCT FROM c.conv_id),
linhas AS (
  SELECT *, CASE WHEN resto = '' THEN 1 WHEN min(i) OVER (PARTITION BY conv, role, text) < i THEN 2
                 WHEN right(resto, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f
  FROM (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS resto FROM ordenadas)),
dp AS (
  SELECT conv, 0::BIGINT AS i, {{'c': 0, 'a': ''}}::{_VALOR} AS e, NULL::{_VALOR} AS s,
         {{'c': 3, 'a': 'I'}}::{_VALOR} AS u, {{'c': 6, 'a': 'II'}}::{_VALOR} AS a FROM convs
  UNION ALL
  SELECT conv, i, e, s, u1, a FROM ({_INSERCOES % _PASSO})),
fins AS (
  SELECT conv, list_min([e, a]) AS fim FROM dp QUALIFY row_number() OVER (PARTITION BY conv ORDER BY i DESC) = 1),
letras AS (
  SELECT conv, k, fim.a[k] AS letra, len(replace(fim.a[: k], 'I', '')) AS i
  FROM (SELECT conv, fim, unnest(range(1, len(fim.a) + 1)) AS k FROM fins)),
ficam AS (
  SELECT x.conv, x.k, x.letra, l.role, l.text, sum(CASE WHEN l.p = 's' AND x.letra = 'K' THEN 0 ELSE 1 END) OVER
           (PARTITION BY x.conv ORDER BY x.k ROWS UNBOUNDED PRECEDING) AS n
  FROM letras x LEFT JOIN linhas l ON x.letra <> 'I' AND l.conv = x.conv AND l.i = x.i WHERE x.letra <> 'D'),
reparadas AS (
  SELECT conv, string_agg(CASE WHEN letra = 'K' THEN role WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                          CASE WHEN letra = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS texto
  FROM ficam GROUP BY conv),
contas AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
         count(*) FILTER (antes IS NOT NULL AND antes || p NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(p) OVER (PARTITION BY conv ORDER BY i) AS antes FROM linhas) GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, fim.c AS cost, fim.a AS audit,
       sha256(coalesce(texto, '')) AS repaired_sha256
FROM convs LEFT JOIN contas USING (conv) LEFT JOIN fins USING (conv) LEFT JOIN reparadas USING (conv)
"""

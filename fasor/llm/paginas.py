"""Main text of web pages, with site templates found by counting element subtrees per host.

A first pass parses every page and hashes its block subtrees (tags and text, no attributes). Spark counts, per host, in
how many different pages each occurs, inside an article and outside; pages of one main text count once, so that copies of
an article do not make its paragraphs a template. A second pass deletes the subtrees that recur across many pages of their
host, by share or by number, where they recur (a sidebar's teaser does not delete the paragraph it repeats), then the parts
that their tag, class, id or role names as no part of an article, and returns the text of what is left. Names are weak:
no class or id deletes a heading or what is or holds an ``article`` or ``main`` (nor does ``form``, around a whole page);
inside an article only a whole class or id counts (``social``, not ``category-social``), elsewhere any part of it, unless
that leaves nothing of the page. The exception is an ``article`` without a heading whose class or id begins with such a name.

Defined results: NULL and empty pages have empty text. The text comes from the outermost ``article`` elements, else from
``main``, else from ``body``, else from all. Pages without a host take part in no template. Unclosed and stray tags are
borne as browsers bear them. Character references are decoded; white space in a block, ``br`` included, becomes one
space; blocks are joined by an empty line. Repeated rows give repeated rows. Further columns travel with their rows.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fasor.llm.comum import materializa

#: A subtree is a template from so many pages of its host on, outside an article and inside, and so large a share of them ...
MIN_PAGINAS = (3, 8)
PARTE_DAS_PAGINAS = (0.2, 0.5)
#: ... or, on a large host, so many pages whatever the share.
MUITAS_PAGINAS = (100, 1000)
#: Shorter texts recur by chance inside an article, in a text block, and at a small share of a host.
MIN_LETRAS = 25
#: With more templates than this over all hosts, they meet the pages by a shuffle instead of a broadcast.
MAX_BROADCAST = 100_000

_MARCA = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_DO_FIM = re.compile(r"[>\"']")
_ATRIBUTO = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VAZIOS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CRUS = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCOS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
_TITULOS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DE_TEXTO = _TITULOS | frozenset("p li dt dd td th tr blockquote pre caption figcaption summary".split())
#: Templates of a host outside articles and inside.
_Modelos = tuple[frozenset[int], frozenset[int]]
_SEM_MODELOS: _Modelos = (frozenset(), frozenset())
_FORA = frozenset(
    "head script style noscript template iframe svg math canvas object embed applet audio video textarea select button "
    "nav footer aside form menu dialog search title".split()
)
_PAPEIS = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
_NOME = (
    r"(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|newsletter|"
    r"subscri\w*|signup|popup|modal|overlay|side-?bar|rail|menu\w*|nav|navbar|navigation|bread-?crumbs?|masthead|"
    r"site-?header|page-?header|header|footer|site-?footer|comments?|commentlist|disqus|replies|respond|shar(?:e|ing)|"
    r"social|related|recommend\w*|widget|copyright|skip-?link|toolbar|pagination|pager|login|alert)"
)
#: A part of a class or id names boilerplate, all of it does, or its first part does.
_NOMES = re.compile(rf"(?:^|[\s_-]){_NOME}(?:$|[\s_-])", re.IGNORECASE)
_NOMES_INTEIROS = re.compile(rf"(?:^|\s){_NOME}(?:$|\s)", re.IGNORECASE)
_NOMES_PRIMEIROS = re.compile(rf"(?:^|\s){_NOME}(?:$|[\s_-])", re.IGNORECASE)
#: An open element of these is closed by the start of one of those.
_FECHA = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_LIMITES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}


class No:
    __slots__ = ("tag", "atributos", "filhos")

    def __init__(self, tag: str, atributos: str = ""):
        self.tag, self.atributos, self.filhos = tag, atributos, []


class _Marcas:
    """Markup of a page in linear time: what a search has found, or that it finds nothing, is never looked for again."""

    def __init__(self, pagina: str):
        self._p = pagina
        self._achados: dict[str, tuple[int, int]] = {}  # needle: searched from, found at (the length if nowhere)
        self._especial = (0, -1, "")
        self._fim_da_aspa: dict[int, int] = {}

    def acha(self, agulha: str, i: int) -> int:
        de, onde = self._achados.get(agulha, (0, -1))
        if not de <= i <= onde:
            onde = self._p.find(agulha, i)
            onde = len(self._p) if onde < 0 else onde
            self._achados[agulha] = i, onde
        return onde

    def _proximo(self, i: int) -> tuple[int, str]:
        de, onde, qual = self._especial
        if not de <= i <= onde:
            m = _DO_FIM.search(self._p, i)
            onde, qual = (m.start(), m.group()) if m else (len(self._p), "")
            self._especial = i, onde, qual
        return onde, qual

    def fim(self, i: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``i``, outside quotes; -1 if there is none."""
        passadas = []
        while True:
            onde, qual = self._proximo(i)
            if qual in (">", ""):
                fim = onde if qual else -1
                break
            if onde in self._fim_da_aspa:
                fim = self._fim_da_aspa[onde]
                break
            passadas.append(onde)
            i = self.acha(qual, onde + 1) + 1
            if i > len(self._p):
                fim = -1
                break
        for aspa in passadas:
            self._fim_da_aspa[aspa] = fim
        return fim


class _Abertos:
    """The open elements, with the places of each tag among them."""

    def __init__(self, raiz: No):
        self.nos = [raiz]
        self._onde: dict[str, list[int]] = {}

    def ultimo(self, tags: tuple | frozenset) -> int:
        return max((self._onde[t][-1] for t in tags if self._onde.get(t)), default=0)

    def abre(self, no: No) -> None:
        self._onde.setdefault(no.tag, []).append(len(self.nos))
        self.nos.append(no)

    def corta(self, k: int) -> None:
        while len(self.nos) > k:
            self._onde[self.nos.pop().tag].pop()

    def fecha(self, quais: tuple | frozenset, ate: tuple) -> None:
        """Close the innermost of ``quais`` unless one of ``ate`` lies within it."""
        k = self.ultimo(quais)
        if k and k > self.ultimo(ate):
            self.corta(k)


_SEM_SAIDA = ("article", "main", "body", "table")


def arvore(pagina: str) -> No:
    """Element tree of a page; text is kept as written."""
    raiz = No("")
    abertos = _Abertos(raiz)
    marcas = _Marcas(pagina)
    n = len(pagina)
    i = procura = 0  # text from i on is not yet taken
    while i < n:
        m = _MARCA.search(pagina, procura)
        if m is None:
            abertos.nos[-1].filhos.append(pagina[i:])
            break
        tag = m.group(2)
        inteiro = None
        if tag is not None:
            fim = marcas.fim(m.end())
        elif m.group() == "<!--":
            fim = min(marcas.acha("-->", m.end()) + 2, n - 1)
        elif m.group() == "<![CDATA[":
            onde = marcas.acha("]]>", m.end())
            inteiro, fim = pagina[m.end() : onde], min(onde + 2, n - 1)
        else:
            onde = marcas.acha(">", m.end())
            fim = onde if onde < n else -1
        if fim < 0:  # no markup: the sign is text
            procura = m.start() + 1
            continue
        if m.start() > i:
            abertos.nos[-1].filhos.append(pagina[i : m.start()])
        i = procura = fim + 1
        if inteiro is not None:
            abertos.nos[-1].filhos.append(html.escape(inteiro, False))
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            k = abertos.ultimo((tag,))
            if k and (tag in _BLOCOS or k > abertos.ultimo(tuple(t for t in _SEM_SAIDA if t != tag))):
                abertos.corta(k)
            continue
        if tag in _BLOCOS and tag not in ("html", "body"):
            abertos.fecha(("p",), ("button", "td", "th", "table", "article", "li", "div", "section"))
            if tag in _TITULOS and abertos.nos[-1].tag in _TITULOS:
                abertos.corta(len(abertos.nos) - 1)
        if tag in _FECHA:
            abertos.fecha(_FECHA[tag], _LIMITES.get(tag, ("select",)))
        atributos = pagina[m.end() : fim]
        no = No(tag, atributos)
        abertos.nos[-1].filhos.append(no)
        if tag in _CRUS:
            fecho = re.compile(rf"</{tag}\b", re.IGNORECASE).search(pagina, i)
            depois = marcas.acha(">", fecho.end()) if fecho else n
            no.filhos.append(pagina[i : fecho.start() if depois < n else n])
            i = procura = min(depois + 1, n)
        elif tag not in _VAZIOS and not atributos.endswith("/"):
            abertos.abre(no)
    return raiz


def _limpo(s: str) -> str:
    return " ".join(html.unescape(s).split())


def _itera(no: No, dentro: bool = False) -> Iterator[tuple[No, bool]]:
    """Elements with whether they lie inside an article, in page order, without recursion."""
    pilha = [(no, dentro)]
    while pilha:
        no, dentro = pilha.pop()
        yield no, dentro
        dentro = dentro or no.tag == "article"
        pilha += [(f, dentro) for f in reversed(no.filhos) if not isinstance(f, str)]


def _resumos(raiz: No) -> dict[int, tuple[int, int]]:
    """Digest and length of the text of every block subtree that may be a template, by the identity of its node."""
    saida: dict[int, tuple[int, int]] = {}
    resumos: dict[int, tuple[bytes, int]] = {}
    for no, _ in reversed(list(_itera(raiz))):  # children before parents
        h = hashlib.blake2b(no.tag.encode(), digest_size=8)
        letras = 0
        for f in no.filhos:
            if isinstance(f, str):
                s = _limpo(f)
                if s:
                    letras += len(s)
                    h.update(b"\0" + s.encode("utf-8", "replace"))
            else:
                d, k = resumos.pop(id(f))
                letras += k
                h.update(b"\1" + d)
        d = h.digest()
        resumos[id(no)] = d, letras
        if letras and no.tag in _BLOCOS and no.tag not in ("html", "body"):
            saida[id(no)] = int.from_bytes(d, "big", signed=True), letras
    return saida


def subarvores(pagina: str) -> tuple[int, set[tuple[int, bool, bool]]]:
    """Digest of the main text, and digests of the subtrees, whether they lie inside an article, whether they are long."""
    raiz = arvore(pagina)
    por_no = _resumos(raiz)
    achados = set()
    for no, dentro in _itera(raiz):
        if id(no) in por_no:
            d, letras = por_no[id(no)]
            longo = letras >= MIN_LETRAS
            if longo or not dentro and no.tag not in _DE_TEXTO:
                achados.add((d, dentro, longo))
    t = hashlib.blake2b(_texto(raiz, {}, _SEM_MODELOS).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(t, "big", signed=True), achados


def _principal(no: No) -> bool:
    if no.tag == "main" or "main" not in no.atributos.lower():
        return no.tag == "main"
    return any(n.lower() == "role" and (a or b or c).strip().lower() == "main" for n, a, b, c in _ATRIBUTO.findall(no.atributos))


def _guardados(raiz: No) -> set[int]:
    """Identities of the elements that are or hold a ``main`` or an outermost ``article``: no name deletes them."""
    saida: set[int] = set()
    for no, dentro in reversed(list(_itera(raiz))):  # children before parents
        if no.tag == "article" and not dentro or _principal(no) or any(id(f) in saida for f in no.filhos):
            saida.add(id(no))
    return saida


def _anuncio(no: No) -> bool:
    """An article without a heading whose class or id begins with a name of boilerplate, as adverts and comments have."""
    nomeado = any(n.lower() in ("class", "id") and _NOMES_PRIMEIROS.search(a or b or c) for n, a, b, c in _ATRIBUTO.findall(no.atributos))
    return nomeado and not any(f.tag in _TITULOS for f, _ in _itera(no))


def _de_fora(no: No, dentro: bool, guardado: bool, inteiros: bool) -> bool:
    """Whether tag, role, class or id name no part of an article; with ``inteiros`` only whole classes and ids count."""
    if no.tag in _FORA and not (guardado and no.tag == "form") or no.tag == "header" and not dentro:
        return True
    if no.tag == "article" and not dentro and _anuncio(no):
        return True
    if not no.atributos or no.tag in ("html", "body", "main"):
        return False
    nomes = _NOMES_INTEIROS if inteiros else _NOMES
    for nome, a, b, c in _ATRIBUTO.findall(no.atributos):
        nome, valor = nome.lower(), a or b or c
        if nome in ("class", "id") and not guardado and no.tag not in _TITULOS and nomes.search(valor):
            return True
        if nome == "role" and valor.lower() in _PAPEIS and not (guardado and valor.lower() == "form") or nome == "hidden":
            return True
        if nome == "aria-hidden" and valor.lower() == "true":
            return True
        if nome == "style" and re.search(r"display\s*:\s*none", valor, re.IGNORECASE):
            return True
    return False


def texto_principal(pagina: str | None, modelos: _Modelos = _SEM_MODELOS) -> str:
    """Text of the article of a page. ``modelos`` are digests of subtrees to delete outside articles and inside."""
    if not pagina:
        return ""
    raiz = arvore(pagina)
    return _texto(raiz, _resumos(raiz) if any(modelos) else {}, modelos)


def _texto(raiz: No, por_no: dict[int, tuple[int, int]], modelos: _Modelos) -> str:
    # names of wrappers that leave nothing of a page are no boilerplate
    return _texto_de(raiz, por_no, modelos, False) or _texto_de(raiz, por_no, modelos, True)


def _texto_de(raiz: No, por_no: dict[int, tuple[int, int]], modelos: _Modelos, inteiros: bool) -> str:
    guardados = _guardados(raiz)

    def fica(no: No, dentro: bool) -> bool:
        d = por_no[id(no)][0] if id(no) in por_no else None
        if d is not None and d in modelos[dentro]:
            return False
        # inside an article a part of a name counts for what recurs on the host
        so_inteiros = (inteiros or dentro) and not (d is not None and d in modelos[not dentro])
        return not _de_fora(no, dentro, id(no) in guardados, so_inteiros)

    # outermost articles that stay, else main, else body, else everything
    artigos, mains, corpos = [], [], []
    pilha = [raiz]
    while pilha:
        no = pilha.pop()
        if no is not raiz and not fica(no, False):
            continue
        if no.tag == "article":
            artigos.append(no)
            continue
        if _principal(no):
            mains.append(no)
        elif no.tag == "body":
            corpos.append(no)
        pilha += [f for f in reversed(no.filhos) if not isinstance(f, str)]
    raizes = artigos or mains[:1] or corpos[:1] or [raiz]

    partes: list[str] = []
    for r in raizes:
        partes.append("\0")
        passos: list = [(r, r.tag == "article", False)]
        while passos:
            passo = passos.pop()
            if isinstance(passo, str):
                partes.append(passo)
                continue
            no, dentro, so_titulos = passo
            if no is not r and not fica(no, dentro):
                continue
            if no.tag == "br":
                partes.append(" ")
                continue
            so_titulos = (so_titulos or no.tag == "header") and no.tag not in _TITULOS
            bloco = no.tag in _BLOCOS
            if bloco:
                partes.append("\0")
                passos.append("\0")
            for f in reversed(no.filhos):
                if not isinstance(f, str):
                    passos.append((f, dentro or no.tag == "article", so_titulos))
                elif not so_titulos:
                    passos.append(html.unescape(f).replace("\0", " "))
        partes.append("\0")
    blocos = (" ".join(b.split()) for b in "".join(partes).split("\0"))
    return "\n\n".join(b for b in blocos if b)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _com_host(paginas: DataFrame, url: str, pagina: str) -> DataFrame:
    return paginas.select(_host(F.col(url)).alias("host"), F.col(pagina).cast("string").alias("p")).filter("host <> ''")


def _subarvores(com_host: DataFrame, chave: bool = False) -> DataFrame:
    """Distinct subtrees of the pages of a host: pages told apart by main text, or with ``chave`` by the hash of the page."""

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            hosts, textos, nos, dentros, longos = [], [], [], [], []
            chaves = lote.column(2).to_pylist() if chave else None
            for i, (h, p) in enumerate(zip(lote.column(0).to_pylist(), lote.column(1))):
                texto, achados = subarvores(p.as_py() or "")
                hosts += [h] * len(achados)
                textos += [chaves[i] if chave else texto] * len(achados)
                for d, dentro, longo in achados:
                    nos.append(d)
                    dentros.append(dentro)
                    longos.append(longo)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(textos, pa.int64()),
                    pa.array(nos, pa.int64()),
                    pa.array(dentros, pa.bool_()),
                    pa.array(longos, pa.bool_()),
                ],
                names=["host", "pagina", "no", "dentro", "longo"],
            )

    if chave:
        com_host = com_host.select("host", "p", F.xxhash64("p").alias("chave"))
    return com_host.mapInArrow(tarefa, "host string, pagina bigint, no bigint, dentro boolean, longo boolean").distinct()


def modelos(paginas: DataFrame, url: str = "url", pagina: str = "html") -> DataFrame:
    """Templates of the hosts: columns host, no (digest), dentro (inside articles)."""
    # once per host, main text and subtree, then once per host and subtree: a host of any size spreads over its pages
    achados = materializa(_subarvores(_com_host(paginas, url, pagina)))
    totais = achados.select("host", "pagina").distinct().groupBy("host").agg(F.count("*").alias("paginas"))
    contas = achados.groupBy("host", "no", "dentro", "longo").agg(F.count("*").alias("n"))

    def limite(fora_e_dentro: tuple) -> Column:
        return F.when(F.col("dentro"), fora_e_dentro[1]).otherwise(fora_e_dentro[0])

    muitas = F.col("longo") & (F.col("n") >= limite(MUITAS_PAGINAS))
    return (
        contas.filter(F.col("n") >= limite(MIN_PAGINAS))
        .join(totais, "host")
        .filter(muitas | (F.col("n") >= limite(PARTE_DAS_PAGINAS) * F.col("paginas")))
        .select("host", "no", "dentro")
    )


def extrai(paginas: DataFrame, url: str = "url", pagina: str = "html") -> DataFrame:
    """Add text and n_chars (code points) to every page. Columns of these names are replaced."""
    todos = materializa(modelos(paginas, url, pagina))
    colunas = [c for c in paginas.columns if c not in ("text", "n_chars")]
    onde = len(colunas)
    campos = [pa.field("text", pa.string()), pa.field("n_chars", pa.int64())]
    com_host = paginas.withColumn("__host", _host(F.col(url))).withColumn("__pagina", F.col(pagina).cast("string"))
    poucos = todos.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    if poucos:
        por_host: dict[str, tuple[set[int], set[int]]] = {}
        for host, no, dentro in todos.collect():
            por_host.setdefault(host, (set(), set()))[dentro].add(no)
        b = paginas.sparkSession.sparkContext.broadcast({h: (frozenset(f), frozenset(d)) for h, (f, d) in por_host.items()})
        linhas = com_host.select(*colunas, "__pagina", "__host")
    else:  # every page meets the templates among its own subtrees
        b = None
        por_pagina = (
            _subarvores(_com_host(paginas, url, pagina), chave=True)
            .join(todos, ["host", "no", "dentro"], "left_semi")
            .groupBy(F.col("host").alias("__host"), F.col("pagina").alias("__chave"))
            .agg(
                F.collect_list(F.when(~F.col("dentro"), F.col("no"))).alias("__fora"),
                F.collect_list(F.when(F.col("dentro"), F.col("no"))).alias("__dentro"),
            )
        )
        linhas = (
            com_host.withColumn("__chave", F.xxhash64("__pagina"))
            .join(por_pagina, ["__host", "__chave"], "left")
            .select(*colunas, "__pagina", "__fora", "__dentro")
        )

    def tarefa(lotes: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lote in lotes:
            if poucos:
                dos_hosts = b.value
                ms = [dos_hosts.get(h, _SEM_MODELOS) for h in lote.column(onde + 1).to_pylist()]
            else:
                ms = ((frozenset(f.as_py() or ()), frozenset(d.as_py() or ())) for f, d in zip(lote.column(onde + 1), lote.column(onde + 2)))
            textos = [texto_principal(p.as_py(), m) for p, m in zip(lote.column(onde), ms)]
            yield pa.RecordBatch.from_arrays(
                [lote.column(i) for i in range(onde)] + [pa.array(textos, pa.string()), pa.array([len(t) for t in textos], pa.int64())],
                schema=pa.schema([lote.schema.field(i) for i in range(onde)] + campos),
            )

    esquema = T.StructType(
        [paginas.schema[c] for c in colunas] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return linhas.mapInArrow(tarefa, esquema)


def op10_paginas(paginas: DataFrame) -> DataFrame:
    return extrai(paginas.select("page_id", "url", F.col("html").alias("__html")), pagina="__html").drop("__html")

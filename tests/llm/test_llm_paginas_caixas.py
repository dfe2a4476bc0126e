"""Page text and packing: hand-made pages, brute force, invariants; the pipeline against plain Python stages."""

import html
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fasor.llm import empacotamento, idioma, paginas
from fasor.llm.comum import le, leva_codigo, materializa
from test_llm_textos import contaminacao_simples, jaccard_simples, palavras_simples


@pytest.fixture(autouse=True)
def codigo(spark):
    leva_codigo(spark)


def test_article_text():
    p = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><p>Topo</p></header><nav><ul><li>menu</ul></nav><div class="cookie-notice">Aceite</div>
    <article><header><h1>Um &amp; dois</h1><p>por mim</p></header><p>Primeiro <b>bloco<br>aqui&nbsp;&eacute;</b>
    segue<p>Segundo</p><ul><li>x<li>y</ul><script>var a="</p>";</script><!-- <p>não</p> -->
    <aside>lado</aside><div class="ad">compre</div><form><p>nome</p></form><table><tr><td>c1<td>c2</table>
    <section id="comments"><p>eu acho</p></section><p hidden>oculto</p></article>
    <div class="sidebar"><p>mais lidas</p></div><footer>&copy;</footer></body></html>"""
    assert paginas.texto_principal(p) == "Um & dois\n\nPrimeiro bloco aqui é segue\n\nSegundo\n\nx\n\ny\n\nc1\n\nc2"


@pytest.mark.parametrize(
    "pagina, texto",
    [
        (None, ""),
        ("", ""),
        ("só texto &lt;aqui", "só texto <aqui"),
        ("<p>a<p>b", "a\n\nb"),
        ("<main><p>m</p></main><p>fora</p>", "m"),
        ("<article>um</article><div><article><p>dois</article></div>", "um\n\ndois"),
        ("<article><p>a</b></p></div>b</article>", "a\n\nb"),
        ("<article><p title='x > y'>a < b &#233;&#x41;</p><![CDATA[c<d]]></article>", "a < b éA\n\nc<d"),
        ("<article><p>a</p><script>if (1</2) {</script", "a"),
        ("<article class='h-entry header-image'><p>sem dono</p></article>", ""),
        ("<article>" + "<div>" * 5000 + "fundo" + "</div>" * 5000 + "</article>", "fundo"),
        ("<body><p>" + "x " * 100_000 + "</p></body>", ("x " * 100_000).strip()),
    ],
)
def test_odd_pages(pagina, texto):
    assert paginas.texto_principal(pagina) == texto


def test_pages_of_the_table(spark):
    def simples(h):
        artigo = re.search(r"<article>(.*?)</article>", h, re.S).group(1)
        blocos = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m.group() == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", artigo)]
        return "\n\n".join(b for b in blocos if b)

    tabela = le(spark, "/root/testdata/sf0.1", "pages")
    esperado = {x.page_id: (x.url, simples(x.html), len(simples(x.html))) for x in tabela.collect()}
    r = paginas.op10_paginas(tabela).collect()
    assert {x.page_id: (x.url, x.text, x.n_chars) for x in r} == esperado and len(r) == len(esperado)


def test_site_template_goes_and_copies_stay(spark):
    g = random.Random(1)
    prosa = lambda: " ".join("".join(g.choices("abcdef", k=5)) for _ in range(12))
    copia = f"<p>{prosa()}</p>"
    linhas = []
    for i in range(40):
        corpo = copia if i < 20 else f"<p>{prosa()}</p>"
        titulo = "Mesmo" if i < 20 else f"T{i}"
        linhas.append((i, "http://a.example/x", f"<title>{titulo}</title><body><div><p>Assine já a nossa lista de tudo que sai</p></div><div>{corpo}</div></body>"))
        linhas.append((100 + i, f"http://h{i}.example/x", f"<title>{titulo}</title><body><div>Assine já</div><div>{corpo}</div></body>"))
    linhas += [(200, None, "<p>sem host</p>"), (201, "http://a.example", None), (201, "http://a.example", None)]
    d = spark.createDataFrame([(*x, "clash") for x in linhas], "page_id bigint, url string, html string, text string")
    r = {x.page_id: x.text for x in paginas.extrai(d).collect()}
    assert all(r[i] == re.search(r"<div><p>([^<]*)</p></div></body>", h).group(1) for i, _, h in linhas[:80:2])
    assert all(r[100 + i].startswith("Assine já\n\n") for i in range(40))  # one page is no template
    assert r[200] == "sem host" and r[201] == ""
    assert paginas.op10_paginas(d.limit(0)).count() == 0
    artigos = [(i, "http://b.example", f"<title>T{i}</title><article><p>{prosa()}</p><p>Leia também as outras páginas do nosso site</p></article>") for i in range(20)]
    r = paginas.op10_paginas(spark.createDataFrame(artigos, "page_id bigint, url string, html string")).collect()
    assert all("Leia" not in x.text and x.n_chars > 50 for x in r)


def simples(itens, capacidade, por_fonte):
    caixas, saida = [], []
    for s, c, f in itens:
        cabe = [(b["r"], k) for k, b in enumerate(caixas) if b["r"] >= s and (c is None or c not in b["c"]) and b["f"][f] < por_fonte]
        k = min(cabe)[1] if cabe else len(caixas)
        if not cabe:
            caixas.append({"r": capacidade, "c": set(), "f": Counter()})
        b = caixas[k]
        saida.append((k, capacidade - b["r"]))
        b["r"] -= s
        b["f"][f] += 1
        if c is not None:
            b["c"].add(c)
    return saida


def test_best_fit_brute_force():
    g = random.Random(0)
    for _ in range(30):
        itens = [(g.randint(0, 100), g.choice([None, 1, 2, 3, 4, 4, 4, 4]), g.choice("ab")) for _ in range(300)]
        itens.sort(key=lambda x: (-x[0], str(x[1]), x[2]))
        assert empacotamento.empacota_grupo(itens, 100, 3) == simples(itens, 100, 3)


def conferida(linhas, docs, capacidade, por_fonte):
    """Every token once, no bin too full, no conflict."""
    tamanho = {i: (n, c, f) for i, n, c, f in docs}
    pecas, caixas = defaultdict(list), defaultdict(list)
    for x in linhas:
        pecas[x.doc_id].append((x.token_start, x.n_tokens))
        caixas[x.bin_id].append(x)
    assert set(pecas) == set(tamanho)
    for i, p in pecas.items():
        p.sort()
        assert [a for a, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) == max(tamanho[i][0] or 0, 0)
    for c in caixas.values():
        c.sort(key=lambda x: (x.bin_offset, x.n_tokens))
        assert [x.bin_offset for x in c] == [sum(y.n_tokens for y in c[:k]) for k in range(len(c))]
        assert sum(x.n_tokens for x in c) <= capacidade
        clusters = [tamanho[x.doc_id][1] for x in c if tamanho[x.doc_id][1] is not None]
        assert len(clusters) == len(set(clusters))
        assert max(Counter(tamanho[x.doc_id][2] for x in c).values()) <= por_fonte
    return len(caixas)


def test_packing(spark):
    g = random.Random(9)
    linhas = [(i, g.choice([0, 1, 5, 30, 64, 65, 300, None, -3]) if i % 9 == 0 else g.randint(1, 60), 7 if i % 3 == 0 else None, g.choice(["a", "a", "b", None])) for i in range(900)]
    d = spark.createDataFrame(linhas, "doc_id bigint, n bigint, c bigint, f string")
    r = empacotamento.empacota(d, F.col("n"), F.col("c"), F.col("f"), capacidade=64, por_fonte=8, por_grupo=250).collect()
    conferida(r, linhas, 64, 8)
    assert len({x.bin_id.split(":")[0] for x in r}) > 2
    assert empacotamento.empacota(d.limit(0), F.col("n"), F.col("c"), F.col("f")).count() == 0
    repetidas = spark.createDataFrame([(1, 5, None, None)] * 4, d.schema)
    assert empacotamento.empacota(repetidas, F.col("n"), F.col("c"), F.col("f")).count() == 4


def test_packing_of_the_table(spark):
    d = le(spark, "/root/testdata/sf0.01", "documents")
    linhas = [(x.doc_id, len(re.findall(r"[^ \t\n\x0b\f\r]+", x.text or "")), x.text.lower(), x.source) for x in d.collect()]
    r = empacotamento.op1_empacotamento(d).collect()
    caixas = conferida(r, linhas, empacotamento.CAPACIDADE, empacotamento.POR_FONTE)
    assert sum(x.n_tokens for x in r) / caixas / empacotamento.CAPACIDADE > 0.9


def test_pipeline_against_plain_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = le(spark, sf, "documents")
    extra = spark.createDataFrame([(-1, "123 ...", "en", "s", 7), (-2, None, "en", "s", 0), (-3, "", None, None, None)], docs.schema)
    d = materializa(corpus_pipeline.idiomas(spark, docs.unionByName(extra), sf))
    assert d.columns == docs.columns
    previsto = {x.doc_id: x for x in idioma.identifica(docs).collect()}
    atual = {x.doc_id: x.text for x in d.collect()}
    assert set(atual) == {i for i, x in previsto.items() if x.lang_pred != "und" and not (x.ambiguous and x.score < corpus_pipeline.SCORE_MINIMO)}
    assert len(atual) > 0.98 * docs.count()

    d = materializa(corpus_pipeline.copias(spark, d, sf))
    minusculas = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    maior = {t.translate(minusculas): i for i, t in sorted(atual.items())}
    atual = {i: atual[i] for i in maior.values()}
    assert {x.doc_id: x.text for x in d.collect()} == atual and d.columns == docs.columns

    d = materializa(corpus_pipeline.quase_copias(spark, d, sf))
    comp = jaccard_simples(list(atual.items()))
    atual = {i: t for i, t in atual.items() if comp[i][1] == i}
    assert {x.doc_id: x.text for x in d.collect()} == atual and d.columns == docs.columns

    d = materializa(corpus_pipeline.sem_benchmark(spark, d, sf))
    itens = [(x.item_id, x.text) for x in le(spark, sf, "benchmark").collect()]
    achados = {x[0]: x for x in contaminacao_simples(list(atual.items()), itens)}
    depois = {x.doc_id: x for x in d.collect()}
    assert set(depois) == {i for i, x in achados.items() if x[2] <= 0.5 * x[1]} and d.columns == docs.columns
    for i, x in depois.items():
        assert len(palavras_simples(x.text)) == achados[i][1] - achados[i][2]
        assert x.n_chars == len(x.text) if achados[i][2] else x.text == atual[i]

    r = corpus_pipeline.empacotados(spark, d, sf).collect()
    conferida(r, [(x.doc_id, len(re.findall(r"[^ \t\n\x0b\f\r]+", x.text)), x.text.lower(), x.source) for x in depois.values()], 8192, 8)


def test_run_gives_the_last_stage(spark):
    linhas = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert linhas.columns == ["doc_id", "piece", "token_start", "n_tokens", "bin_id", "bin_offset"] and linhas.count() > 100
    assert len(corpus_pipeline.STAGES) == 5

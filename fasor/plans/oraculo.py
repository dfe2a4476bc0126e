"""The same queries in SQL over the same Parquet tables, written independently of the operators."""

from __future__ import annotations

# ---- input mappings (see plans.entradas) ---------------------------------------------------


def _codigo(chave: str) -> str:
    return (
        f"(CASE WHEN ({chave}) % 2 = 0 THEN 'TR-' ELSE 'F' END"
        f" || lpad(CAST(({chave}) AS VARCHAR), 9, '0'))"
    )


def _tabela(chave: str, marca: str) -> str:
    return f"('regiao_' || lpad(CAST({chave} // 25 AS VARCHAR), 9, '0') || '_' || lower({marca}))"


def _ordem(chave: str, marca: str) -> str:
    return (
        f"CAST(({chave} // 25) * 3 + CASE {marca} WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"
        " AS INTEGER)"
    )


def _numero(texto: str) -> str:
    t = f"trim(replace({texto}, ',', '.'))"
    padrao = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return (
        f"coalesce(CASE WHEN regexp_full_match({t}, '{padrao}')"
        f" THEN TRY_CAST({t} AS DOUBLE) END, CAST(0 AS DOUBLE))"
    )


def _norma(nome: str) -> str:
    return (
        f"regexp_replace(translate(lower(trim({nome})), 'áàãâéêíóôõúçº', 'aaaaeeiooouco'),"
        " '[^a-zA-Z0-9]', '', 'g')"
    )


def _r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


INSTANTE_LINEITEM = (
    "(date_trunc('year', l_shipdate) + INTERVAL 1 HOUR * ((l_partkey % 48) * 181)"
    " + INTERVAL 1 MINUTE * (l_linenumber * 7))"
)

CTE: dict[str, str] = {}

CTE["horario"] = f"""
SELECT l_suppkey AS equip, {_codigo('l_suppkey')} AS codigo,
       {_tabela('l_suppkey', 'l_returnflag')} AS tabela,
       {_ordem('l_suppkey', 'l_returnflag')} AS tabela_ordem,
       date_trunc('hour', {INSTANTE_LINEITEM}) AS data_hora,
       sum(floor(l_extendedprice / 100)) AS eae, sum(l_quantity * 10) AS ear,
       sum(floor(l_extendedprice * l_discount / 10)) AS ere,
       sum(CASE WHEN l_tax <> 0 THEN floor(l_extendedprice * l_tax / 10) END) AS err
FROM lineitem GROUP BY ALL"""

CTE["equipamentos"] = f"""
SELECT s_suppkey * 2 + vez AS id,
       CASE WHEN vez = 0 OR s_suppkey % 14 <> 7 THEN {_codigo('s_suppkey')} END AS codigo,
       CASE WHEN s_suppkey % 10 <> 8
            THEN floor(abs(s_acctbal) / CASE WHEN vez = 0 THEN 10 ELSE 5 END) END AS potencia_instalada
FROM (SELECT s_suppkey, s_acctbal,
             unnest(CASE WHEN s_suppkey % 7 = 0 THEN [0, 1] ELSE [0] END) AS vez FROM supplier)"""

CTE["medidores"] = f"""
SELECT {_codigo('s_suppkey')} || '-' || sufixo AS codigo,
       'SE ' || {_codigo('s_suppkey')} || '-' || sufixo AS descricao
FROM supplier CROSS JOIN (VALUES ('EAE'), ('EAR'), ('ERE'), ('ERR')) v(sufixo)
WHERE NOT (sufixo = 'ERR' AND s_suppkey % 10 = 9)"""

CTE["catalogo"] = f"""
SELECT tabela, tabela_ordem, pos, CASE WHEN minuscula THEN lower(nome) ELSE nome END AS descricao
FROM (SELECT {_tabela('s_suppkey', 'marca')} AS tabela, {_ordem('s_suppkey', 'marca')} AS tabela_ordem,
             CAST(s_suppkey % 25 * 4 + lugar AS INTEGER) AS pos,
             'SE ' || {_codigo('s_suppkey')} || '-' || sufixo AS nome,
             marca = 'A' AND s_suppkey % 10 = 6 AS minuscula
      FROM supplier CROSS JOIN (VALUES ('A'), ('N'), ('R')) m(marca)
           CROSS JOIN (VALUES (0, 'EAE'), (1, 'EAR'), (2, 'ERE'), (3, 'ERR')) v(lugar, sufixo)
      WHERE s_suppkey % 20 <> 11 AND NOT (marca = 'N' AND sufixo = 'ERR' AND s_suppkey % 10 = 4))"""

CTE["resolvidos"] = """
SELECT c.codigo, max(CASE WHEN sufixo = 'EAE' THEN descricao END) AS eae,
       max(CASE WHEN sufixo = 'EAR' THEN descricao END) AS ear,
       max(CASE WHEN sufixo = 'ERE' THEN descricao END) AS ere,
       max(CASE WHEN sufixo = 'ERR' THEN descricao END) AS err
FROM (SELECT DISTINCT codigo FROM equipamentos WHERE codigo IS NOT NULL) c
     CROSS JOIN (VALUES ('EAE'), ('EAR'), ('ERE'), ('ERR')) v(sufixo)
     LEFT JOIN medidores m ON m.codigo = c.codigo || '-' || sufixo
GROUP BY c.codigo"""

# an equipment serves a table when all four of its columns are there
CTE["elegiveis"] = """
SELECT codigo, tabela, tabela_ordem, CAST(min(exato) AS INTEGER) AS exato
FROM (SELECT r.codigo, c.tabela, c.tabela_ordem,
             CASE WHEN c.descricao = r.descricao THEN 1 ELSE 0 END AS exato
      FROM (SELECT codigo, unnest([eae, ear, ere, err]) AS descricao FROM resolvidos
            WHERE eae IS NOT NULL AND ear IS NOT NULL AND ere IS NOT NULL AND err IS NOT NULL) r
           JOIN catalogo c ON lower(c.descricao) = lower(r.descricao))
GROUP BY codigo, tabela, tabela_ordem HAVING count(*) = 4"""

# every row of a table counts for each of its equipments, with or without values
CTE["base"] = """
SELECT g.codigo, h.data_hora, g.tabela AS tabela_origem, g.tabela_ordem, g.exato,
       v.eae, v.ear, v.ere, v.err
FROM elegiveis g
     JOIN (SELECT DISTINCT tabela, data_hora FROM horario) h ON h.tabela = g.tabela
     LEFT JOIN horario v
       ON v.codigo = g.codigo AND v.tabela = g.tabela AND v.data_hora = h.data_hora"""

CTE["potencias"] = """
SELECT codigo, potencia_instalada FROM equipamentos WHERE codigo IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY codigo ORDER BY id) = 1"""

CTE["demanda"] = """
SELECT u.*, sqrt(p * p + q * q) AS s, potencia_instalada,
       CAST(coalesce(CASE WHEN potencia_instalada = 0 THEN sqrt(p * p + q * q) > 0
                          ELSE sqrt(p * p + q * q) / potencia_instalada >= 1.0 END, false) AS INTEGER)
         AS ultrapassagem
FROM (SELECT codigo, data_hora, tabela_origem AS tabela, tabela_ordem, eae, ear, ere, err, eae - ear AS p,
             ere - err AS q
      FROM base
      QUALIFY row_number() OVER (PARTITION BY codigo, data_hora ORDER BY tabela_ordem) = 1) u
     JOIN potencias USING (codigo)
WHERE potencia_instalada IS NOT NULL"""

CTE["est"] = f"""
SELECT codigo, max(potencia_instalada) AS potencia_instalada, max(p) AS max_p, min(p) AS min_p,
       {_r2('max(s)')} AS max_s, round_even(avg(p), 0) AS media_p, round_even(avg(q), 0) AS media_q,
       avg(s) AS media_s,
       CAST(min(CASE WHEN p <> 0 THEN trunc(p) END) AS BIGINT) AS min_p_sem_zero,
       coalesce(CAST(trunc(stddev_samp(CASE WHEN p <> 0 THEN trunc(p) END)) AS BIGINT), 0) AS desvio_p,
       CAST(sum(ultrapassagem) AS BIGINT) AS horas_ultrapassagem
FROM demanda GROUP BY codigo"""

CTE["filtrado"] = """
SELECT e.codigo, max(CASE WHEN d.p < e.media_p + 3 * e.desvio_p THEN d.p END) AS max_p_filtrado
FROM est e JOIN demanda d USING (codigo) GROUP BY e.codigo"""

CTE["limites"] = f"""
SELECT *, sqrt(max_p_robusto * max_p_robusto + media_q * media_q) AS s_pico,
       CASE WHEN potencia_instalada <> 0
            THEN sqrt(max_p_robusto * max_p_robusto + media_q * media_q) / potencia_instalada * 100
       END AS carregamento_pct
FROM (SELECT *, CASE WHEN max_p_filtrado = 0 THEN CASE WHEN max_p > 0 THEN max_p_filtrado ELSE max_p END
                     WHEN max_p / max_p_filtrado > 1.10 THEN max_p_filtrado ELSE max_p END AS max_p_robusto,
             greatest(min_p, limite_inferior) AS min_p_robusto
      FROM (SELECT *, round_even(media_p - 3.0 * desvio_p, 0) AS limite_inferior,
                   CASE WHEN media_s <> 0 THEN {_r2('media_p / media_s')} END AS fp_global
            FROM est JOIN filtrado USING (codigo)))"""

CTE["extremos"] = """
SELECT l.codigo, mx.data_hora AS instante_maximo, mx.q AS q_no_maximo,
       mn.data_hora AS instante_minimo, mn.q AS q_no_minimo
FROM limites l
     LEFT JOIN (SELECT d.codigo, d.data_hora, d.q FROM demanda d JOIN limites USING (codigo)
                WHERE d.p = max_p_robusto
                QUALIFY row_number() OVER (PARTITION BY d.codigo ORDER BY tabela_ordem, data_hora) = 1) mx
       ON mx.codigo = l.codigo
     LEFT JOIN (SELECT d.codigo, d.data_hora, d.q FROM demanda d JOIN limites USING (codigo)
                WHERE d.p = min_p
                QUALIFY row_number() OVER (PARTITION BY d.codigo ORDER BY tabela_ordem, data_hora) = 1) mn
       ON mn.codigo = l.codigo"""

CTE["pontas"] = """
SELECT codigo, arg_min(data_hora, ROW(tabela_ordem, data_hora)) AS t0,
       arg_max(data_hora, ROW(tabela_ordem, data_hora)) AS t1
FROM demanda GROUP BY codigo"""

CTE["leituras"] = f"""
SELECT {_codigo('user_id')} AS codigo,
       CASE event_type WHEN 'signup' THEN 'EAE' WHEN 'purchase' THEN 'EAR' WHEN 'click' THEN 'ERE'
                       WHEN 'error' THEN 'ERR' END AS canal,
       CAST(event_id % 3 AS INTEGER) AS tabela,
       date_trunc('week', ts) + INTERVAL 1 HOUR * (hour(ts) % 2) AS data_hora,
       floor(value / 10) AS valor
FROM events"""

CTE["em_linha"] = """
SELECT codigo, tabela, data_hora, sum(CASE WHEN canal = 'EAE' THEN valor END) AS eae,
       sum(CASE WHEN canal = 'EAR' THEN valor END) AS ear,
       sum(CASE WHEN canal = 'ERE' THEN valor END) AS ere,
       sum(CASE WHEN canal = 'ERR' THEN valor END) AS err
FROM (SELECT DISTINCT * FROM leituras) WHERE canal IS NOT NULL GROUP BY codigo, tabela, data_hora"""

CTE["mudancas"] = f"""
SELECT c_custkey // 2 AS id, c_custkey AS ordem,
       CASE c_custkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'D' ELSE 'X' END AS op,
       {_codigo('c_custkey')} || 'N' AS codigo, c_custkey % 13 = 11 AS ilegivel,
       CASE WHEN c_custkey % 11 = 3 THEN NULL ELSE floor(abs(c_acctbal)) END AS potencia_instalada
FROM customer"""

CTE["edicoes"] = f"""
SELECT c_custkey // 7 AS id, c_custkey AS ordem,
       CASE (c_custkey * 5 + c_custkey // 7) % 4 WHEN 1 THEN 'D' WHEN 2 THEN 'I' ELSE 'U' END AS op,
       CASE WHEN c_custkey % 4 <> 1 THEN {_codigo('c_custkey')} || 'N' END AS codigo,
       CASE WHEN c_custkey % 13 = 11 THEN 'abc' WHEN c_custkey % 11 = 3 THEN ''
            WHEN c_custkey % 5 <> 2 THEN CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) END AS potencia
FROM customer"""

# one edit after the other; a row's state also says whether the last edit counted
CTE["dobradas"] = """
SELECT id, list_reduce([inicio] || edicoes, lambda s, e:
  CASE WHEN e.op = 'D' THEN {'op': 'D', 'vive': false, 'codigo': NULL, 'texto': NULL, 'potencia': NULL, 'ruins': NULL}
       WHEN e.op = 'I' AND s.vive OR e.op = 'U' AND NOT s.vive THEN s
       WHEN e.op = 'I' THEN {'op': 'I', 'vive': true, 'codigo': e.codigo, 'texto': NULL, 'potencia': TRY_CAST(e.texto AS DOUBLE),
            'ruins': CASE WHEN e.texto = 'abc' THEN e.ruins ELSE ''::VARCHAR END}
       ELSE {'op': 'U', 'vive': true, 'codigo': coalesce(e.codigo, s.codigo), 'texto': NULL,
             'potencia': CASE WHEN e.texto = '' THEN NULL ELSE coalesce(TRY_CAST(e.texto AS DOUBLE), s.potencia) END,
             'ruins': s.ruins || CASE WHEN e.texto = 'abc' THEN e.ruins ELSE '' END} END) AS fim
FROM (SELECT coalesce(q.id, x.id) AS id,
             {'op': '', 'vive': q.id IS NOT NULL, 'codigo': q.codigo, 'texto': NULL::VARCHAR,
              'potencia': q.potencia_instalada::DOUBLE, 'ruins': ''::VARCHAR} AS inicio,
             coalesce(x.edicoes, []) AS edicoes
      FROM equipamentos q FULL JOIN
           (SELECT id, list({'op': op, 'vive': false, 'codigo': codigo, 'texto': potencia, 'potencia': NULL::DOUBLE,
                             'ruins': ordem || ','} ORDER BY ordem) AS edicoes FROM edicoes GROUP BY id) x ON x.id = q.id)"""

CTE["dois_formatos"] = """
SELECT arquivo, nr_linha, t, try_strptime(t, '%d/%m/%Y %H:%M') AS a, try_strptime(t, '%m/%d/%Y %H:%M') AS b
FROM (SELECT arquivo, nr_linha, CASE WHEN arquivo LIKE '%F.txt' THEN regexp_replace(c[1], '^(\\d\\d)/(\\d\\d)/', '\\2/\\1/')
                                     ELSE c[1] END AS t FROM partes WHERE valido)"""

CTE["formatos"] = """
SELECT arquivo, CASE WHEN na >= nb THEN 0 ELSE 1 END AS formato, greatest(na, nb) AS lidas, na = nb AND diferem > 0 AS ambiguo
FROM (SELECT arquivo, count(a) AS na, count(b) AS nb, count(*) FILTER (a <> b) AS diferem FROM dois_formatos GROUP BY arquivo)"""

CTE["atualizacoes"] = """
SELECT * FROM mudancas WHERE op = 'U' QUALIFY row_number() OVER (PARTITION BY id ORDER BY ordem DESC) = 1"""

CTE["corpo"] = f"""
SELECT 'Medicao (Regiao ' || CAST(l_suppkey // 25 AS VARCHAR) || '-' || l_returnflag || ') '
         || l_linestatus || '.txt' AS arquivo,
       l_orderkey * 10 + l_linenumber + 1 AS nr_linha,
       CASE WHEN l_linenumber = 5 AND l_partkey % 7 = 0 THEN 'TOTAL'
            WHEN l_linenumber = 6 AND l_partkey % 11 = 0 THEN 'sem data'
            WHEN l_linenumber = 6 AND l_partkey % 11 = 1 THEN '31/02/1997 10:00'
            ELSE strftime({INSTANTE_LINEITEM}, '%d/%m/%Y %H:%M') END || ';'
       || CAST(CAST(floor(l_extendedprice / 10000) AS BIGINT) AS VARCHAR) || ','
       || lpad(CAST(l_partkey % 4 * 25 AS VARCHAR), 2, '0') || ';'
       || CASE WHEN l_tax = 0 THEN '' WHEN l_linenumber = 7 THEN ' ' WHEN l_linenumber = 6 THEN '-'
               WHEN l_linenumber = 4 THEN '1.234,56'
               ELSE CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) END || ';'
       || CAST(CAST(floor(l_discount * 25) AS BIGINT) AS VARCHAR) || 'e-1'
       || CASE WHEN l_linenumber = 7 THEN ''
               ELSE ';' || CAST(CAST(floor(l_quantity / 25) AS BIGINT) AS VARCHAR) || ',5' END
       || CASE WHEN l_linenumber = 3 THEN ';x' ELSE '' END AS linha
FROM lineitem"""

CTE["partes"] = """
SELECT arquivo, nr_linha, linha, string_split(linha, ';') AS c,
       arquivo NOT LIKE '%-N) O.txt' AS valido,
       replace(replace(lower(regexp_extract(arquivo, '\\(([^)]+)\\)', 1)), ' ', '_'), '-', '_') AS tabela
FROM corpo"""

CTE["lidas"] = """
SELECT *, c[1] AS texto_tempo, try_strptime(c[1], '%d/%m/%Y %H:%M') AS instante
FROM partes WHERE valido AND c[1] <> 'TOTAL'"""

# the O files repeat a column name exactly, so their second and third fields are one channel
CTE["unicas"] = f"""
SELECT DISTINCT arquivo, tabela, date_trunc('hour', instante) AS data_hora, {_numero('c[2]')} AS v0,
       {_numero('c[3]')} AS v1,
       CASE WHEN arquivo LIKE '%O.txt' THEN {_numero('c[5]')} ELSE {_numero('c[4]')} END AS v2,
       CASE WHEN arquivo LIKE '%O.txt' THEN NULL ELSE {_numero('c[5]')} END AS v3
FROM lidas WHERE instante IS NOT NULL"""

CTE["horas"] = f"""
SELECT arquivo, tabela, data_hora, arquivo LIKE '%O.txt' AS e_o, {_r2('sum(v0)')} AS v0,
       {_r2('sum(v1)')} AS v1, {_r2('sum(v2)')} AS v2, {_r2('sum(v3)')} AS v3
FROM unicas GROUP BY arquivo, tabela, data_hora"""

# both kinds of file occur for the A and R tables; the N tables have only F files that are valid
CTE["tabela_cols"] = """
SELECT DISTINCT tabela, descricao, k
FROM (SELECT DISTINCT tabela, arquivo LIKE '%O.txt' AS e_o FROM partes WHERE valido)
     JOIN (VALUES ('Linha São João-EAE', 0, false), ('Trafo 1-EAR', 1, false),
                  ('Trafo 1-ERE', 2, false), ('Trafo 2-ERR', 3, true)) n(descricao, k, e_o) USING (e_o)"""

CTE["maximas"] = f"""
SELECT o_custkey, {_codigo('o_custkey')} AS codigo, month(o_orderdate) AS m,
       max(floor(o_totalprice / 1000)) AS valor
FROM orders GROUP BY ALL"""

CTE["cab"] = """
SELECT 'Export (' || p_type || ') ' || lpad(CAST(p_partkey // 100 AS VARCHAR), 9, '0') || '.txt' AS arquivo,
       lower(p_type) AS tabela, p_partkey // 100 AS lote,
       row_number() OVER (PARTITION BY p_type, p_partkey // 100 ORDER BY p_partkey) AS pos,
       CASE p_size % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, 'a', 'á')
                       WHEN 2 THEN replace(p_name, ' ', '-') || ' ' ELSE p_name END
       || CASE WHEN p_size % 5 = 0 THEN ' 2º' ELSE '' END AS coluna
FROM part"""

CTE["cab_norma"] = f"""
SELECT *, {_norma('coluna')} AS descricao_norm,
       dense_rank() OVER (PARTITION BY arquivo ORDER BY primeira) - 1 AS indice
FROM (SELECT *, min(pos) OVER (PARTITION BY arquivo, coluna) AS primeira FROM cab)"""

CTE["entregues"] = """
SELECT arquivo, replace(replace(tabela, ' ', '_'), '-', '_') AS tabela, lote, pos, CAST(indice AS INTEGER) AS indice,
       coluna AS descricao, descricao_norm
FROM cab_norma
QUALIFY row_number() OVER (PARTITION BY arquivo, descricao_norm ORDER BY pos) = 1"""

CTE["formulas"] = f"""
SELECT s_suppkey // 3 AS formula, CAST(s_suppkey % 3 + 1 AS INTEGER) AS ordem,
       {_codigo('s_suppkey')} AS codigo,
       CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sinal
FROM supplier"""

# channel columns each equipment has in each table; 0 where there is none
CTE["lugares"] = """
SELECT r.codigo, c.tabela, c.tabela_ordem,
       max(CASE WHEN canal = 'EAE' THEN 1 ELSE 0 END) AS tem_eae,
       max(CASE WHEN canal = 'EAR' THEN 1 ELSE 0 END) AS tem_ear,
       max(CASE WHEN canal = 'ERE' THEN 1 ELSE 0 END) AS tem_ere,
       max(CASE WHEN canal = 'ERR' THEN 1 ELSE 0 END) AS tem_err
FROM (SELECT codigo, unnest([eae, ear, ere, err]) AS descricao,
             unnest(['EAE', 'EAR', 'ERE', 'ERR']) AS canal FROM resolvidos) r
     JOIN catalogo c ON lower(c.descricao) = lower(r.descricao)
GROUP BY r.codigo, c.tabela, c.tabela_ordem"""

CTE["parcelas"] = """
SELECT g.codigo, h.data_hora, CASE WHEN tem_eae = 1 THEN v.eae ELSE 0 END
         - CASE WHEN tem_ear = 1 THEN v.ear ELSE 0 END AS p,
       CASE WHEN tem_ere = 1 THEN v.ere ELSE 0 END - CASE WHEN tem_err = 1 THEN v.err ELSE 0 END AS q
FROM lugares g
     JOIN (SELECT DISTINCT tabela, data_hora FROM horario) h ON h.tabela = g.tabela
     LEFT JOIN horario v
       ON v.codigo = g.codigo AND v.tabela = g.tabela AND v.data_hora = h.data_hora
QUALIFY row_number() OVER (PARTITION BY g.codigo, h.data_hora ORDER BY g.tabela_ordem) = 1"""

# what each CTE reads
PRECISA = {
    "resolvidos": ["equipamentos", "medidores"],
    "elegiveis": ["resolvidos", "catalogo"],
    "base": ["elegiveis", "horario"],
    "potencias": ["equipamentos"],
    "demanda": ["base", "potencias"],
    "est": ["demanda"],
    "filtrado": ["est", "demanda"],
    "limites": ["est", "filtrado"],
    "extremos": ["limites", "demanda"],
    "pontas": ["demanda"],
    "em_linha": ["leituras"],
    "atualizacoes": ["mudancas"],
    "dobradas": ["equipamentos", "edicoes"],
    "dois_formatos": ["partes"],
    "formatos": ["dois_formatos"],
    "partes": ["corpo"],
    "lidas": ["partes"],
    "unicas": ["lidas"],
    "horas": ["unicas"],
    "tabela_cols": ["partes"],
    "cab_norma": ["cab"],
    "entregues": ["cab_norma"],
    "lugares": ["resolvidos", "catalogo"],
    "parcelas": ["lugares", "horario"],
}


def _com(consulta: str, *usa: str) -> str:
    """``consulta`` after the CTEs it uses, each once, inputs first."""
    ordem: list[str] = []

    def visita(nome: str) -> None:
        for antes in PRECISA.get(nome, []):
            visita(antes)
        if nome not in ordem:
            ordem.append(nome)

    for nome in usa:
        visita(nome)
    partes = ", ".join(f"{nome} AS MATERIALIZED ({CTE[nome]})" for nome in ordem)
    return f"WITH {partes} {consulta}" if partes else consulta


# ---- one statement per query ---------------------------------------------------------------

ANO = "data_hora >= TIMESTAMP '1997-01-01' AND data_hora < TIMESTAMP '1998-01-01'"
ANO_MES = "data_hora >= TIMESTAMP '1997-03-01' AND data_hora < TIMESTAMP '1997-04-01'"
INSTANTE = "TIMESTAMP '1997-01-08 13:00:00'"

SQL: dict[str, str] = {
    # scans, sources, sinks
    "parse_linhas": _com(
        "SELECT arquivo, nr_linha, CAST(len(c) AS BIGINT) AS n_campos, c[1] AS c0, c[2] AS c1, c[3] AS c2,"
        " c[4] AS c3, c[5] AS c4 FROM partes",
        "partes",
    ),
    "scan_todas_tabelas": _com(
        "SELECT tabela, data_hora, CAST(100 AS BIGINT) AS n_canais,"
        " CAST(count(eae) + count(ear) + count(ere) + count(err) AS BIGINT) AS n_valores,"
        " coalesce(sum(eae), 0) + coalesce(sum(ear), 0) + coalesce(sum(ere), 0) + coalesce(sum(err), 0)"
        " AS soma FROM horario GROUP BY tabela, data_hora",
        "horario",
    ),
    "listar_tabelas": _com("SELECT DISTINCT tabela FROM catalogo", "catalogo"),
    "listar_colunas": _com(
        "SELECT tabela, CAST(pos + 1 AS INTEGER) AS pos, descricao, 'REAL' AS tipo FROM catalogo"
        " UNION ALL SELECT DISTINCT tabela, CAST(0 AS INTEGER), 'Data_Hora', 'DATETIME' FROM catalogo",
        "catalogo",
    ),
    "cadastro_sem_nulos": _com("SELECT * FROM equipamentos WHERE codigo IS NOT NULL", "equipamentos"),
    "scan_cadastro": _com("SELECT * FROM equipamentos", "equipamentos"),
    "amostra_cadastro": _com("SELECT * FROM equipamentos ORDER BY id LIMIT 1", "equipamentos"),
    "export_curva": _com(
        'SELECT codigo, data_hora AS "Data_Hora", eae AS descricao, ear AS descricao_saida,'
        ' ere AS "descricao_Q", err AS "descricao_saida_Q", tabela AS tabela_origem, p AS "P", q AS "PQ"'
        f" FROM demanda WHERE {ANO_MES}",
        "demanda",
    ),
    # ingest cleaning
    "arquivos_validos": _com(
        "SELECT arquivo, count(*) AS linhas FROM partes WHERE valido GROUP BY arquivo", "partes"
    ),
    "filtra_total": _com("SELECT arquivo, nr_linha, texto_tempo FROM lidas", "lidas"),
    "parse_data_hora": _com("SELECT arquivo, nr_linha, texto_tempo, instante FROM lidas", "lidas"),
    "rejeitados": _com(
        "SELECT arquivo, nr_linha, texto_tempo, linha FROM lidas WHERE instante IS NULL", "lidas"
    ),
    "trunca_hora": (
        f"SELECT l_suppkey AS equip, floor(l_extendedprice / 100) AS eae, {INSTANTE_LINEITEM} AS instante,"
        f" date_trunc('hour', {INSTANTE_LINEITEM}) AS data_hora FROM lineitem"
    ),
    "parse_numero_br": _com(
        "SELECT arquivo, nr_linha, c[2] AS t1, c[3] AS t2, c[4] AS t3, c[5] AS t4,"
        f" {_numero('c[2]')} AS v1, {_numero('c[3]')} AS v2, {_numero('c[4]')} AS v3,"
        f" {_numero('c[5]')} AS v4 FROM partes",
        "partes",
    ),
    "dedup_leituras": _com("SELECT arquivo, data_hora, v0, v1, v2, v3 FROM unicas", "unicas"),
    "dedup_eventos": _com("SELECT DISTINCT * FROM leituras", "leituras"),
    "serie_ordenada": _com(
        "SELECT codigo, data_hora, p, q, s FROM demanda ORDER BY codigo, data_hora", "demanda"
    ),
    "agrega_hora": _com(
        "SELECT arquivo, data_hora, CAST(i AS INTEGER) AS indice, valor FROM ("
        "SELECT arquivo, data_hora, 0 AS i, v0 AS valor FROM horas UNION ALL"
        " SELECT arquivo, data_hora, 1, v1 FROM horas UNION ALL"
        " SELECT arquivo, data_hora, 2, v2 FROM horas UNION ALL"
        " SELECT arquivo, data_hora, 3, v3 FROM horas WHERE NOT e_o)",
        "horas",
    ),
    "arredonda_2": (
        f"SELECT l_orderkey, l_partkey, l_linenumber,"
        f" {_r2('l_extendedprice * (1 + l_tax) / 7')} AS arredondado FROM lineitem"
    ),
    "colunas_repetidas": _com(
        "SELECT arquivo, CAST(min(pos) AS INTEGER) AS pos, coluna FROM cab GROUP BY arquivo, coluna", "cab"
    ),
    "colunas_omitidas": _com(
        "SELECT arquivo, CAST(pos AS INTEGER) AS pos, coluna, motivo FROM (SELECT arquivo, pos, coluna,"
        " CASE WHEN pos <> primeira THEN 'nome_repetido' WHEN pos <> min(pos) OVER"
        " (PARTITION BY arquivo, descricao_norm) THEN 'nome_equivalente' END AS motivo FROM cab_norma)"
        " WHERE motivo IS NOT NULL",
        "cab_norma",
    ),
    "normaliza_colunas": _com(
        "SELECT arquivo, tabela, indice, descricao, descricao_norm FROM entregues", "entregues"
    ),
    "nome_tabela": _com(
        "SELECT membro, replace(replace(lower(CASE WHEN contains(membro, '(')"
        " THEN regexp_extract(membro, '\\(([^)]+)\\)', 1) ELSE regexp_replace(membro, '\\.[^.]*$', '') END),"
        " ' ', '_'), '-', '_') AS tabela"
        " FROM (SELECT arquivo AS membro FROM corpo UNION SELECT arquivo FROM cab"
        " UNION SELECT p_name || ' - 01.TXT.txt' FROM part)",
        "corpo",
        "cab",
    ),
    "auditoria_carga": _com(
        "SELECT arquivo, count(*) AS linhas, count(*) FILTER (valido AND c[1] = 'TOTAL') AS rodapes,"
        " count(*) FILTER (valido AND c[1] <> 'TOTAL' AND t IS NULL) AS rejeitadas,"
        " count(*) FILTER (valido AND len(c) > 5) AS linhas_com_campo_extra,"
        " count(DISTINCT CASE WHEN valido AND c[1] <> 'TOTAL' THEN date_trunc('hour', t) END) AS horas,"
        " CASE WHEN NOT valido THEN 'sem_coluna_de_tempo'"
        " WHEN count(CASE WHEN c[1] <> 'TOTAL' THEN t END) = 0 THEN 'sem_dado_valido' ELSE 'ok' END AS situacao"
        " FROM (SELECT *, try_strptime(c[1], '%d/%m/%Y %H:%M') AS t FROM partes) GROUP BY arquivo, valido",
        "partes",
    ),
    # upsert, schema evolution, integrity
    "colunas_novas": _com(
        "SELECT tabela, descricao_norm, arquivo, descricao FROM entregues e WHERE lote % 2 = 1"
        " AND NOT EXISTS (SELECT 1 FROM entregues k WHERE k.lote % 2 = 0 AND k.tabela = e.tabela"
        " AND k.descricao_norm = e.descricao_norm)"
        " QUALIFY row_number() OVER (PARTITION BY tabela, descricao_norm ORDER BY arquivo, pos) = 1",
        "entregues",
    ),
    "cresce_catalogo": _com(
        "SELECT tabela, CAST(dense_rank() OVER (ORDER BY primeiro, tabela) - 1 AS INTEGER) AS tabela_ordem,"
        " CAST(row_number() OVER (PARTITION BY tabela ORDER BY arquivo, pos) - 1 AS INTEGER) AS pos,"
        " descricao, descricao_norm, 'REAL' AS tipo"
        " FROM (SELECT *, min(arquivo) OVER (PARTITION BY tabela) AS primeiro FROM entregues"
        " QUALIFY row_number() OVER (PARTITION BY tabela, descricao_norm ORDER BY arquivo, pos) = 1)",
        "entregues",
    ),
    "upsert_linha": _com(
        "SELECT tabela, data_hora, descricao, CASE k WHEN 0 THEN v0 WHEN 1 THEN CASE WHEN e_o THEN v1 ELSE v2 END"
        " WHEN 2 THEN CASE WHEN NOT e_o THEN v3 END WHEN 3 THEN CASE WHEN e_o THEN v2 END END AS valor"
        " FROM (SELECT * FROM horas QUALIFY row_number() OVER (PARTITION BY tabela, data_hora"
        " ORDER BY arquivo DESC) = 1) JOIN tabela_cols USING (tabela)",
        "horas",
        "tabela_cols",
    ),
    "upsert_celula": _com(
        "SELECT tabela, data_hora, descricao, CASE k"
        " WHEN 0 THEN coalesce(max(CASE WHEN e_o THEN v0 END), max(v0))"
        " WHEN 1 THEN coalesce(max(CASE WHEN e_o THEN v1 END), max(v2))"
        " WHEN 2 THEN max(CASE WHEN NOT e_o THEN v3 END) WHEN 3 THEN max(CASE WHEN e_o THEN v2 END)"
        " END AS valor FROM horas JOIN tabela_cols USING (tabela) GROUP BY tabela, data_hora, descricao, k",
        "horas",
        "tabela_cols",
    ),
    "chaves_duplicadas": _com(
        "SELECT tabela, data_hora, count(*) AS ocorrencias FROM horas"
        " GROUP BY tabela, data_hora HAVING count(*) > 1",
        "horas",
    ),
    "diagnostico_colunas": _com(
        "SELECT replace(replace(tabela, ' ', '_'), '-', '_') AS tabela, CAST(sum(n) + 1 AS BIGINT) AS n_colunas,"
        " count(*) FILTER (n > 1) AS n_repetidas"
        " FROM (SELECT tabela, descricao_norm, count(*) AS n FROM cab_norma GROUP BY ALL) GROUP BY tabela",
        "cab_norma",
    ),
    # registry
    "codigos": _com("SELECT codigo FROM equipamentos", "equipamentos"),
    "codigos_distintos": _com(
        "SELECT DISTINCT codigo FROM equipamentos WHERE codigo IS NOT NULL", "equipamentos"
    ),
    "potencia_instalada": _com("SELECT * FROM potencias", "potencias"),
    "canais": _com(
        "SELECT codigo, sufixo, codigo || '-' || sufixo AS canal FROM resolvidos"
        " CROSS JOIN (VALUES ('EAE'), ('EAR'), ('ERE'), ('ERR')) v(sufixo)",
        "resolvidos",
    ),
    "resolve_canais": _com("SELECT * FROM resolvidos", "resolvidos"),
    "canais_incompletos": _com(
        "SELECT * FROM (SELECT codigo, CAST((eae IS NULL)::INT + (ear IS NULL)::INT + (ere IS NULL)::INT"
        " + (err IS NULL)::INT AS INTEGER) AS canais_faltantes FROM resolvidos) WHERE canais_faltantes > 0",
        "resolvidos",
    ),
    "canais_lenientes": _com(
        "SELECT r.codigo, sufixo, r.codigo || '-' || sufixo AS canal, m.descricao,"
        " CAST(m.descricao IS NULL AS INTEGER) AS ausente"
        " FROM resolvidos r CROSS JOIN (VALUES ('EAE'), ('EAR'), ('ERE'), ('ERR')) v(sufixo)"
        " LEFT JOIN medidores m ON m.codigo = r.codigo || '-' || sufixo",
        "resolvidos",
    ),
    "insere_ou_ignora": _com(
        "SELECT codigo, descricao FROM medidores UNION ALL SELECT codigo, c_name AS descricao"
        f" FROM (SELECT {_codigo('c_custkey // 2')} || '-EAE' AS codigo, c_name, c_custkey FROM customer"
        " WHERE c_custkey % 10 <> 5"
        " QUALIFY row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey) = 1)"
        " WHERE codigo NOT IN (SELECT codigo FROM medidores)",
        "medidores",
    ),
    "codigo_relatorio": _com(
        "SELECT codigo, CASE WHEN contains(codigo, 'TR') THEN codigo ELSE 'AL-' || codigo END AS relatorio"
        " FROM resolvidos",
        "resolvidos",
    ),
    "nome_equipamento": _com(
        "SELECT codigo, replace(eae, '-EAE', '') AS nome FROM resolvidos"
        " WHERE eae IS NOT NULL AND ear IS NOT NULL AND ere IS NOT NULL AND err IS NOT NULL",
        "resolvidos",
    ),
    "cadastro_atualiza": _com(
        "SELECT e.id, CASE WHEN m.id IS NULL THEN e.codigo ELSE m.codigo END AS codigo,"
        " CASE WHEN m.id IS NULL OR m.ilegivel THEN e.potencia_instalada ELSE m.potencia_instalada END"
        " AS potencia_instalada FROM equipamentos e LEFT JOIN atualizacoes m ON m.id = e.id",
        "equipamentos",
        "atualizacoes",
    ),
    "mudancas_ilegiveis": _com(
        "SELECT id, 'potencia_instalada' AS coluna, 'abc' AS texto FROM atualizacoes"
        " WHERE ilegivel AND id IN (SELECT id FROM equipamentos)",
        "equipamentos",
        "atualizacoes",
    ),
    "cadastro_edicoes": _com(
        "SELECT id, fim.codigo AS codigo, fim.potencia AS potencia_instalada FROM dobradas WHERE fim.vive", "dobradas"
    ),
    "edicoes_ilegiveis": _com(
        "SELECT id, unnest(string_split(rtrim(fim.ruins, ','), ','))::BIGINT AS ordem, 'potencia_instalada' AS coluna,"
        " 'abc' AS texto FROM dobradas WHERE fim.vive AND fim.ruins <> ''",
        "dobradas",
    ),
    "formato_por_arquivo": _com("SELECT arquivo, formato, lidas, ambiguo FROM formatos", "formatos"),
    "parse_formatos_mistos": _com(
        "SELECT arquivo, nr_linha, t AS texto_tempo, CASE formato WHEN 0 THEN a ELSE b END AS instante"
        " FROM dois_formatos JOIN formatos USING (arquivo) WHERE t <> 'TOTAL'",
        "dois_formatos",
        "formatos",
    ),
    "cadastro_exclui": _com(
        "SELECT * FROM equipamentos WHERE id NOT IN (SELECT id FROM mudancas WHERE op = 'D')",
        "equipamentos",
        "mudancas",
    ),
    # hourly base
    "base_horaria": _com(
        "SELECT codigo, data_hora, tabela_origem, tabela_ordem, eae, ear, ere, err FROM base", "base"
    ),
    "base_por_blocos": _com(
        "SELECT codigo, data_hora, tabela_origem, tabela_ordem, eae, ear, ere, err FROM base", "base"
    ),
    "base_colunas_tardias": _com(
        "SELECT codigo, data_hora, tabela_origem, tabela_ordem, "
        + ", ".join(f"CASE WHEN ja THEN {c} END AS {c}" for c in ("eae", "ear", "ere", "err"))
        + " FROM (SELECT b.*, s_suppkey % 25 % 2 = 0 OR data_hora >= TIMESTAMP '1995-06-01 00:00:00' AS ja"
        f" FROM base b JOIN supplier ON b.codigo = {_codigo('s_suppkey')})",
        "base",
    ),
    "tabelas_elegiveis": _com(
        "SELECT codigo, tabela, tabela_ordem, pos_eae, CAST(pos_eae + 1 AS INTEGER) AS pos_ear,"
        " CAST(pos_eae + 2 AS INTEGER) AS pos_ere, CAST(pos_eae + 3 AS INTEGER) AS pos_err, exato"
        " FROM (SELECT g.*, c.pos AS pos_eae FROM elegiveis g JOIN catalogo c ON c.tabela = g.tabela"
        " AND lower(c.descricao) = lower('SE ' || g.codigo || '-EAE'))",
        "elegiveis",
    ),
    "tabelas_com_dados": _com(
        "SELECT codigo, tabela_origem, count(eae) AS horas_com_dado FROM base"
        " GROUP BY codigo, tabela_origem HAVING count(eae) > 0",
        "base",
    ),
    "uniao_tabelas": _com(
        "SELECT codigo, tabela_origem, count(*) AS linhas, count(eae) AS com_eae FROM base"
        " GROUP BY codigo, tabela_origem",
        "base",
    ),
    "dedup_primeira_tabela": _com(
        "SELECT codigo, data_hora, tabela_origem, tabela_ordem, eae, ear, ere, err FROM base"
        " QUALIFY row_number() OVER (PARTITION BY codigo, data_hora ORDER BY tabela_ordem) = 1",
        "base",
    ),
    "filtro_instante": _com(
        "SELECT codigo, data_hora, tabela_origem, tabela_ordem, eae, ear, ere, err FROM base"
        f" WHERE data_hora = {INSTANTE}",
        "base",
    ),
    "filtro_mes_ano": _com(
        f"SELECT codigo, data_hora, p, q, s FROM demanda WHERE {ANO_MES}", "demanda"
    ),
    "equipamentos_sem_dados": _com(
        "SELECT r.codigo, CASE WHEN eae IS NULL OR ear IS NULL OR ere IS NULL OR err IS NULL"
        " THEN 'canal_sem_cadastro' WHEN potencia_instalada IS NULL THEN 'sem_potencia_instalada'"
        " ELSE 'sem_medicao' END AS motivo"
        " FROM resolvidos r JOIN potencias USING (codigo)"
        " WHERE r.codigo NOT IN (SELECT codigo FROM demanda)",
        "resolvidos",
        "demanda",
    ),
    # electrical quantities
    "potencia_ativa": _com(
        "SELECT codigo, tabela, data_hora, eae - ear AS p_u, coalesce(eae - ear, 0) AS p_c,"
        " eae - ear AS p_s FROM em_linha",
        "em_linha",
    ),
    "potencia_reativa": _com(
        "SELECT codigo, tabela, data_hora, ere - err AS q_u, coalesce(ere - err, 0) AS q_c,"
        " ere - err AS q_s FROM em_linha",
        "em_linha",
    ),
    "potencia_aparente": _com(
        "SELECT codigo, tabela, data_hora, sqrt(p * p + q * q) AS s_u,"
        " nullif(sqrt(coalesce(p, 0) * coalesce(p, 0) + coalesce(q, 0) * coalesce(q, 0)), 0) AS s_c,"
        " sqrt(p * p + q * q) AS s_s"
        " FROM (SELECT *, eae - ear AS p, ere - err AS q FROM em_linha)",
        "em_linha",
    ),
    "fator_potencia": _com(
        "SELECT codigo, tabela, data_hora, CASE WHEN s <> 0 THEN p / s END AS fp_u,"
        " CASE WHEN sc <> 0 THEN pc / sc ELSE 0 END AS fp_c,"
        " CASE WHEN s = 0 THEN 0 ELSE p / s END AS fp_s"
        " FROM (SELECT *, sqrt(p * p + q * q) AS s, sqrt(pc * pc + qc * qc) AS sc"
        " FROM (SELECT *, eae - ear AS p, ere - err AS q, coalesce(eae - ear, 0) AS pc,"
        " coalesce(ere - err, 0) AS qc FROM em_linha))",
        "em_linha",
    ),
    "ultrapassagem": _com("SELECT codigo, data_hora, ultrapassagem FROM demanda", "demanda"),
    # key figures
    "kpi_p": _com("SELECT codigo, max_p, min_p FROM est", "est"),
    "kpi_s": _com("SELECT codigo, max_s FROM est", "est"),
    "kpi_medias": _com("SELECT codigo, media_p, media_q FROM est", "est"),
    "minimo_sem_zero": _com("SELECT codigo, min_p_sem_zero FROM est", "est"),
    "desvio_padrao": _com("SELECT codigo, desvio_p FROM est", "est"),
    "limite_inferior": _com("SELECT codigo, limite_inferior FROM limites", "limites"),
    "fp_global": _com(
        "SELECT codigo, round_even(media_s * 10000, 0) / 10000 AS media_s, fp_global FROM limites", "limites"
    ),
    "maximo_filtrado": _com("SELECT codigo, max_p_filtrado FROM filtrado", "filtrado"),
    "maximo_robusto": _com("SELECT codigo, max_p, max_p_robusto FROM limites", "limites"),
    "minimo_robusto": _com("SELECT codigo, min_p, min_p_robusto FROM limites", "limites"),
    "carregamento": _com("SELECT codigo, s_pico, carregamento_pct FROM limites", "limites"),
    "horas_ultrapassagem": _com("SELECT codigo, horas_ultrapassagem FROM est", "est"),
    "instante_maximo": _com(
        "SELECT codigo, data_hora, q FROM demanda JOIN limites USING (codigo) WHERE p = max_p_robusto",
        "limites",
        "demanda",
    ),
    "instante_minimo": _com(
        "SELECT codigo, data_hora, q FROM demanda JOIN est USING (codigo) WHERE p = min_p", "est", "demanda"
    ),
    "q_no_extremo": _com("SELECT * FROM extremos", "extremos"),
    "painel_demanda": _com(
        "SELECT codigo, potencia_instalada, max_p_robusto, min_p_robusto, max_s, media_p, media_q, desvio_p,"
        " fp_global, s_pico, carregamento_pct, horas_ultrapassagem, instante_maximo, q_no_maximo,"
        " instante_minimo, q_no_minimo FROM limites JOIN extremos USING (codigo)",
        "limites",
        "extremos",
    ),
    "painel_escolhidos": _com(
        "SELECT codigo, potencia_instalada, max_p_robusto, min_p_robusto, max_s, media_p, media_q, desvio_p,"
        " fp_global, s_pico, carregamento_pct, horas_ultrapassagem, instante_maximo, q_no_maximo,"
        " instante_minimo, q_no_minimo FROM limites JOIN extremos USING (codigo)"
        " WHERE codigo IN ('F000000001', 'TR-000000002', 'F000000007', 'TR-000000010')",
        "limites",
        "extremos",
    ),
    "painel_exibido": _com(
        "SELECT codigo, max_p_robusto, printf('%.2f%%', carregamento_pct) AS carregamento,"
        " round_even(potencia_instalada, 0) AS potencia_instalada, min_p_robusto, fp_global,"
        " horas_ultrapassagem, strftime(instante_maximo, '%d-%m-%Y %H:%M') AS instante_maximo, q_no_maximo,"
        " strftime(instante_minimo, '%d-%m-%Y %H:%M') AS instante_minimo, q_no_minimo"
        " FROM limites JOIN extremos USING (codigo)",
        "limites",
        "extremos",
    ),
    "faixa_inversao": _com(
        "SELECT codigo, t0, t1, least(coalesce(min_p, 0), 0) AS y0, CAST(0 AS DOUBLE) AS y1"
        " FROM est JOIN pontas USING (codigo)",
        "est",
        "pontas",
    ),
    # profiles
    "serie_anual": _com("SELECT codigo, data_hora, p, q, s FROM demanda", "demanda"),
    "linhas_referencia": _com(
        "SELECT codigo, linha, t0, t1, CASE linha WHEN 'minimo' THEN min_p_robusto"
        " WHEN 'maximo' THEN max_p_robusto ELSE potencia_instalada END AS y"
        " FROM limites JOIN pontas USING (codigo)"
        " CROSS JOIN (VALUES ('potencia_instalada'), ('minimo'), ('maximo')) v(linha)",
        "limites",
        "pontas",
    ),
    "curva_diaria": _com(
        "SELECT codigo, CAST(month(data_hora) AS INTEGER) AS mes, CAST(day(data_hora) AS INTEGER) AS dia,"
        f" CAST(hour(data_hora) AS INTEGER) AS hora, p FROM demanda WHERE {ANO}",
        "demanda",
    ),
    "dias_presentes": _com(
        f"SELECT DISTINCT codigo, CAST(day(data_hora) AS INTEGER) AS dia FROM demanda WHERE {ANO}", "demanda"
    ),
    "demanda_mensal": _com(
        "SELECT 'SE ' || rel AS descricao, rel AS codigo, nome || ' kW' AS mes,"
        " CASE WHEN o_custkey % 50 = 7 AND i = 3 THEN NULL ELSE valor END AS valor"
        " FROM (SELECT DISTINCT o_custkey, CASE WHEN contains(codigo, 'TR') THEN codigo"
        " ELSE 'AL-' || codigo END AS rel FROM maximas WHERE o_custkey IN (SELECT c_custkey FROM customer)) c"
        " CROSS JOIN (VALUES (1, 'Janeiro'), (2, 'Fevereiro'), (3, 'Março'), (4, 'Abril'), (5, 'Maio'),"
        " (6, 'Junho'), (7, 'Julho'), (8, 'Agosto'), (9, 'Setembro'), (10, 'Outubro'), (11, 'Novembro'),"
        " (12, 'Dezembro')) v(i, nome)"
        " LEFT JOIN (SELECT o_custkey, m AS i, valor FROM maximas) x USING (o_custkey, i)",
        "maximas",
    ),
    # coincident demand and composition
    "demanda_coincidente": _com(
        "SELECT codigo, data_hora, max(p) AS p, max(q) AS q, max(nullif(s, 0)) AS s,"
        " max(CASE WHEN s <> 0 THEN p / s ELSE 0 END) AS fp"
        " FROM (SELECT *, sqrt(p * p + q * q) AS s FROM (SELECT codigo, data_hora,"
        " coalesce(eae - ear, 0) AS p, coalesce(ere - err, 0) AS q FROM base"
        f" WHERE exato = 1 AND data_hora = {INSTANTE} AND (codigo, tabela_origem) IN"
        " (SELECT (codigo, tabela_origem) FROM base WHERE eae IS NOT NULL)))"
        " GROUP BY codigo, data_hora",
        "base",
    ),
    "composicao_spec": _com("SELECT * FROM formulas", "formulas"),
    "demanda_composta": _com(
        "SELECT formula, data_hora, p, q, s, CASE WHEN s = 0 THEN 0 ELSE p / s END AS fp"
        " FROM (SELECT *, sqrt(p * p + q * q) AS s FROM (SELECT formula, data_hora,"
        " CASE WHEN count(p) = n THEN sum(sinal * p) END AS p, CASE WHEN count(q) = n THEN sum(sinal * q) END AS q"
        " FROM parcelas JOIN formulas USING (codigo) JOIN (SELECT formula, count(*) AS n FROM formulas"
        " WHERE codigo IN (SELECT codigo FROM lugares) GROUP BY formula) USING (formula)"
        " GROUP BY formula, data_hora, n))",
        "parcelas",
        "formulas",
    ),
}

SQL["coincidente_titulos"] = (
    'SELECT codigo AS "Equipamento", data_hora AS "Data/Hora", p AS "Potência Ativa (kW)",'
    ' q AS "Potência Reativa (kvar)", s AS "Potência Aparente (kVA)", fp AS "FP"'
    f" FROM ({SQL['demanda_coincidente']})"
)

SQL["coincidente_sem_dados"] = _com(
    "SELECT codigo, CASE WHEN eae IS NULL OR ear IS NULL OR ere IS NULL OR err IS NULL"
    " THEN 'canal_sem_cadastro' ELSE 'sem_medicao' END AS motivo"
    f" FROM resolvidos WHERE codigo NOT IN (SELECT codigo FROM ({SQL['demanda_coincidente']}))",
    "resolvidos",
)

SQL["upsert_existente"] = (
    f"SELECT *, 'linha' AS modo FROM ({SQL['upsert_linha']}) UNION ALL"
    f" SELECT *, 'celula' AS modo FROM ({SQL['upsert_celula']})"
)

# the same rows by another way
for _nome in ("painel_por_resumos", "painel_resumos_curtos"):
    SQL[_nome] = SQL["painel_demanda"]

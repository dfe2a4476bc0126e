"""Every operator as a query over the driver's tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from fasor.functions import eletrica, texto
from fasor.functions.numero import arredonda, numero_br
from fasor.functions.tempo import FORMATO_PADRAO, trunca_hora
from fasor.operators import base, blocos, cadastro, carga, coincidente, composicao, kpi, limpeza, perfis, resumos
from fasor.operators.materializa import materializa
from fasor.plans import entradas as e

INSTANTE = datetime(1997, 1, 8, 13)
ANO, MES = 1997, 3
CORTE = datetime(1995, 6, 1)
ESCOLHIDOS = ("F000000001", "TR-000000002", "F000000007", "TR-000000010")
FORMATOS = (FORMATO_PADRAO, "M/d/yyyy H:mm")

Consulta = Callable[[SparkSession, str], DataFrame]
CONSULTAS: dict[str, Consulta] = {}


def consulta(funcao: Consulta) -> Consulta:
    CONSULTAS[funcao.__name__] = funcao
    return funcao


# ---- shared pieces -------------------------------------------------------------------------


def _cabecalhos(s: SparkSession, d: str) -> DataFrame:
    return materializa(limpeza.cabecalhos(e.linhas(s, d)))


def _interpretadas(s: SparkSession, d: str, cab: DataFrame | None = None) -> DataFrame:
    cab = _cabecalhos(s, d) if cab is None else cab
    return limpeza.interpreta(e.linhas(s, d), limpeza.canais_por_arquivo(cab))


def _largas(s: SparkSession, d: str, cab: DataFrame | None = None) -> DataFrame:
    return limpeza.horas_largas(limpeza.leituras(_interpretadas(s, d, cab)), linhas=_corpo(s, d))


def _corpo(s: SparkSession, d: str) -> DataFrame:
    return e.linhas(s, d).filter("nr_linha > 0").select("arquivo")


def _catalogo_vazio(s: SparkSession) -> DataFrame:
    return s.createDataFrame([], carga.ESQUEMA_CATALOGO)


def _carga(s: SparkSession, d: str, modo: str) -> DataFrame:
    cab = _cabecalhos(s, d)
    colunas = materializa(limpeza.colunas_dos_arquivos(cab))
    catalogo = materializa(carga.cresce_catalogo(_catalogo_vazio(s), colunas))
    tabela = carga.sobrepoe(carga.alinha(_largas(s, d, cab), colunas, catalogo), modo)
    return carga.celulas_nomeadas(tabela, catalogo)


def _resolvidos(s: SparkSession, d: str) -> DataFrame:
    codigos = cadastro.codigos_distintos(e.equipamentos(s, d))
    return cadastro.resolve_canais(codigos, e.medidores(s, d))


def _sem_casas(s: SparkSession) -> DataFrame:
    return s.createDataFrame([], carga.ESQUEMA_CATALOGO + ", casa int, inteiro boolean")


def _guardadas(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Catalogue and measurements as a base keeps them."""
    catalogo = materializa(blocos.com_casas(e.catalogo(s, d), _sem_casas(s)))
    return catalogo, materializa(blocos.em_blocos(e.medicoes(s, d), catalogo))


def _elegiveis(s: SparkSession, d: str, caso: str = "insensivel") -> DataFrame:
    return base.tabelas_elegiveis(e.catalogo(s, d), cadastro.completos(_resolvidos(s, d)), caso)


def _base(s: SparkSession, d: str) -> DataFrame:
    return base.base_horaria(e.medicoes(s, d), materializa(_elegiveis(s, d)))


def _demanda(s: SparkSession, d: str) -> DataFrame:
    return base.demanda(e.medicoes(s, d), _elegiveis(s, d), e.equipamentos(s, d))


def _limites(s: SparkSession, d: str) -> DataFrame:
    demanda = materializa(_demanda(s, d))
    return kpi.limites(demanda, materializa(kpi.estatisticas(demanda)))


# ---- scans, sources, sinks -----------------------------------------------------------------


@consulta
def parse_linhas(s, d):
    campos = limpeza.campos(F.col("linha"))
    return e.linhas(s, d).filter("nr_linha > 0").select(
        "arquivo",
        "nr_linha",
        F.size(campos).cast("bigint").alias("n_campos"),
        *[F.get(campos, F.lit(i)).alias(f"c{i}") for i in range(5)],
    )


@consulta
def scan_todas_tabelas(s, d):
    valores = F.col("valores")
    return e.medicoes(s, d).select(
        "tabela",
        "data_hora",
        F.size(valores).cast("bigint").alias("n_canais"),
        F.size(F.filter(valores, lambda v: v.isNotNull())).cast("bigint").alias("n_valores"),
        F.aggregate(valores, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))).alias("soma"),
    )


@consulta
def listar_tabelas(s, d):
    return e.catalogo(s, d).select("tabela").distinct()


@consulta
def listar_colunas(s, d):
    return carga.colunas_da_tabela(e.catalogo(s, d))


@consulta
def cadastro_sem_nulos(s, d):
    return cadastro.sem_chave_nula(e.equipamentos(s, d), "codigo", exige=["potencia_instalada"])


@consulta
def scan_cadastro(s, d):
    return e.equipamentos(s, d)


@consulta
def amostra_cadastro(s, d):
    return cadastro.amostra(e.equipamentos(s, d))


@consulta
def export_curva(s, d):
    do_mes = base.no_periodo(base.com_tabela(_demanda(s, d), e.catalogo(s, d)), ANO, MES)
    return perfis.curva_para_exportar(do_mes)


# ---- ingest cleaning -----------------------------------------------------------------------


@consulta
def arquivos_validos(s, d):
    linhas = e.linhas(s, d)
    validos = limpeza.arquivos_validos(limpeza.cabecalhos(linhas))
    return (
        linhas.filter("nr_linha > 0")
        .groupBy("arquivo")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .join(validos.select("arquivo"), "arquivo", "left_semi")
    )


@consulta
def filtra_total(s, d):
    return _interpretadas(s, d).select("arquivo", "nr_linha", "texto_tempo")


@consulta
def parse_data_hora(s, d):
    return _interpretadas(s, d).select("arquivo", "nr_linha", "texto_tempo", "instante")


@consulta
def formato_por_arquivo(s, d):
    linhas = materializa(e.linhas_de_dois_formatos(s, d))
    return limpeza.formatos_dos_arquivos(linhas, limpeza.cabecalhos(linhas), FORMATOS)


@consulta
def parse_formatos_mistos(s, d):
    linhas = materializa(e.linhas_de_dois_formatos(s, d))
    cab = materializa(limpeza.cabecalhos(linhas))
    escolhidos = materializa(limpeza.formatos_dos_arquivos(linhas, cab, FORMATOS).select("arquivo", "formato"))
    canais = limpeza.canais_por_arquivo(cab).join(escolhidos, "arquivo", "left")
    return limpeza.interpreta(linhas, canais, FORMATOS).select("arquivo", "nr_linha", "texto_tempo", "instante")


@consulta
def rejeitados(s, d):
    return limpeza.rejeitados(_interpretadas(s, d))


@consulta
def trunca_hora_(s, d):
    return e.amostras(s, d).select(
        "equip", "eae", "instante", trunca_hora(F.col("instante")).alias("data_hora")
    )


CONSULTAS["trunca_hora"] = CONSULTAS.pop("trunca_hora_")


@consulta
def parse_numero_br(s, d):
    campos = limpeza.campos(F.col("linha"))
    numeros = e.linhas(s, d).filter("nr_linha > 0").withColumn("campos", campos)
    return numeros.select(
        "arquivo",
        "nr_linha",
        *[F.get("campos", F.lit(i)).alias(f"t{i}") for i in range(1, 5)],
        *[numero_br(F.get("campos", F.lit(i))).alias(f"v{i}") for i in range(1, 5)],
    )


@consulta
def dedup_leituras(s, d):
    unicas = limpeza.sem_duplicatas(limpeza.leituras(_interpretadas(s, d)), linhas=_corpo(s, d))
    return unicas.select(
        "arquivo", "data_hora", *[F.get("valores", F.lit(i)).alias(f"v{i}") for i in range(4)]
    )


@consulta
def dedup_eventos(s, d):
    return e.leituras_canal(s, d).distinct()


@consulta
def serie_ordenada(s, d):
    # sorted within partitions by equipment, as it is written: no global sort of the history
    return perfis.serie(_demanda(s, d)).repartition("codigo", F.year("data_hora")).sortWithinPartitions("codigo", "data_hora")


@consulta
def agrega_hora(s, d):
    return _largas(s, d).select("arquivo", "data_hora", F.posexplode("valores").alias("indice", "valor"))


@consulta
def arredonda_2(s, d):
    x = F.col("l_extendedprice") * (1 + F.col("l_tax")) / 7
    return e.le(s, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", arredonda(x, 2).alias("arredondado")
    )


@consulta
def colunas_repetidas(s, d):
    unicas = limpeza.sem_repetidas(e.cabecalhos(s, d))
    pares = F.arrays_zip("posicoes", "nomes")
    return unicas.select("arquivo", F.explode(pares).alias("par")).select(
        "arquivo", F.col("par.posicoes").alias("pos"), F.col("par.nomes").alias("coluna")
    )


@consulta
def normaliza_colunas(s, d):
    return e.colunas_entregues(s, d)


@consulta
def nome_tabela(s, d):
    nomes = (
        e.linhas(s, d)
        .select("membro")
        .unionByName(e.linhas_de_cabecalho(s, d).select("membro"))
        .unionByName(e.le(s, d, "part").select(F.concat("p_name", F.lit(" - 01.TXT.txt")).alias("membro")))
        .distinct()
    )
    return nomes.select("membro", texto.nome_tabela(F.col("membro")).alias("tabela"))


@consulta
def auditoria_carga(s, d):
    linhas = materializa(e.linhas(s, d))
    cab = materializa(limpeza.cabecalhos(linhas))
    return limpeza.auditoria(limpeza.examina(linhas, cab), cab, limpeza.marcas(linhas))


@consulta
def colunas_omitidas(s, d):
    return limpeza.colunas_omitidas(e.cabecalhos(s, d))


# ---- upsert, schema evolution, integrity ---------------------------------------------------


@consulta
def colunas_novas(s, d):
    colunas = e.colunas_entregues(s, d)
    par = F.substring_index(F.substring_index("arquivo", ") ", -1), ".", 1).cast("bigint") % 2 == 0
    catalogo = colunas.filter(par).select("tabela", "descricao_norm").distinct()
    return carga.colunas_novas(colunas.filter(~par), catalogo).drop("indice")


@consulta
def cresce_catalogo(s, d):
    return carga.cresce_catalogo(_catalogo_vazio(s), e.colunas_entregues(s, d))


@consulta
def upsert_linha(s, d):
    return _carga(s, d, "linha")


@consulta
def upsert_celula(s, d):
    return _carga(s, d, "celula")


@consulta
def upsert_existente(s, d):
    """The F files as the stored rows, then the O files as a second load into them, by row and by cell."""
    cab = _cabecalhos(s, d)
    colunas = materializa(limpeza.colunas_dos_arquivos(cab))
    largas = materializa(_largas(s, d, cab))
    do_f = F.col("arquivo").endswith("F.txt")
    primeiro = materializa(carga.cresce_catalogo(_catalogo_vazio(s), colunas.filter(do_f)))
    segundo = materializa(carga.cresce_catalogo(primeiro, colunas.filter(~do_f)))
    atuais = materializa(carga.sobrepoe(carga.alinha(largas.filter(do_f), colunas.filter(do_f), primeiro)))
    novas = materializa(carga.alinha(largas.filter(~do_f), colunas.filter(~do_f), segundo))
    por_modo = [
        carga.celulas_nomeadas(carga.upsert(atuais, novas, modo), segundo).withColumn("modo", F.lit(modo))
        for modo in ("linha", "celula")
    ]
    return por_modo[0].unionByName(por_modo[1])


@consulta
def chaves_duplicadas(s, d):
    cab = _cabecalhos(s, d)
    colunas = limpeza.colunas_dos_arquivos(cab).select("arquivo", "tabela").distinct()
    horas = _largas(s, d, cab).select("arquivo", "data_hora")
    return carga.chaves_duplicadas(horas.join(colunas, "arquivo"))


@consulta
def diagnostico_colunas(s, d):
    canais = F.explode(F.filter("campos", lambda c: c != limpeza.COLUNA_TEMPO))
    catalogo = e.cabecalhos(s, d).select(
        texto.nome_tabela(F.col("membro")).alias("tabela"), canais.alias("descricao")
    )
    return carga.diagnostico_colunas(carga.com_chave_normalizada(catalogo))


# ---- registry ------------------------------------------------------------------------------


@consulta
def codigos(s, d):
    return cadastro.codigos(e.equipamentos(s, d))


@consulta
def codigos_distintos(s, d):
    return cadastro.codigos_distintos(e.equipamentos(s, d))


@consulta
def potencia_instalada(s, d):
    return cadastro.potencia_instalada(e.equipamentos(s, d))


@consulta
def canais(s, d):
    return cadastro.canais(cadastro.codigos_distintos(e.equipamentos(s, d)))


@consulta
def resolve_canais(s, d):
    return _resolvidos(s, d)


@consulta
def canais_incompletos(s, d):
    return cadastro.incompletos(_resolvidos(s, d))


@consulta
def canais_lenientes(s, d):
    codigos = cadastro.codigos_distintos(e.equipamentos(s, d))
    return composicao.canais_lenientes(codigos, e.medidores(s, d))


@consulta
def insere_ou_ignora(s, d):
    return cadastro.insere_ou_ignora(e.medidores(s, d), e.medidores_novos(s, d), "ordem")


@consulta
def codigo_relatorio(s, d):
    codigos = cadastro.codigos_distintos(e.equipamentos(s, d))
    return codigos.withColumn("relatorio", texto.codigo_relatorio(F.col("codigo")))


@consulta
def nome_equipamento(s, d):
    return cadastro.completos(_resolvidos(s, d)).select(
        "codigo", texto.nome_equipamento(F.col("eae")).alias("nome")
    )


@consulta
def cadastro_atualiza(s, d):
    return cadastro.atualiza(e.equipamentos(s, d), e.mudancas(s, d), ordem="ordem")


@consulta
def mudancas_ilegiveis(s, d):
    return cadastro.mudancas_ilegiveis(e.equipamentos(s, d), e.mudancas(s, d), ordem="ordem")


@consulta
def cadastro_edicoes(s, d):
    return cadastro.aplica(e.equipamentos(s, d), e.edicoes(s, d))


@consulta
def edicoes_ilegiveis(s, d):
    return cadastro.edicoes_ilegiveis(e.equipamentos(s, d), e.edicoes(s, d))


@consulta
def cadastro_exclui(s, d):
    return cadastro.exclui(e.equipamentos(s, d), e.mudancas(s, d))


# ---- hourly base ---------------------------------------------------------------------------


@consulta
def base_horaria(s, d):
    return _base(s, d)


@consulta
def base_por_blocos(s, d):
    """The same rows from blocks of 16 channels."""
    catalogo, medidas = _guardadas(s, d)
    return base.base_horaria(medidas, materializa(base.tabelas_elegiveis(catalogo, cadastro.completos(_resolvidos(s, d)))))


@consulta
def base_colunas_tardias(s, d):
    """Half of the meters come with a second load, at ``CORTE``: their older hours are rows without values."""
    todas = e.catalogo(s, d)
    primeiro = materializa(blocos.com_casas(todas.filter("floor(pos / 4) % 2 = 0"), _sem_casas(s)))
    segundo = materializa(blocos.com_casas(todas, primeiro))
    antes = F.col("data_hora") < F.lit(CORTE.isoformat(" ")).cast("timestamp_ntz")
    medidas = materializa(e.medicoes(s, d))
    juntas = blocos.em_blocos(medidas.filter(antes), primeiro).unionByName(blocos.em_blocos(medidas.filter(~antes), segundo))
    elegiveis = base.tabelas_elegiveis(segundo, cadastro.completos(_resolvidos(s, d)))
    return base.base_horaria(juntas, materializa(elegiveis))


@consulta
def painel_escolhidos(s, d):
    """Key figures of chosen equipments, of whose tables the blocks that hold them are read."""
    catalogo, medidas = _guardadas(s, d)
    elegiveis = base.tabelas_elegiveis(catalogo, cadastro.completos(_resolvidos(s, d)))
    escolhidos = materializa(base.dos_codigos(elegiveis, ESCOLHIDOS))
    return kpi.painel(base.demanda(medidas, escolhidos, e.equipamentos(s, d)))


def _painel_por_resumos(s: SparkSession, d: str, maiores: int) -> DataFrame:
    demanda = materializa(_demanda(s, d))
    return resumos.painel(materializa(resumos.resumo_mensal(demanda, maiores)), lambda _: demanda)


@consulta
def painel_por_resumos(s, d):
    """The key figures from monthly summaries."""
    return _painel_por_resumos(s, d, resumos.MAIORES)


@consulta
def painel_resumos_curtos(s, d):
    """The same where months keep one value, so that those with outliers are read again."""
    return _painel_por_resumos(s, d, 1)


@consulta
def tabelas_elegiveis(s, d):
    chaves = ["codigo", "tabela"]
    exatas = _elegiveis(s, d, "sensivel").select(*chaves, F.lit(1).alias("exato"))
    return _elegiveis(s, d).join(exatas, chaves, "left").fillna(0, ["exato"])


@consulta
def tabelas_com_dados(s, d):
    return base.tabelas_com_dados(_elegiveis(s, d), e.presenca(s, d))


@consulta
def uniao_tabelas(s, d):
    return _base(s, d).groupBy("codigo", "tabela_origem").agg(
        F.count(F.lit(1)).alias("linhas"), F.count("eae").alias("com_eae")
    )


@consulta
def dedup_primeira_tabela(s, d):
    unica = base.primeira_tabela(_base(s, d))
    return base.com_tabela(unica, e.catalogo(s, d))


@consulta
def filtro_instante(s, d):
    linhas = base.no_instante(e.medicoes(s, d), INSTANTE)
    return base.base_horaria(linhas, materializa(_elegiveis(s, d)))


@consulta
def filtro_mes_ano(s, d):
    return perfis.serie(base.no_periodo(_demanda(s, d), ANO, MES))


@consulta
def equipamentos_sem_dados(s, d):
    return base.sem_dados(
        cadastro.codigos(e.equipamentos(s, d)), _resolvidos(s, d), _demanda(s, d), e.equipamentos(s, d)
    )


@consulta
def coincidente_sem_dados(s, d):
    return base.sem_dados(cadastro.codigos(e.equipamentos(s, d)), _resolvidos(s, d), demanda_coincidente(s, d))


# ---- electrical quantities -----------------------------------------------------------------


def _por_politica(s, d, nome: str) -> DataFrame:
    linhas = e.leituras_em_linha(s, d)
    colunas = []
    for politica in eletrica.POLITICAS:
        p = eletrica.potencia_ativa(F.col("eae"), F.col("ear"), politica)
        q = eletrica.potencia_reativa(F.col("ere"), F.col("err"), politica)
        aparente = eletrica.potencia_aparente(p, q, politica)
        valor = {
            "p": p,
            "q": q,
            "s": aparente,
            "fp": eletrica.fator_potencia(p, aparente, politica),
        }[nome]
        colunas.append(valor.alias(f"{nome}_{politica.lower()}"))
    return linhas.select("codigo", "tabela", "data_hora", *colunas)


@consulta
def potencia_ativa(s, d):
    return _por_politica(s, d, "p")


@consulta
def potencia_reativa(s, d):
    return _por_politica(s, d, "q")


@consulta
def potencia_aparente(s, d):
    return _por_politica(s, d, "s")


@consulta
def fator_potencia(s, d):
    return _por_politica(s, d, "fp")


@consulta
def ultrapassagem(s, d):
    return _demanda(s, d).select("codigo", "data_hora", "ultrapassagem")


# ---- key figures ---------------------------------------------------------------------------


@consulta
def kpi_p(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "max_p", "min_p")


@consulta
def kpi_s(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "max_s")


@consulta
def kpi_medias(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "media_p", "media_q")


@consulta
def minimo_sem_zero(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "min_p_sem_zero")


@consulta
def desvio_padrao(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "desvio_p")


@consulta
def limite_inferior(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "limite_inferior")


@consulta
def fp_global(s, d):
    # the mean is a sum in any order: rounded so that its last bits do not matter
    return kpi.estatisticas(_demanda(s, d)).select(
        "codigo", arredonda(F.col("media_s"), 4).alias("media_s"), "fp_global"
    )


@consulta
def maximo_filtrado(s, d):
    demanda = materializa(_demanda(s, d))
    figuras = kpi.maximo_filtrado(demanda, materializa(kpi.estatisticas(demanda)))
    return figuras.select("codigo", "max_p_filtrado")


@consulta
def maximo_robusto(s, d):
    return _limites(s, d).select("codigo", "max_p", "max_p_robusto")


@consulta
def minimo_robusto(s, d):
    return _limites(s, d).select("codigo", "min_p", "min_p_robusto")


@consulta
def carregamento(s, d):
    return _limites(s, d).select("codigo", "s_pico", "carregamento_pct")


@consulta
def horas_ultrapassagem(s, d):
    return kpi.estatisticas(_demanda(s, d)).select("codigo", "horas_ultrapassagem")


@consulta
def instante_maximo(s, d):
    demanda, figuras = kpi.gravadas(_demanda(s, d))
    return kpi.horas_do_extremo(demanda, figuras, "max_p_robusto").drop("ordem")


@consulta
def instante_minimo(s, d):
    demanda = materializa(_demanda(s, d))
    figuras = materializa(kpi.estatisticas(demanda))
    return kpi.horas_do_extremo(demanda, figuras, "min_p").drop("ordem")


@consulta
def q_no_extremo(s, d):
    return kpi.extremos(*kpi.gravadas(_demanda(s, d)))


@consulta
def painel_demanda(s, d):
    return kpi.painel(_demanda(s, d))


@consulta
def painel_exibido(s, d):
    return kpi.para_exibir(kpi.painel(_demanda(s, d)))


@consulta
def faixa_inversao(s, d):
    return kpi.faixa_inversao(_demanda(s, d))


# ---- profiles ------------------------------------------------------------------------------


@consulta
def serie_anual(s, d):
    return perfis.serie(_demanda(s, d))


@consulta
def linhas_referencia(s, d):
    return kpi.linhas_referencia(_limites(s, d))


@consulta
def curva_diaria(s, d):
    return perfis.curva_diaria(base.no_periodo(_demanda(s, d), ANO))


@consulta
def dias_presentes(s, d):
    return perfis.dias_presentes(base.no_periodo(_demanda(s, d), ANO))


@consulta
def demanda_mensal(s, d):
    codigos = e.le(s, d, "customer").select(e.codigo_de(F.col("c_custkey")).alias("codigo"))
    return perfis.demanda_mensal(e.maximas_mensais(s, d), codigos)


# ---- coincident demand and composition -----------------------------------------------------


@consulta
def demanda_coincidente(s, d):
    return coincidente.demanda_coincidente(
        e.medicoes(s, d), e.presenca(s, d), e.catalogo(s, d), cadastro.completos(_resolvidos(s, d)), INSTANTE
    )


@consulta
def coincidente_titulos(s, d):
    return coincidente.com_titulos(demanda_coincidente(s, d))


@consulta
def composicao_spec(s, d):
    return composicao.composicao_spec(e.formulas(s, d))


@consulta
def demanda_composta(s, d):
    termos = composicao.composicao_spec(e.formulas(s, d))
    lugares = base.lugares_nas_tabelas(e.catalogo(s, d), _resolvidos(s, d))
    return composicao.demanda_composta(e.medicoes(s, d), lugares, termos)

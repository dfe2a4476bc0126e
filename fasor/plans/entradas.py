"""The engine's inputs, derived by Spark from the driver's Parquet tables.

Every function reads whole tables. ``plans.oraculo`` states the same mappings in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fasor.functions.estrutura import calcula_uma_vez
from fasor.functions.tempo import trunca_hora
from fasor.functions.texto import SUFIXOS, codigo_relatorio, normaliza_nome
from fasor.operators import limpeza
from fasor.operators.cadastro import LUGARES
from fasor.operators.perfis import MESES

POR_TABELA = 25


def le(spark: SparkSession, pasta: str, tabela: str) -> DataFrame:
    return spark.read.parquet(f"{pasta}/{tabela}.parquet")


def codigo_de(chave: Column) -> Column:
    """Equipment code of a number: even ones are transformers, odd ones feeders."""
    prefixo = F.when(chave % 2 == 0, "TR-").otherwise("F")
    return F.concat(prefixo, F.lpad(chave.cast("string"), 9, "0"))


def _regiao(chave: Column) -> Column:
    return F.floor(chave / POR_TABELA)


def _tabela(chave: Column, marca: Column) -> Column:
    numero = F.lpad(_regiao(chave).cast("string"), 9, "0")
    return F.concat(F.lit("regiao_"), numero, F.lit("_"), F.lower(marca))


def _tabela_ordem(chave: Column, marca: Column) -> Column:
    lugar = F.when(marca == "A", 0).when(marca == "N", 1).otherwise(2)
    return (_regiao(chave) * 3 + lugar).cast("int")


def _instante(data: Column, peca: Column, linha: Column) -> Column:
    """48 hours spread over the year of the date, at minutes given by the line number."""
    ano = F.trunc(F.to_date(data), "year").cast("timestamp_ntz")
    return ano + F.make_dt_interval(F.lit(0), (peca % 48 * 181).cast("int"), linha * 7)


def amostras(spark: SparkSession, pasta: str) -> DataFrame:
    """Sub-hour samples of every equipment, from all of ``lineitem``."""
    preco, imposto = F.col("l_extendedprice"), F.col("l_tax")
    chave, marca = F.col("l_suppkey"), F.col("l_returnflag")
    return le(spark, pasta, "lineitem").select(
        chave.alias("equip"),
        marca.alias("marca"),
        _instante(F.col("l_shipdate"), F.col("l_partkey"), F.col("l_linenumber")).alias("instante"),
        F.floor(preco / 100).cast("double").alias("eae"),
        (F.col("l_quantity") * 10).alias("ear"),
        F.floor(preco * F.col("l_discount") / 10).cast("double").alias("ere"),
        F.when(imposto != 0, F.floor(preco * imposto / 10).cast("double")).alias("err"),
    )


def horario(spark: SparkSession, pasta: str) -> DataFrame:
    """Hourly sums per equipment and table."""
    return (
        amostras(spark, pasta)
        .groupBy("equip", "marca", trunca_hora(F.col("instante")).alias("data_hora"))
        .agg(*[F.sum(c).alias(c) for c in LUGARES])
        .select(
            "equip",
            codigo_de(F.col("equip")).alias("codigo"),
            _tabela(F.col("equip"), F.col("marca")).alias("tabela"),
            _tabela_ordem(F.col("equip"), F.col("marca")).alias("tabela_ordem"),
            "data_hora",
            *LUGARES,
        )
    )


def medicoes(spark: SparkSession, pasta: str) -> DataFrame:
    """Wide rows of the region tables; a region holds 25 equipments, so 100 channels."""
    por_lugar = F.map_from_entries(
        F.collect_list(
            F.struct(
                (F.col("equip") % POR_TABELA).cast("int").alias("k"),
                F.array(*LUGARES).alias("v"),
            )
        )
    )
    vazio = F.array(*[F.lit(None).cast("double")] * len(LUGARES))
    lugares = F.sequence(F.lit(0), F.lit(POR_TABELA - 1))
    return (
        horario(spark, pasta)
        .groupBy("tabela", "data_hora")
        .agg(por_lugar.alias("entradas"))
        .select("tabela", "data_hora", calcula_uma_vez(F.col("entradas").alias("m")))
        .select(
            "tabela",
            "data_hora",
            F.flatten(
                F.transform(lugares, lambda k: F.coalesce(F.try_element_at("m", k), vazio))
            ).alias("valores"),
        )
    )


def presenca(spark: SparkSession, pasta: str) -> DataFrame:
    """Number of values in every place of the region tables, as a load would keep it."""
    contas = horario(spark, pasta).groupBy("tabela", "equip").agg(*[F.count(c).alias(c) for c in LUGARES])
    return (
        contas.select("tabela", "equip", F.posexplode(F.array(*LUGARES)).alias("lugar", "n"))
        .filter("n > 0")
        .select("tabela", (F.col("equip") % POR_TABELA * 4 + F.col("lugar")).cast("int").alias("pos"), "n")
    )


def catalogo(spark: SparkSession, pasta: str) -> DataFrame:
    """Columns of the region tables. Some lack an ERR column, some differ in case only, some equipments have none."""
    chave = F.col("s_suppkey")
    cols = (
        le(spark, pasta, "supplier")
        .filter(chave % 20 != 11)
        .select(chave, F.explode(F.array(*[F.lit(m) for m in "ANR"])).alias("marca"))
        .select(
            "*", F.posexplode(F.array(*[F.lit(s) for s in SUFIXOS])).alias("lugar", "sufixo")
        )
        .filter(~((F.col("marca") == "N") & (F.col("sufixo") == "ERR") & (chave % 10 == 4)))
    )
    nome = F.concat(F.lit("SE "), codigo_de(chave), F.lit("-"), F.col("sufixo"))
    descricao = F.when((F.col("marca") == "A") & (chave % 10 == 6), F.lower(nome)).otherwise(nome)
    return cols.select(
        _tabela(chave, F.col("marca")).alias("tabela"),
        _tabela_ordem(chave, F.col("marca")).alias("tabela_ordem"),
        (chave % POR_TABELA * 4 + F.col("lugar")).cast("int").alias("pos"),
        descricao.alias("descricao"),
        normaliza_nome(descricao).alias("descricao_norm"),
        F.lit("REAL").alias("tipo"),
    )


def equipamentos(spark: SparkSession, pasta: str) -> DataFrame:
    """Registry: every supplier, some registered twice, some of these without a code."""
    chave, vez = F.col("s_suppkey"), F.col("vez")
    saldo = F.abs("s_acctbal")
    return (
        le(spark, pasta, "supplier")
        .select(
            chave,
            "s_acctbal",
            F.explode(F.sequence(F.lit(0), F.when(chave % 7 == 0, 1).otherwise(0))).alias("vez"),
        )
        .select(
            (chave * 2 + vez).alias("id"),
            F.when((vez == 0) | (chave % 14 != 7), codigo_de(chave)).alias("codigo"),
            F.when(chave % 10 != 8, F.floor(saldo / F.when(vez == 0, 10).otherwise(5)).cast("double")).alias(
                "potencia_instalada"
            ),
        )
    )


def medidores(spark: SparkSession, pasta: str) -> DataFrame:
    """Meter dictionary of every supplier; some lack the ERR channel."""
    chave = F.col("s_suppkey")
    canal = F.concat(codigo_de(chave), F.lit("-"), F.col("sufixo"))
    return (
        le(spark, pasta, "supplier")
        .select(chave, F.explode(F.array(*[F.lit(s) for s in SUFIXOS])).alias("sufixo"))
        .filter(~((F.col("sufixo") == "ERR") & (chave % 10 == 9)))
        .select(canal.alias("codigo"), F.concat(F.lit("SE "), canal).alias("descricao"))
    )


def leituras_canal(spark: SparkSession, pasta: str) -> DataFrame:
    """Channel readings with exact duplicates and gaps, from all of ``events``."""
    # fixed values: channel of each event type; other types are not mapped
    canal = {"signup": "EAE", "purchase": "EAR", "click": "ERE", "error": "ERR"}
    tipos = F.create_map(*[F.lit(x) for par in canal.items() for x in par])
    semana = F.date_sub(F.to_date("ts"), F.weekday("ts")).cast("timestamp_ntz")
    return le(spark, pasta, "events").select(
        codigo_de(F.col("user_id")).alias("codigo"),
        F.try_element_at(tipos, F.col("event_type")).alias("canal"),
        (F.col("event_id") % 3).cast("int").alias("tabela"),
        (semana + F.make_dt_interval(F.lit(0), F.hour("ts") % 2)).alias("data_hora"),
        F.floor(F.col("value") / 10).cast("double").alias("valor"),
    )


def leituras_em_linha(spark: SparkSession, pasta: str) -> DataFrame:
    """``leituras_canal`` as rows of four channels, NULL where a channel has no reading."""
    return (
        leituras_canal(spark, pasta)
        .distinct()
        .filter(F.col("canal").isNotNull())
        .groupBy("codigo", "tabela", "data_hora")
        .agg(*[F.sum(F.when(F.col("canal") == l.upper(), F.col("valor"))).alias(l) for l in LUGARES])
    )


def maximas_mensais(spark: SparkSession, pasta: str) -> DataFrame:
    """Monthly report, wide, text cells, from all of ``orders``."""
    chave, mes = F.col("o_custkey"), F.month("o_orderdate")
    valor = F.floor(F.col("o_totalprice") / 1000)
    somas = (
        le(spark, pasta, "orders")
        .groupBy("o_custkey")
        .agg(*[F.max(F.when(mes == i, valor)).alias(f"m{i}") for i in range(1, 13)])
    )
    codigo = codigo_relatorio(codigo_de(chave))
    celulas = [
        (
            F.when((chave % 50 == 7) & F.lit(i == 3), "n/d").otherwise(F.col(f"m{i}").cast("string"))
        ).alias(f"{nome} kW")
        for i, nome in enumerate(MESES, 1)
    ]
    return somas.select(F.concat(F.lit("SE "), codigo).alias("descricao"), codigo.alias("codigo"), *celulas)


def mudancas(spark: SparkSession, pasta: str) -> DataFrame:
    """Registry changes as text, from all of ``customer``: two for most ids, some powers unreadable."""
    chave = F.col("c_custkey")
    potencia = F.floor(F.abs("c_acctbal")).cast("string")
    return le(spark, pasta, "customer").select(
        F.floor(chave / 2).alias("id"),
        chave.alias("ordem"),
        F.when(chave % 3 == 0, "U").when(chave % 3 == 1, "D").otherwise("X").alias("op"),
        F.concat(codigo_de(chave), F.lit("N")).alias("codigo"),
        F.when(chave % 13 == 11, "abc").when(chave % 11 == 3, "").otherwise(potencia).alias("potencia_instalada"),
    )


def edicoes(spark: SparkSession, pasta: str) -> DataFrame:
    """Ordered edits as text, from all of ``customer``: seven for most ids, of all kinds and in any order."""
    chave = F.col("c_custkey")
    potencia = F.floor(F.abs("c_acctbal")).cast("string")
    tipo = (chave * 5 + F.floor(chave / 7)) % 4
    return le(spark, pasta, "customer").select(
        F.floor(chave / 7).alias("id"),
        chave.alias("ordem"),
        F.when(tipo == 1, "D").when(tipo == 2, "I").otherwise("U").alias("op"),
        F.when(chave % 4 != 1, F.concat(codigo_de(chave), F.lit("N"))).alias("codigo"),
        F.when(chave % 13 == 11, "abc").when(chave % 11 == 3, "").when(chave % 5 != 2, potencia).alias("potencia_instalada"),
    )


def medidores_novos(spark: SparkSession, pasta: str) -> DataFrame:
    """Dictionary rows to insert, from all of ``customer``: repeated, known and NULL codes."""
    chave = F.col("c_custkey")
    codigo = F.concat(codigo_de(F.floor(chave / 2)), F.lit("-EAE"))
    return le(spark, pasta, "customer").select(
        F.when(chave % 10 != 5, codigo).alias("codigo"), F.col("c_name").alias("descricao"), chave.alias("ordem")
    )


# Header lines of the generated exports: accents, case, a hyphen, repeated and colliding names.
CABECALHO_F = "DATA/Hora;Linha São João-EAE;LINHA SAO JOAO-EAE;Trafo 1-EAR;Trafo 1-ERE"
CABECALHO_O = "DATA/Hora;linha sao-joão EAE;Trafo 1-EAR;Trafo 1-EAR;Trafo 2-ERR"
CABECALHO_SEM_TEMPO = "Data;Linha São João-EAE;Trafo 1-EAR;Trafo 1-ERE;Trafo 2-ERR"


def linhas_de_dois_formatos(spark: SparkSession, pasta: str) -> DataFrame:
    """The export lines, with the month before the day in the F files."""
    trocada = F.regexp_replace("linha", r"^(\d\d)/(\d\d)/", "$2/$1/")
    do_f = F.col("arquivo").endswith("F.txt")
    return linhas(spark, pasta).withColumn("linha", F.when(do_f, trocada).otherwise(F.col("linha")))


def linhas(spark: SparkSession, pasta: str) -> DataFrame:
    """Raw export lines, from all of ``lineitem``: footers, bad times, ragged and long rows."""
    peca, nr, qtd = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity")

    def inteiro(c: Column) -> Column:
        return F.floor(c).cast("string")

    tempo = F.date_format(_instante(F.col("l_shipdate"), peca, nr), "dd/MM/yyyy HH:mm")
    campo_0 = (
        F.when((nr == 5) & (peca % 7 == 0), "TOTAL")
        .when((nr == 6) & (peca % 11 == 0), "sem data")
        .when((nr == 6) & (peca % 11 == 1), "31/02/1997 10:00")
        .otherwise(tempo)
    )
    campo_1 = F.concat(
        inteiro(F.col("l_extendedprice") / 10000),
        F.lit(","),
        F.lpad((peca % 4 * 25).cast("string"), 2, "0"),
    )
    campo_2 = (
        F.when(F.col("l_tax") == 0, "")
        .when(nr == 7, " ")
        .when(nr == 6, "-")
        .when(nr == 4, "1.234,56")
        .otherwise(inteiro(qtd / 10))
    )
    campo_3 = F.concat(inteiro(F.col("l_discount") * 25), F.lit("e-1"))
    campo_4 = F.concat(F.lit(";"), inteiro(qtd / 25), F.lit(",5"))
    arquivo = F.concat(
        F.lit("Medicao (Regiao "),
        _regiao(F.col("l_suppkey")).cast("string"),
        F.lit("-"),
        F.col("l_returnflag"),
        F.lit(") "),
        F.col("l_linestatus"),
        F.lit(".txt"),
    )
    corpo = le(spark, pasta, "lineitem").select(
        arquivo.alias("arquivo"),
        arquivo.alias("membro"),
        (F.col("l_orderkey") * 10 + nr + 1).alias("nr_linha"),
        F.concat(
            F.concat_ws(";", campo_0, campo_1, campo_2, campo_3),
            F.when(nr == 7, "").otherwise(campo_4),
            F.when(nr == 3, ";x").otherwise(""),
        ).alias("linha"),
    )
    cabecalho = (
        F.when(F.col("arquivo").endswith("-N) O.txt"), CABECALHO_SEM_TEMPO)
        .when(F.col("arquivo").endswith("F.txt"), CABECALHO_F)
        .otherwise(CABECALHO_O)
    )
    primeiras = (
        corpo.select("arquivo", "membro")
        .distinct()
        .select("arquivo", "membro", F.lit(0).cast("bigint").alias("nr_linha"), cabecalho.alias("linha"))
    )
    return corpo.unionByName(primeiras)


def linhas_de_cabecalho(spark: SparkSession, pasta: str) -> DataFrame:
    """Header lines, from all of ``part``: names repeated exactly or up to accents and case.

    A file takes the parts of one type out of 100 successive ones, so a line stays short.
    """
    nome, tamanho = F.col("p_name"), F.col("p_size")
    coluna = (
        F.when(tamanho % 4 == 0, F.upper(nome))
        .when(tamanho % 4 == 1, F.replace(nome, F.lit("a"), F.lit("á")))
        .when(tamanho % 4 == 2, F.concat(F.replace(nome, F.lit(" "), F.lit("-")), F.lit(" ")))
        .otherwise(nome)
    )
    membro = F.concat(
        F.lit("Export ("),
        F.col("p_type"),
        F.lit(") "),
        F.lpad(F.floor(F.col("p_partkey") / 100).cast("string"), 9, "0"),
        F.lit(".txt"),
    )
    pares = F.struct("p_partkey", F.concat(coluna, F.when(tamanho % 5 == 0, " 2º").otherwise("")).alias("c"))
    nomes = F.transform(F.array_sort(F.collect_list(pares)), lambda par: par["c"])
    return (
        le(spark, pasta, "part")
        .groupBy(membro.alias("arquivo"))
        .agg(F.concat_ws(";", F.lit("DATA/Hora"), nomes).alias("linha"))
        .select("arquivo", F.col("arquivo").alias("membro"), F.lit(0).alias("nr_linha"), "linha")
    )


def cabecalhos(spark: SparkSession, pasta: str) -> DataFrame:
    return limpeza.cabecalhos(linhas_de_cabecalho(spark, pasta))


def colunas_entregues(spark: SparkSession, pasta: str) -> DataFrame:
    """Channels of the headers above, with the table of their file."""
    return limpeza.colunas_dos_arquivos(cabecalhos(spark, pasta))


def formulas(spark: SparkSession, pasta: str) -> DataFrame:
    """Composition requests over every supplier, three slots each."""
    chave = F.col("s_suppkey")
    return le(spark, pasta, "supplier").select(
        F.floor(chave / 3).alias("formula"),
        (chave % 3 + 1).cast("int").alias("ordem"),
        codigo_de(chave).alias("codigo"),
        F.when(chave % 2 == 0, "Subtrair").otherwise("Somar").alias("operador"),
    )

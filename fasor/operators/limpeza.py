"""Cleaning of raw export lines.

Input ``linhas(arquivo, membro, nr_linha, linha)``: ``arquivo`` identifies one text file and sorts
in load order, ``membro`` is its name inside the ZIP, line 0 is the header.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fasor.functions.estrutura import calcula_uma_vez
from fasor.functions.numero import arredonda, numeros_br
from fasor.functions.tempo import FORMATO_PADRAO, le_data_hora, trunca_hora
from fasor.functions.texto import nome_tabela, normaliza_nome, padroniza_coluna_tempo
from fasor.operators.juncao import junta
from fasor.operators.materializa import materializa

COLUNA_TEMPO = "DATA/Hora"
RODAPE = "TOTAL"


def campos(linha: Column) -> Column:
    """Fields of a line. The format has no quoting, so a plain split is the parser."""
    return F.split(linha, ";", -1)


def cabecalhos(linhas: DataFrame) -> DataFrame:
    """One row per file: ``(arquivo, membro, campos, pos_tempo)``.

    ``pos_tempo`` is the first place of the time column, NULL where the header lacks it. A header
    is one line, so all work on its names stays inside the row.
    """
    nomes = campos(F.col("linha"))
    lugar = F.nullif(F.array_position(nomes, F.lit(COLUNA_TEMPO)), F.lit(0)) - 1
    return linhas.filter(F.col("nr_linha") == 0).select(
        "arquivo", "membro", nomes.alias("campos"), lugar.cast("int").alias("pos_tempo")
    )


def arquivos_validos(cab: DataFrame) -> DataFrame:
    """Files whose header has the time column."""
    return cab.filter(F.col("pos_tempo").isNotNull())


def sem_repetidas(cab: DataFrame) -> DataFrame:
    """Channels of each file, repeated names read once, at their first place.

    ``(arquivo, membro, pos_tempo, largura, nomes array<string>, posicoes array<int>)``
    """
    nomes = F.array_except("campos", F.array(F.lit(COLUNA_TEMPO)))
    posicoes = F.transform(
        nomes, lambda nome: (F.array_position(F.col("campos"), nome) - 1).cast("int")
    )
    return cab.select(
        "arquivo",
        "membro",
        "pos_tempo",
        F.size("campos").alias("largura"),
        nomes.alias("nomes"),
        posicoes.alias("posicoes"),
    )


def canais_por_arquivo(cab: DataFrame) -> DataFrame:
    """Where to read each valid file: ``(arquivo, pos_tempo, posicoes)``."""
    return sem_repetidas(arquivos_validos(cab)).select("arquivo", "pos_tempo", "posicoes")


def colunas_dos_arquivos(cab: DataFrame) -> DataFrame:
    """Channels a valid file delivers: ``(arquivo, tabela, indice, descricao, descricao_norm)``.

    ``indice`` is the place of the channel in the values of ``leituras``. Of the names that are
    equal after normalisation the first stays; a channel that normalises like the time column is
    hidden by it.
    """
    nomes = (
        sem_repetidas(arquivos_validos(cab))
        .select("arquivo", "membro", F.posexplode("nomes").alias("indice", "nome"))
        .withColumn("descricao_norm", normaliza_nome(F.col("nome")))
        .filter(F.col("descricao_norm") != "datahora")
    )
    return (
        nomes.groupBy("arquivo", "membro", "descricao_norm")
        .agg(F.min(F.struct("indice", "nome")).alias("primeira"))
        .select(
            "arquivo",
            nome_tabela(F.col("membro")).alias("tabela"),
            "primeira.indice",
            padroniza_coluna_tempo(F.col("primeira.nome")).alias("descricao"),
            "descricao_norm",
        )
    )


def colunas_omitidas(cab: DataFrame) -> DataFrame:
    """Header names of valid files that give no channel: ``(arquivo, pos, coluna, motivo)``.

    ``nome_repetido``: the same name stands before; ``nome_equivalente``: one that is equal after normalisation does;
    ``coluna_de_tempo``: the name normalises like the time column, which hides it.
    """
    nomes = (
        arquivos_validos(cab)
        .select("arquivo", F.posexplode("campos").alias("pos", "coluna"))
        .filter(F.col("coluna") != COLUNA_TEMPO)
        .withColumn("norma", normaliza_nome(F.col("coluna")))
    )
    # a header is one line, so these groups are small
    primeiro_nome = F.min("pos").over(Window.partitionBy("arquivo", "coluna"))
    primeira_norma = F.min("pos").over(Window.partitionBy("arquivo", "norma"))
    motivo = (
        F.when(F.col("pos") != F.col("_nome"), "nome_repetido")
        .when(F.col("norma") == "datahora", "coluna_de_tempo")
        .when(F.col("pos") != F.col("_norma"), "nome_equivalente")
    )
    return (
        nomes.withColumns({"_nome": primeiro_nome, "_norma": primeira_norma})
        .select("arquivo", "pos", "coluna", motivo.alias("motivo"))
        .filter(F.col("motivo").isNotNull())
    )


def formatos_dos_arquivos(linhas: DataFrame, cab: DataFrame, formatos: Sequence[str]) -> DataFrame:
    """The one format in which all times of a file are read: ``(arquivo, formato, lidas, ambiguo)``.

    Every format is tried on every line of the file; the one that reads most of them counts, of equal ones the first.
    ``ambiguo`` tells that another format reads as many lines, but some to another time. Counts per file combine
    map-side, so a file of any size is spread.
    """
    corpo = linhas.filter("nr_linha > 0").select("arquivo", "nr_linha", "linha")
    com_tempo = junta(corpo, arquivos_validos(cab).select("arquivo", "pos_tempo"), ["arquivo"], espalhar_por=["nr_linha"])
    texto = F.get(campos(F.col("linha")), F.col("pos_tempo"))
    lidos = calcula_uma_vez(*[le_data_hora(texto, f).alias(f"_{i}") for i, f in enumerate(formatos)])
    n = range(len(formatos))
    contas = (
        com_tempo.select("arquivo", lidos)
        .groupBy("arquivo")
        .agg(
            *[F.count(f"_{i}").alias(f"n_{i}") for i in n],
            *[F.count_if(F.col(f"_{i}") != F.col(f"_{j}")).alias(f"d_{i}_{j}") for i in n for j in n if i < j],
        )
    )
    melhor = F.greatest(*[F.col(f"n_{i}") for i in n], F.lit(-1))
    escolhido = F.coalesce(*[F.when(F.col(f"n_{i}") == melhor, i) for i in n])
    diferem = [
        (F.col("formato") == i) & (F.col(f"n_{j}") == F.col("lidas")) & (F.col(f"d_{min(i, j)}_{max(i, j)}") > 0)
        for i in n for j in n if i != j
    ]
    return contas.withColumns({"formato": escolhido, "lidas": melhor}).select(
        "arquivo", "formato", "lidas", reduce(Column.__or__, diferem, F.lit(False)).alias("ambiguo")
    )


def _instante(texto: Column, formatos: Sequence[str]) -> Column:
    """The time in the format of the file, whose number is in the column ``formato``."""
    if len(formatos) == 1:
        return le_data_hora(texto, formatos[0])
    return F.coalesce(*[F.when(F.col("formato") == i, le_data_hora(texto, f)) for i, f in enumerate(formatos)])


def _lista(formatos: str | Sequence[str]) -> list[str]:
    return [formatos] if isinstance(formatos, str) else list(formatos)


def examina(
    linhas: DataFrame, cab: DataFrame, formatos: str | Sequence[str] = FORMATO_PADRAO, escolhidos: DataFrame | None = None
) -> DataFrame:
    """Every body line, read once: what it says, and whether it counts. Of several formats each file is read in one,
    which ``escolhidos`` names (``formatos_dos_arquivos``; if it is not given, it is found here).

    ``(arquivo, nr_linha, linha, valido, rodape, extra, texto_tempo, instante, numeros, posicoes)``. The data are the
    lines that are ``valido`` and not ``rodape``; ``linha`` stays only where the time cannot be read.
    """
    formatos = _lista(formatos)
    onde = sem_repetidas(cab).select("arquivo", "pos_tempo", "largura", "posicoes")
    if len(formatos) > 1:
        escolhidos = formatos_dos_arquivos(linhas, cab, formatos) if escolhidos is None else escolhidos
        onde = onde.join(escolhidos.select("arquivo", "formato"), "arquivo", "left")
    corpo = linhas.filter(F.col("nr_linha") > 0).select("arquivo", "nr_linha", "linha")
    partes = campos(F.col("linha"))
    lidos = calcula_uma_vez(
        F.size(partes).alias("n_campos"),
        F.get(partes, F.col("pos_tempo")).alias("texto_tempo"),
        _instante(F.get(partes, F.col("pos_tempo")), formatos).alias("instante"),
        numeros_br(F.col("linha")).alias("numeros"),
    )
    valido = F.col("pos_tempo").isNotNull()
    return junta(corpo, onde, ["arquivo"], "left", espalhar_por=["nr_linha"]).select(
        "arquivo", "nr_linha", "linha", "pos_tempo", "largura", "posicoes", lidos
    ).select(
        "arquivo",
        "nr_linha",
        F.when(F.col("instante").isNull(), F.col("linha")).alias("linha"),
        valido.alias("valido"),
        (valido & F.col("texto_tempo").eqNullSafe(F.lit(RODAPE))).alias("rodape"),
        (valido & (F.col("n_campos") > F.col("largura"))).alias("extra"),
        "texto_tempo",
        "instante",
        "numeros",
        "posicoes",
    )


def interpreta(
    linhas: DataFrame, canais: DataFrame, formatos: str | Sequence[str] = FORMATO_PADRAO
) -> DataFrame:
    """Body lines of the valid files, without footers, with the parsed time.

    ``instante`` is NULL where the time text cannot be read (see ``rejeitados``). Of several formats each file is read
    in one; ``canais`` then has its number in ``formato``.
    """
    formatos = _lista(formatos)
    corpo = linhas.filter(F.col("nr_linha") > 0).select("arquivo", "nr_linha", "linha")
    partes = junta(corpo, canais, ["arquivo"], espalhar_por=["nr_linha"])
    texto = F.get(campos(F.col("linha")), F.col("pos_tempo"))
    lidos = calcula_uma_vez(
        texto.alias("texto_tempo"),
        _instante(texto, formatos).alias("instante"),
        numeros_br(F.col("linha")).alias("numeros"),
    )
    return partes.select("arquivo", "nr_linha", "linha", "posicoes", lidos).filter(
        ~F.col("texto_tempo").eqNullSafe(F.lit(RODAPE))
    )


def rejeitados(interpretadas: DataFrame) -> DataFrame:
    """Lines left out because their time cannot be read."""
    return interpretadas.filter(F.col("instante").isNull()).select(
        "arquivo", "nr_linha", "texto_tempo", "linha"
    )


def leituras(interpretadas: DataFrame) -> DataFrame:
    """Readable lines as ``(arquivo, instante, data_hora, valores array<double>)``."""
    valores = F.transform(
        "posicoes", lambda p: F.coalesce(F.get("numeros", p), F.lit(0.0))
    )
    return interpretadas.filter(F.col("instante").isNotNull()).select(
        "arquivo", "instante", trunca_hora(F.col("instante")).alias("data_hora"), valores.alias("valores")
    )


#: A file's hour of more lines than this is dealt to several tasks.
LINHAS_POR_PARTE = 200_000
#: Lines that a task takes to sum hours.
LINHAS_POR_TAREFA = 200_000


def _reparte(df: DataFrame, n: int, chave: Sequence[str]) -> DataFrame:
    """Deal rows by key to tasks that grow in number with the ``n`` lines, so that the rows of one do not."""
    if n <= LINHAS_POR_TAREFA:
        return df.repartition(*chave)
    paralelas = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(-(-n // LINHAS_POR_TAREFA), paralelas), *chave)


def _por_hora(lidas: DataFrame, limite: int, linhas: DataFrame | None = None) -> list[tuple[DataFrame, list[str]]]:
    """Lines dealt once so that all later steps find them together: by file and hour, and hours of very many lines
    also by the hash of their values, which equal lines share. With each part the columns it is dealt by besides.

    Only files of more than ``limite`` lines can have such an hour. ``linhas``, the raw lines, tells which these are
    without reading a time or a number, so where there are none nothing is parsed for the count. The number of all lines
    sets the number of tasks (see ``_reparte``).
    """
    hora = ["arquivo", "data_hora"]
    contadas = lidas
    total = None
    if linhas is not None:
        por_arquivo = materializa(linhas.groupBy("arquivo").agg(F.count(F.lit(1)).alias("n")))
        total = por_arquivo.agg(F.sum("n")).first()[0] or 0
        grandes = por_arquivo.filter(F.col("n") > limite).select("arquivo")
        if grandes.isEmpty():
            return [(_reparte(lidas, total, hora), [])]
        contadas = junta(lidas, grandes, ["arquivo"], "left_semi")
    por_hora = contadas.groupBy(*hora).agg(F.count(F.lit(1)).alias("n"))
    if total is None:
        por_hora = materializa(por_hora)
        total = por_hora.agg(F.sum("n")).first()[0] or 0
    quentes = materializa(
        por_hora.filter(F.col("n") > limite).select(*hora, "n", F.ceil(F.col("n") / F.lit(limite)).alias("_partes"))
    )
    if quentes.isEmpty():
        return [(_reparte(lidas, total, hora), [])]
    nas_quentes = quentes.agg(F.sum("n")).first()[0]
    quentes = quentes.drop("n")
    frias = junta(lidas, quentes.select(*hora), hora, "left_anti", ["valores"])
    parte = F.pmod(F.xxhash64("valores"), F.col("_partes"))
    partidas = junta(lidas, quentes, hora, espalhar_por=["valores"]).withColumn("_parte", parte).drop("_partes")
    return [
        (_reparte(frias, total - nas_quentes, hora), []),
        (_reparte(partidas, nas_quentes, [*hora, "_parte"]), ["_parte"]),
    ]


def _unicas(lidas: DataFrame, por: str, parte: Sequence[str]) -> DataFrame:
    chave = {"hora": "data_hora", "carimbo": "instante"}[por]
    return lidas.dropDuplicates(list(dict.fromkeys(["arquivo", "data_hora", *parte, chave, "valores"]))).select(
        "arquivo", "data_hora", "valores"
    )


def _uniao(partes: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, partes)


def sem_duplicatas(
    lidas: DataFrame, por: str = "hora", limite: int = LINHAS_POR_PARTE, linhas: DataFrame | None = None
) -> DataFrame:
    """Exact duplicates count once. ``linhas``: see ``_por_hora``.

    ``por='hora'`` compares after the floor to the hour, so equal samples of one hour collapse;
    ``por='carimbo'`` compares the original time stamps.
    """
    return _uniao([_unicas(df, por, parte) for df, parte in _por_hora(lidas, limite, linhas)])


def horas_largas(
    lidas: DataFrame, por: str = "hora", limite: int = LINHAS_POR_PARTE, linhas: DataFrame | None = None
) -> DataFrame:
    """Hourly sums without duplicates, one row per file and hour: ``(arquivo, data_hora, valores)``.

    The lines move once, by file and hour; removing duplicates, summing the cells and putting them back into a row all
    find them there. ``linhas``: see ``_por_hora``.
    """
    partes = _por_hora(lidas, limite, linhas)
    return _uniao([linhas_largas(soma_horaria(_unicas(df, por, parte))) for df, parte in partes])


def soma_horaria(lidas: DataFrame) -> DataFrame:
    """Hourly sum of every channel: ``(arquivo, data_hora, indice, valor)``, combined map-side."""
    celulas = lidas.select(
        "arquivo", "data_hora", F.posexplode("valores").alias("indice", "valor")
    )
    return celulas.groupBy("arquivo", "data_hora", "indice").agg(
        arredonda(F.sum("valor"), 2).alias("valor")
    )


def linhas_largas(celulas: DataFrame) -> DataFrame:
    """Cells back to one row per hour; a group holds the width of one export line."""
    return celulas.groupBy("arquivo", "data_hora").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("indice", "valor"))), lambda c: c["valor"]
        ).alias("valores")
    )


def marcas(linhas: DataFrame) -> DataFrame:
    """What the reader marked as giving no line: ``(arquivo, marca)``; other sources of lines may have no marks."""
    marca = F.col("situacao") if "situacao" in linhas.columns else F.lit(None).cast("string")
    return linhas.filter(F.col("nr_linha") < 0).select("arquivo", marca.alias("marca"))


def auditoria(examinadas: DataFrame, cab: DataFrame, marcas: DataFrame) -> DataFrame:
    """One row per file: what was read, what was left out, and why. One grouped count of ``examina``."""
    valida = F.col("valido") & ~F.col("rodape")
    somas = examinadas.groupBy("arquivo").agg(
        F.max("valido").alias("valido"),
        F.count(F.lit(1)).alias("linhas"),
        F.sum(F.col("rodape").cast("bigint")).alias("rodapes"),
        F.sum((valida & F.col("instante").isNull()).cast("bigint")).alias("rejeitadas"),
        F.sum(F.col("extra").cast("bigint")).alias("linhas_com_campo_extra"),
        F.countDistinct(F.when(valida, trunca_hora(F.col("instante")))).alias("horas"),
    )
    # files of a header and nothing else, or of a mark and nothing else, appear only here
    outros = cab.select("arquivo", F.col("pos_tempo").isNotNull().alias("valido")).unionByName(
        marcas.select("arquivo", F.lit(False).alias("valido"))
    )
    zeros = [F.lit(0).cast("bigint").alias(c) for c in somas.columns[2:]]
    so_cabecalho = outros.join(somas, "arquivo", "left_anti").select("arquivo", "valido", *zeros)
    situacao = (
        F.when(F.col("marca").isNotNull(), F.col("marca"))
        .when(~F.col("valido"), "sem_coluna_de_tempo")
        .when(F.col("horas") == 0, "sem_dado_valido")
        .otherwise("ok")
    )
    return (
        somas.unionByName(so_cabecalho)
        .join(marcas, "arquivo", "left")
        .withColumn("situacao", situacao)
        .drop("valido", "marca")
    )

"""Equipment registry and meter dictionary.

``equipamentos(id, codigo, potencia_instalada, ...)``; ``medidores(codigo, descricao)`` where
``codigo`` is ``<equipment>-<channel>`` and ``descricao`` names a measurement column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fasor.functions.texto import SUFIXOS
from fasor.operators.juncao import junta, junta_grandes
from fasor.operators.materializa import materializa

LUGARES = ("eae", "ear", "ere", "err")


def sem_chave_nula(cadastro: DataFrame, chave: str, exige: Sequence[str] = ()) -> DataFrame:
    """Rows with a key, after checking that the required columns are there."""
    faltam = [c for c in (chave, *exige) if c not in cadastro.columns]
    if faltam:
        raise ValueError(f"columns missing in the registry: {faltam}")
    return cadastro.dropna(subset=[chave])


def amostra(cadastro: DataFrame, chave: str = "id") -> DataFrame:
    """The first row by key."""
    return cadastro.orderBy(chave).limit(1)


def codigos(equipamentos: DataFrame) -> DataFrame:
    """Every code, repeats and NULLs included."""
    return equipamentos.select("codigo")


def codigos_distintos(equipamentos: DataFrame) -> DataFrame:
    return equipamentos.select("codigo").dropna().distinct()


def potencia_instalada(equipamentos: DataFrame) -> DataFrame:
    """Installed power per code: the first registration (lowest id) decides, even with NULL."""
    return (
        equipamentos.filter(F.col("codigo").isNotNull())
        .groupBy("codigo")
        .agg(F.min_by("potencia_instalada", "id").alias("potencia_instalada"))
    )


def canais(codigos: DataFrame) -> DataFrame:
    """The four channel codes of each equipment: ``(codigo, sufixo, canal)``."""
    sufixos = F.array(*[F.lit(s) for s in SUFIXOS])
    return codigos.select("codigo", F.explode(sufixos).alias("sufixo")).withColumn(
        "canal", F.concat_ws("-", "codigo", "sufixo")
    )


def resolve_canais(codigos: DataFrame, medidores: DataFrame) -> DataFrame:
    """Measurement column of each channel: ``(codigo, eae, ear, ere, err)``, NULL when unknown."""
    dicionario = medidores.select(F.col("codigo").alias("canal"), "descricao")
    achados = junta_grandes(canais(codigos), dicionario, ["canal"], "left")
    return achados.groupBy("codigo").agg(
        *[
            F.min(F.when(F.col("sufixo") == s, F.col("descricao"))).alias(lugar)
            for s, lugar in zip(SUFIXOS, LUGARES)
        ]
    )


def completos(resolvidos: DataFrame) -> DataFrame:
    """Strict lookup: only equipments with all four channels."""
    return resolvidos.dropna(subset=list(LUGARES))


def incompletos(resolvidos: DataFrame) -> DataFrame:
    """Equipments the strict lookup leaves out, with the number of channels they lack."""
    faltam = sum((F.col(c).isNull().cast("int") for c in LUGARES), F.lit(0))
    return resolvidos.select("codigo", faltam.alias("canais_faltantes")).filter(
        F.col("canais_faltantes") > 0
    )


def insere_ou_ignora(dicionario: DataFrame, novos: DataFrame, ordem: str) -> DataFrame:
    """Add dictionary rows: known keys stay, the first of repeated new keys (by ``ordem``) wins."""
    outras = [c for c in dicionario.columns if c != "codigo"]
    primeiros = (
        novos.dropna(subset=["codigo"])
        .groupBy("codigo")
        .agg(F.min_by(F.struct(*outras), ordem).alias("linha"))
        .select("codigo", "linha.*")
    )
    return dicionario.unionByName(primeiros.join(dicionario, "codigo", "left_anti"))


def _ultimas(mudancas: DataFrame, ordem: str | None) -> DataFrame:
    """The last change of each id; without an order column, the one whose text sorts last."""
    if ordem is None:
        colunas = [c for c in mudancas.columns if c != "id"]
        return mudancas.groupBy("id").agg(F.max(F.struct(*colunas)).alias("m")).select("id", "m.*")
    outras = [c for c in mudancas.columns if c not in ("id", ordem)]
    return mudancas.groupBy("id").agg(F.max_by(F.struct(*outras), ordem).alias("m")).select("id", "m.*")


def _lidas(cadastro: DataFrame, mudancas: DataFrame, operacao: str, ordem: str | None) -> tuple[DataFrame, dict]:
    tipos = {c.name: c.dataType for c in cadastro.schema.fields if c.name != "id"}
    editaveis = {c: t for c, t in tipos.items() if c in mudancas.columns}
    pedidas = mudancas.filter(F.col("op") == operacao).select("id", *editaveis, *([ordem] if ordem else []))
    ultimas = _ultimas(pedidas, ordem)
    for c, t in editaveis.items():
        ultimas = ultimas.withColumn(f"_{c}", F.nullif(F.col(c), F.lit("")).try_cast(t))
    return ultimas, editaveis


def atualiza(cadastro: DataFrame, mudancas: DataFrame, operacao: str = "U", ordem: str | None = None) -> DataFrame:
    """Replace the non-id columns of the rows named by the changes marked ``operacao``.

    Changes come as text and are cast to the registry types; empty text becomes NULL, and text that cannot be read
    leaves the value as it is (see ``mudancas_ilegiveis``). Of several changes of one id the last by ``ordem`` counts.
    """
    ultimas, editaveis = _lidas(cadastro, mudancas, operacao, ordem)
    pedidas = ultimas.select("id", F.lit(True).alias("_muda"), *[F.col(c).alias(f"_t_{c}") for c in editaveis], *[f"_{c}" for c in editaveis])

    def valor(c: str):
        if c not in editaveis:
            return F.col(c)
        ilegivel = F.col(f"_{c}").isNull() & (F.coalesce(f"_t_{c}", F.lit("")) != "")
        return F.when(F.col("_muda") & ~ilegivel, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)

    return cadastro.join(pedidas, "id", "left").select("id", *[valor(c) for c in cadastro.columns if c != "id"])


def mudancas_ilegiveis(
    cadastro: DataFrame, mudancas: DataFrame, operacao: str = "U", ordem: str | None = None
) -> DataFrame:
    """Values of counting changes that cannot be read in the registry's type: ``(id, coluna, texto)``."""
    ultimas, editaveis = _lidas(cadastro, mudancas, operacao, ordem)
    pares = F.array(
        *[
            F.when(
                F.col(f"_{c}").isNull() & (F.coalesce(c, F.lit("")) != ""),
                F.struct(F.lit(c).alias("coluna"), F.col(c).alias("texto")),
            )
            for c in editaveis
        ]
    )
    conhecidos = cadastro.select("id")
    return (
        ultimas.join(conhecidos, "id", "left_semi")
        .select("id", F.explode(F.filter(pares, lambda x: x.isNotNull())).alias("par"))
        .select("id", "par.coluna", "par.texto")
    )


def exclui(cadastro: DataFrame, mudancas: DataFrame, operacao: str = "D") -> DataFrame:
    """Registry without the ids of the changes marked ``operacao``."""
    ids = mudancas.filter(F.col("op") == operacao).select("id")
    return cadastro.join(ids, "id", "left_anti")


def _escritas(cadastro: DataFrame, edicoes: DataFrame, ordem: str) -> tuple[DataFrame, DataFrame]:
    """What counts of ordered edits: the ids that live in the end, with the order of the insertion they live from (NULL:
    from the registry), and the insertions and updates since then, read in the registry's types.
    """
    edicoes = edicoes.filter("id IS NOT NULL")
    apagados = materializa(edicoes.filter("op = 'D'").groupBy("id").agg(F.max(ordem).alias("_apagado")))
    vivas = junta(edicoes.filter("op IN ('I', 'U')"), apagados, ["id"], "left", espalhar_por=[ordem]).filter(
        F.col("_apagado").isNull() | (F.col(ordem) > F.col("_apagado"))
    )
    nascidos = vivas.filter("op = 'I'").groupBy("id").agg(F.min(ordem).alias("_nasceu"))
    do_cadastro = cadastro.select("id").join(apagados, "id", "left_anti").withColumn("_antigo", F.lit(True))
    vidas = materializa(
        do_cadastro.join(nascidos, "id", "full").select("id", F.when(F.col("_antigo").isNull(), F.col("_nasceu")).alias("_desde"))
    )
    contam = junta(vivas.drop("_apagado"), vidas, ["id"], espalhar_por=[ordem]).filter(
        F.when(F.col("op") == "I", F.col(ordem) == F.col("_desde")).otherwise(
            F.col("_desde").isNull() | (F.col(ordem) > F.col("_desde"))
        )
    )
    for campo in cadastro.schema.fields:
        if campo.name != "id" and campo.name in edicoes.columns:
            contam = contam.withColumn(f"_{campo.name}", F.nullif(F.col(campo.name), F.lit("")).try_cast(campo.dataType))
    return vidas, contam


def aplica(cadastro: DataFrame, edicoes: DataFrame, ordem: str = "ordem") -> DataFrame:
    """The registry after edits in their order: ``(id, op, <ordem>, columns as text)``.

    ``I`` inserts a row where the id has none, ``U`` changes the columns that carry text, ``D`` deletes. Empty text
    becomes NULL, NULL text leaves the value; of several values of a column the last one that can be read counts (see
    ``edicoes_ilegiveis``). The orders of one id differ. Only the last deletion, the first insertion after it and the
    last writings since then matter, so an id of any number of edits combines map-side.
    """
    vidas, contam = _escritas(cadastro, edicoes, ordem)
    editadas = [c for c in cadastro.columns if c != "id" and c in edicoes.columns]

    def ultima(c: str):
        escreve = (F.col("op") == "I") | (F.col(c) == "") | F.col(f"_{c}").isNotNull()
        return F.max_by(F.struct(F.col(f"_{c}").alias("v")), F.when(escreve, F.col(ordem))).alias(f"_u_{c}")

    if not editadas:
        return vidas.join(cadastro, "id", "left").select(*cadastro.columns)
    escritas = contam.groupBy("id").agg(*[ultima(c) for c in editadas])
    antigas = cadastro.select("id", *[F.col(c).alias(f"_a_{c}") for c in cadastro.columns if c != "id"])
    juntas = vidas.join(antigas, "id", "left").join(escritas, "id", "left")
    do_cadastro = F.col("_desde").isNull()

    def valor(c: str):
        antigo = F.when(do_cadastro, F.col(f"_a_{c}"))
        if c not in editadas:
            return antigo.alias(c)
        return F.when(F.col(f"_u_{c}").isNotNull(), F.col(f"_u_{c}.v")).otherwise(antigo).alias(c)

    return juntas.select(*["id" if c == "id" else valor(c) for c in cadastro.columns])


def edicoes_ilegiveis(cadastro: DataFrame, edicoes: DataFrame, ordem: str = "ordem") -> DataFrame:
    """Values of counting edits that cannot be read in the registry's type: ``(id, <ordem>, coluna, texto)``."""
    _, contam = _escritas(cadastro, edicoes, ordem)
    pares = [
        F.when(F.col(f"_{c}").isNull() & (F.col(c) != ""), F.struct(F.lit(c).alias("coluna"), F.col(c).alias("texto")))
        for c in cadastro.columns
        if c != "id" and c in edicoes.columns
    ]
    return (
        contam.select("id", ordem, F.explode(F.filter(F.array(*pares), lambda x: x.isNotNull())).alias("par"))
        .select("id", ordem, "par.coluna", "par.texto")
    )

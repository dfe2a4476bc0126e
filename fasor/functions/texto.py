"""Names of tables, columns and equipments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SUFIXOS = ("EAE", "EAR", "ERE", "ERR")

# Transliteration of the latin-1 letters and signs to ASCII.
# One character each:
LATINOS = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿðªº¹²³µ×"
ASCII = "aaaaaaceeeeiiiinoooooouuuuyydao123ux"
# More than one character, or a capital letter in the result:
LATINOS_LONGOS = {
    "æ": "ae",
    "ß": "ss",
    "þ": "th",
    "°": "deg",
    "¼": "14",
    "½": "12",
    "¾": "34",
    "©": "c",
    "®": "r",
    "¢": "C",
    "£": "PS",
    "¥": "Y",
    "§": "SS",
    "¶": "P",
}


def normaliza_nome(nome: Column) -> Column:
    """Key under which two column names count as the same: no accents, case, blanks or signs."""
    chave = F.translate(F.lower(F.trim(nome)), LATINOS, ASCII)
    for letra, troca in LATINOS_LONGOS.items():
        chave = F.replace(chave, F.lit(letra), F.lit(troca))
    return F.regexp_replace(chave, "[^a-zA-Z0-9]", "")


def padroniza_coluna_tempo(nome: Column) -> Column:
    """Spellings of the time column become ``Data_Hora``; other names stay."""
    e_tempo = F.upper(F.trim(nome)).isin("DATA_HORA", "DATA/HORA", "DATA-HORA")
    return F.when(e_tempo, F.lit("Data_Hora")).otherwise(nome)


def nome_tabela(arquivo: Column) -> Column:
    """Measurement table of an export: first bracketed text of its name, else its base name."""
    entre_parenteses = F.nullif(F.regexp_extract(arquivo, r"\(([^)]+)\)", 1), F.lit(""))
    sem_extensao = F.regexp_extract(arquivo, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.translate(F.lower(F.coalesce(entre_parenteses, sem_extensao)), " -", "__")


def codigo_relatorio(codigo: Column) -> Column:
    """Code used by the monthly report: feeders carry the prefix ``AL-``, transformers none."""
    return F.when(codigo.contains("TR"), codigo).otherwise(F.concat(F.lit("AL-"), codigo))


def nome_equipamento(descricao: Column) -> Column:
    """Display name of an equipment, from the name of its EAE column."""
    return F.replace(descricao, F.lit("-EAE"), F.lit(""))

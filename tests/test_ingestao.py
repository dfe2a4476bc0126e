"""Files: ZIP reader, load, upsert over several loads, sinks, continuous load."""

import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fasor.operators import blocos, carga
from fasor.plans import ingestao
from fasor.plans.ingestao import carrega_linhas, carrega_pasta
from fasor.sources import publicacao, tabelas, zips
from fasor.streaming.carga_continua import inicia_carga


def grava_zip(caminho, **membros):
    with zipfile.ZipFile(caminho, "w") as z:
        for nome, texto in membros.items():
            z.writestr(nome, texto.encode("latin-1"))


LAGO = "x (Lago - Norte).txt"
A = "\n".join(
    [
        "DATA/Hora;SE São-EAE;SE São-EAR",
        "01/02/2024 00:00;1,5;10",
        "01/02/2024 00:15;1,5;10",  # equal sample of the same hour: counts once
        "01/02/2024 00:30;2,25; ",
        "01/02/2024 01:00;1.234,56;",
        "01/02/2024 01:15;;7,005;sobra",
        "01/02/2024 02:00;4",
        "TOTAL;99;99",
    ]
)
B = "\n".join(["DATA/Hora;SE SAO EAE;SE Sao-ERE", "01/02/2024 01:30;8;9", "01/03/2024 00:00;5;6", ""])


@pytest.fixture
def pasta(tmp_path):
    entrada = tmp_path / "entrada"
    entrada.mkdir()
    grava_zip(entrada / "a.zip", **{LAGO: A, "sem parenteses-01.txt": "DATA/Hora;C\n01/02/2024 05:59;3"})
    grava_zip(entrada / "c.zip", **{"vazio.txt": "", "sem_data.txt": "Data;C\n01/02/2024 00:00;1"})
    grava_zip(
        entrada / "d.zip",
        **{"ruim (Ruim).txt": "DATA/Hora;C;C\n\n31/02/2024 10:00;1;2\n01/02/2024 24:00;1;2\n01/02/2024 07:00;1;2"},
    )
    grava_zip(entrada / "e.ZIP", **{"e (Nao).txt": A})
    grava_zip(entrada / "f.zip", **{"leia.md": "nada"})
    (entrada / "g.zip").write_bytes(b"isto nao e um zip")
    # a flipped byte in the first member, a good second one
    grava_zip(entrada / "i.zip", **{"mau (Mau).txt": "DATA/Hora;C\n01/02/2024 07:00;1\n" * 50, "bom (Bom).txt": "DATA/Hora;C\n01/02/2024 07:00;9"})
    crus = bytearray((entrada / "i.zip").read_bytes())
    crus[crus.index(b"01/02/2024 07:00;1") + 17] ^= 1
    (entrada / "i.zip").write_bytes(crus)
    return entrada


def celulas(spark, base):
    catalogo = tabelas.le_catalogo(spark, base)
    df = carga.celulas_nomeadas(blocos.em_linhas(tabelas.le_medicoes(spark, base), catalogo), catalogo)
    return {
        (r.tabela, r.data_hora.strftime("%d/%m %H"), r.descricao): r.valor for r in df.collect()
    }


def test_zip_lines(spark, pasta):
    linhas = zips.le_zips(spark, str(pasta)).collect()
    por_arquivo = {r.arquivo for r in linhas}
    assert por_arquivo == {
        "a.zip#000000000", "a.zip#000000001", "c.zip#000000000", "c.zip#000000001", "d.zip#000000000",
        "f.zip", "g.zip", "i.zip#000000000", "i.zip#000000001",
    }
    assert {r.situacao for r in linhas if r.nr_linha < 0} == {"vazio", "sem_txt", "zip_invalido", "membro_invalido"}
    assert [r.nr_linha for r in linhas if r.arquivo == "i.zip#000000000"] == [-1]
    do_a = sorted((r.nr_linha, r.linha) for r in linhas if r.arquivo == "a.zip#000000000")
    assert [texto for _, texto in do_a] == A.splitlines()


def test_ranged_reads_give_the_lines_of_whole_zips(spark, pasta):
    inteiros = sorted(map(tuple, zips.le_zips(spark, str(pasta), intervalos=False).collect()), key=repr)
    assert sorted(map(tuple, zips.le_zips(spark, str(pasta), intervalos=True).collect()), key=repr) == inteiros
    assert zips.le_zips(spark, str(pasta.parent)).count() == 0  # a folder without ZIPs


def test_members_of_one_zip_are_many_tasks(spark, tmp_path):
    pasta = tmp_path / "um"
    pasta.mkdir()
    texto = "DATA/Hora;C\n" + "\n".join(f"01/02/2024 {h:02d}:00;{h}" for h in range(24))
    grava_zip(pasta / "um só.zip", **{f"m{i} (T{i}).txt": texto for i in range(40)}, **{"leia.md": "nada"})
    caminhos = spark.read.format("binaryFile").load(str(pasta)).select("path", "length")
    assert "content" not in caminhos._jdf.queryExecution().executedPlan().toString()
    parte = 4 * len(texto.encode())
    partes = zips.partes_dos_zips(caminhos, bytes_por_parte=parte).collect()
    assert [(p.primeiro, p.ultimo) for p in sorted(partes, key=lambda p: p.primeiro)] == [(i, i + 3) for i in range(0, 40, 4)]
    linhas = zips.linhas_dos_caminhos(caminhos, bytes_por_parte=parte)
    por_tarefa = linhas.groupBy(F.spark_partition_id().alias("t")).agg(F.countDistinct("arquivo").alias("n")).collect()
    assert len(por_tarefa) > 4 and sum(r.n for r in por_tarefa) == 40 and linhas.count() == 40 * 25


def test_zip64_beyond_two_gigabytes_is_read_by_ranges(spark, tmp_path):
    # a sparse file: the second member lies behind 5 GB that no directory entry names
    caminho = tmp_path / "grande.zip"
    with open(caminho, "wb") as cru, zipfile.ZipFile(cru, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a (A).txt", "DATA/Hora;C\n01/02/2024 07:00;1")
        cru.seek(5 << 30)
        z.start_dir = cru.tell()
        z.writestr("b (B).txt", "DATA/Hora;C\n01/02/2024 08:00;2")
    assert caminho.stat().st_size > 5 << 30
    linhas = zips.le_zips(spark, str(tmp_path)).collect()
    assert sorted((r.arquivo, r.nr_linha, r.linha) for r in linhas)[1::2] == [
        ("grande.zip#000000000", 1, "01/02/2024 07:00;1"), ("grande.zip#000000001", 1, "01/02/2024 08:00;2"),
    ]


def test_failed_reads_are_no_marks(tmp_path):
    class Quebrado(io.BytesIO):
        def read(self, n=-1):
            raise OSError("connection reset")

    with pytest.raises(zips.FalhaDeLeitura):
        zipfile.ZipFile(zips._Intervalos(Quebrado(b"PK" * 50)))


def test_line_boundaries_do_not_depend_on_blocks(monkeypatch):
    texto = "a\r\nb\rc\x0bd\x85e\n\nf\r\n" * 7 + "fim"
    for tamanho in (1, 2, 3, 5, 1000):
        monkeypatch.setattr(zips, "BYTES_POR_LEITURA", tamanho)
        assert list(zips.linhas_de(io.BytesIO(texto.encode("latin-1")))) == texto.splitlines()


def test_load(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    resultado = carrega_pasta(spark, str(pasta), base)
    assert celulas(spark, base) == {
        ("lago___norte", "01/02 00", "SE São-EAE"): 3.75,
        ("lago___norte", "01/02 00", "SE São-EAR"): 10.0,
        ("lago___norte", "01/02 01", "SE São-EAE"): 0.0,
        ("lago___norte", "01/02 01", "SE São-EAR"): 7.0,  # 7.005 rounds half to even
        ("lago___norte", "01/02 02", "SE São-EAE"): 4.0,
        ("lago___norte", "01/02 02", "SE São-EAR"): 0.0,
        ("sem_parenteses_01", "01/02 05", "C"): 3.0,
        ("ruim", "01/02 07", "C"): 1.0,
        ("bom", "01/02 07", "C"): 9.0,
    }
    rejeitados = resultado.rejeitados.collect()
    assert sorted(r.texto_tempo for r in rejeitados) == ["", "01/02/2024 24:00", "31/02/2024 10:00"]
    situacao = {r.arquivo: r for r in resultado.auditoria.collect()}
    assert situacao["a.zip#000000000"].situacao == "ok"
    assert situacao["a.zip#000000000"].rodapes == 1
    assert situacao["a.zip#000000000"].linhas_com_campo_extra == 1
    assert situacao["c.zip#000000000"].situacao == "vazio"
    assert situacao["c.zip#000000001"].situacao == "sem_coluna_de_tempo"
    assert situacao["d.zip#000000000"].rejeitadas == 3
    assert situacao["f.zip"].situacao == "sem_txt"
    assert situacao["g.zip"].situacao == "zip_invalido"
    assert situacao["i.zip#000000000"].situacao == "membro_invalido"
    assert situacao["i.zip#000000001"].situacao == "ok"
    assert [tuple(r) for r in resultado.colunas_omitidas.collect()] == [("d.zip#000000000", 2, "C", "nome_repetido")]
    assert resultado.chaves_duplicadas.count() == 0
    # rows of the counts equal those of the stored values
    presenca = sorted(tuple(r) for r in tabelas.le_presenca(spark, base).collect() if r.n)
    largas = blocos.em_linhas(tabelas.le_medicoes(spark, base), tabelas.le_catalogo(spark, base))
    assert presenca == sorted(map(tuple, carga.presenca(largas).collect()))


def test_second_load_replaces_rows_and_grows_columns(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base)
    outra = tmp_path / "outra"
    outra.mkdir()
    grava_zip(outra / "b.zip", **{"y (Lago - Norte).txt": B})
    novas = carrega_pasta(spark, str(outra), base).colunas_novas.collect()
    assert [(r.tabela, r.descricao) for r in novas] == [("lago___norte", "SE Sao-ERE")]
    depois = {k: v for k, v in celulas(spark, base).items() if k[0] == "lago___norte"}
    assert depois == {
        ("lago___norte", "01/02 00", "SE São-EAE"): 3.75,
        ("lago___norte", "01/02 00", "SE São-EAR"): 10.0,
        ("lago___norte", "01/02 00", "SE Sao-ERE"): None,
        # the whole row is replaced: the channel the later file lacks becomes NULL
        ("lago___norte", "01/02 01", "SE São-EAE"): 8.0,
        ("lago___norte", "01/02 01", "SE São-EAR"): None,
        ("lago___norte", "01/02 01", "SE Sao-ERE"): 9.0,
        ("lago___norte", "01/02 02", "SE São-EAE"): 4.0,
        ("lago___norte", "01/02 02", "SE São-EAR"): 0.0,
        ("lago___norte", "01/02 02", "SE Sao-ERE"): None,
        ("lago___norte", "01/03 00", "SE São-EAE"): 5.0,
        ("lago___norte", "01/03 00", "SE São-EAR"): None,
        ("lago___norte", "01/03 00", "SE Sao-ERE"): 6.0,
    }
    # loading the same folder again changes nothing
    carrega_pasta(spark, str(outra), base)
    assert {k: v for k, v in celulas(spark, base).items() if k[0] == "lago___norte"} == depois
    assert carga.chaves_duplicadas(tabelas.le_medicoes(spark, base)).count() == 0


class Morte(Exception):
    pass


def test_a_load_that_dies_leaves_the_old_state_whole(spark, pasta, tmp_path, monkeypatch):
    """Killed after each of its writes in turn; running it again gives the state of a load that never died."""
    base, sem_morte = str(tmp_path / "base"), str(tmp_path / "outra_base")
    outra = tmp_path / "outra"
    outra.mkdir()
    grava_zip(outra / "b.zip", **{"y (Lago - Norte).txt": B})
    for b in (base, sem_morte):
        carrega_pasta(spark, str(pasta), b)
    antes, presenca = celulas(spark, base), sorted(map(tuple, tabelas.le_presenca(spark, base).collect()))
    passos = ("grava_catalogo", "grava_medicoes", "publica")
    for passo in passos:
        modulo = ingestao if passo == "publica" else tabelas
        certo = getattr(modulo, passo)

        def morre(*args, certo=certo, escreve=passo != "publica"):
            if escreve:
                certo(*args)
            raise Morte

        with monkeypatch.context() as m:
            m.setattr(modulo, passo, morre)
            with pytest.raises(Morte):
                carrega_pasta(spark, str(outra), base)
        assert publicacao.estado(spark, base).numero == 1
    assert celulas(spark, base) == antes
    assert sorted(map(tuple, tabelas.le_presenca(spark, base).collect())) == presenca
    carrega_pasta(spark, str(outra), base)
    carrega_pasta(spark, str(outra), sem_morte)
    assert celulas(spark, base) == celulas(spark, sem_morte) != antes
    # what the dead loads left is deleted once it is old enough, and nothing else
    assert publicacao.limpa(spark, base) == []
    lidas = celulas(spark, base)
    assert len(publicacao.limpa(spark, base, ociosas_ha_horas=0)) >= 3
    assert celulas(spark, base) == lidas


def test_of_two_loads_at_once_the_later_one_starts_over(spark, pasta, tmp_path, monkeypatch):
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base)
    outra = tmp_path / "outra"
    outra.mkdir()
    grava_zip(outra / "b.zip", **{"y (Lago - Norte).txt": B})
    certo = ingestao.publica
    vezes = []

    def ultrapassada(spark, base, novo):
        vezes.append(novo.numero)
        if len(vezes) == 1:  # another load publishes the same number first
            linhas = spark.createDataFrame([("f", "f (T).txt", 0, "DATA/Hora;C", None), ("f", "f (T).txt", 1, "01/02/2024 03:10;1,5", None)], zips.ESQUEMA)
            carrega_linhas(spark, linhas, base)
        certo(spark, base, novo)

    monkeypatch.setattr(ingestao, "publica", ultrapassada)
    carrega_pasta(spark, str(outra), base)
    assert vezes == [2, 2, 3]
    lidas = celulas(spark, base)
    assert lidas[("t", "01/02 03", "C")] == 1.5 and lidas[("lago___norte", "01/02 01", "SE São-EAE")] == 8.0
    with pytest.raises(publicacao.CargaConcorrente):
        certo(spark, base, publicacao.Estado(3))


def test_state_without_new_columns_keeps_its_catalogue(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base)
    um = publicacao.estado(spark, base)
    velho = tabelas.le_medicoes(spark, base, um).orderBy("tabela", "bloco", "data_hora").collect()
    carrega_pasta(spark, str(pasta), base)
    dois = publicacao.estado(spark, base)
    assert (dois.numero, dois.catalogo) == (2, um.catalogo) and dois.particoes.keys() == um.particoes.keys()
    # a reader that holds the older state still reads it
    assert tabelas.le_medicoes(spark, base, um).orderBy("tabela", "bloco", "data_hora").collect() == velho


def test_catalogue_with_a_gap_is_refused_and_values_go_by_place(spark):
    esquema = carga.ESQUEMA_CATALOGO
    com_falha = spark.createDataFrame([("t", 0, 0, "A", "a", "REAL"), ("t", 0, 2, "B", "b", "REAL")], esquema)
    with pytest.raises(ValueError):
        carga.confere_lugares(com_falha)
    largas = spark.createDataFrame([("f", datetime(2024, 1, 1), [7.0, 8.0])], "arquivo string, data_hora timestamp_ntz, valores array<double>")
    colunas = spark.createDataFrame([("f", "t", 0, "B", "b"), ("f", "t", 1, "A", "a")], "arquivo string, tabela string, indice int, descricao string, descricao_norm string")
    assert carga.alinha(largas, colunas, com_falha).first().valores == [8.0, None, 7.0]


def test_nothing_stays_behind(spark, pasta, tmp_path):
    from pathlib import Path

    provisorio = Path(spark.conf.get("spark.checkpoint.dir")) / "fasor"
    provisorio.mkdir(exist_ok=True)
    antes = set(provisorio.iterdir())
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base).descarta()
    inicia_carga(spark, str(pasta), str(tmp_path / "outra"), str(tmp_path / "ponto"), zips_por_lote=3).awaitTermination()
    assert set(provisorio.iterdir()) == antes
    assert celulas(spark, base) == celulas(spark, str(tmp_path / "outra"))


def test_cell_mode_keeps_channels_the_later_file_lacks(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    grava_zip(pasta / "z.zip", **{"y (Lago - Norte).txt": B})
    carrega_pasta(spark, str(pasta), base, modo="celula")
    valores = celulas(spark, base)
    assert valores[("lago___norte", "01/02 01", "SE São-EAE")] == 8.0
    assert valores[("lago___norte", "01/02 01", "SE São-EAR")] == 7.0
    assert valores[("lago___norte", "01/02 01", "SE Sao-ERE")] == 9.0


def test_dedup_by_original_stamp(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base, dedup="carimbo")
    assert celulas(spark, base)[("lago___norte", "01/02 00", "SE São-EAE")] == 5.25


def test_partition_pruning_reaches_the_scan(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    carrega_pasta(spark, str(pasta), base)
    from fasor.operators.base import no_instante

    plano = no_instante(tabelas.le_medicoes(spark, base), datetime(2024, 2, 1, 1))
    texto = plano._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in texto
    empurrados = texto[texto.index("PushedFilters: [") :].split("]")[0]
    assert "EqualTo(data_hora,2024-02-01T01:00)" in empurrados and "EqualTo(dia,1)" in empurrados
    assert plano.count() == 1


def test_continuous_load(spark, pasta, tmp_path):
    base = str(tmp_path / "base")
    consulta = inicia_carga(spark, str(pasta), base, str(tmp_path / "ponto"))
    consulta.awaitTermination()
    antes = celulas(spark, base)
    assert antes[("lago___norte", "01/02 01", "SE São-EAE")] == 0.0
    grava_zip(pasta / "h.zip", **{"y (Lago - Norte).txt": B})
    inicia_carga(spark, str(pasta), base, str(tmp_path / "ponto")).awaitTermination()
    assert celulas(spark, base)[("lago___norte", "01/02 01", "SE São-EAE")] == 8.0


def test_csv_sink(spark, tmp_path):
    destino = str(tmp_path / "curva")
    df = spark.createDataFrame([("São", 1.5)], "nome string, valor double").withColumn(
        "Data_Hora", F.lit("2024-02-01 03:00:00").cast("timestamp_ntz")
    )
    tabelas.grava_csv(df.select("Data_Hora", "nome", "valor").coalesce(1), destino)
    (arquivo,) = (tmp_path / "curva").glob("*.csv")
    assert arquivo.read_bytes().decode("latin-1") == "Data_Hora;nome;valor\n2024-02-01 03:00:00;São;1.5\n"
    tabelas.exporta_curva(df.withColumn("codigo", F.lit("F1")), str(tmp_path))
    assert (tmp_path / "curvas" / "codigo=F1" / "ano=2024").is_dir()
    horas = spark.range(500).select(
        F.timestamp_add("HOUR", F.pmod(F.col("id") * 37, F.lit(500)), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("Data_Hora"),
        F.concat(F.lit("F"), F.col("id") % 3).alias("codigo"),
    )
    tabelas.exporta_curva(horas.repartition(7), str(tmp_path / "muitas"))
    arquivos = sorted((tmp_path / "muitas" / "curvas").glob("codigo=*/ano=*/*.csv"))
    assert len(arquivos) == 3  # one file each, in order of time
    for a in arquivos:
        linhas = a.read_text().splitlines()[1:]
        assert linhas == sorted(linhas) and len(linhas) in (166, 167)
    feito = tabelas.exporta_coincidente(df, str(tmp_path), datetime(2024, 1, 2, 3))
    assert feito == f"{tmp_path}/demanda_coincidente_20240102_0300"
    assert spark.read.option("sep", ";").option("header", True).csv(feito).count() == 1


def test_registry_file(spark, tmp_path):
    caminho = tmp_path / "dados.csv"
    caminho.write_text("Codigo;descricao\nT1-EAE;c1\n;sem chave\n")
    lido = tabelas.le_cadastro(spark, str(caminho), "Codigo string, descricao string", "Codigo", ("descricao",))
    assert [tuple(r) for r in lido.collect()] == [("T1-EAE", "c1")]
    caminho.write_text("descricao;Codigo;sobra\nc1;T1-EAE;x\n")  # by name, not by place
    lido = tabelas.le_cadastro(spark, str(caminho), "Codigo string, descricao string, potencia double", "Codigo")
    assert [tuple(r) for r in lido.collect()] == [("T1-EAE", "c1", None)]
    caminho.write_text("Codigo;outra\nT1-EAE;c1\n")
    with pytest.raises(ValueError):
        tabelas.le_cadastro(spark, str(caminho), "Codigo string, descricao string", "Codigo", ("descricao",))


def test_registry_is_written_back(spark, tmp_path):
    from fasor.operators import cadastro

    destino = str(tmp_path / "equipamentos.parquet")
    tabelas.grava_cadastro(spark.createDataFrame([(1, "A", 5.0), (2, "B", 6.0)], "id bigint, codigo string, potencia_instalada double"), destino)
    mudancas = spark.createDataFrame([(1, "U", "A2"), (2, "D", None)], "id bigint, op string, codigo string")
    lido = tabelas.le_cadastro(spark, destino, "", "codigo")
    tabelas.grava_cadastro(cadastro.exclui(cadastro.atualiza(lido, mudancas), mudancas), destino)
    assert [tuple(r) for r in tabelas.le_cadastro(spark, destino, "", "codigo").collect()] == [(1, "A2", 5.0)]
    # a version whose write did not end is not read, and the next write gets rid of it
    antes = lido.collect()
    tabelas.le_cadastro(spark, destino, "", "codigo").write.parquet(f"{destino}/versao=2")
    (tmp_path / "equipamentos.parquet" / "versao=2" / "_SUCCESS").unlink()
    assert lido.collect() == antes  # a reader of the version before
    assert tabelas.le_cadastro(spark, destino, "", "codigo").count() == 1
    tabelas.grava_cadastro(lido.limit(0), destino)
    assert tabelas.le_cadastro(spark, destino, "", "codigo").count() == 0
    assert sorted(p.name for p in (tmp_path / "equipamentos.parquet").iterdir()) == ["versao=1", "versao=3"]


def test_lines_can_come_from_anywhere(spark, tmp_path):
    base = str(tmp_path / "base")
    linhas = spark.createDataFrame(
        [("f", "f (T).txt", 0, "DATA/Hora;C", None), ("f", "f (T).txt", 1, "2024-02-01 03:10:00;1,5", None)],
        zips.ESQUEMA,
    )
    carrega_linhas(spark, linhas, base, formatos=["d/M/yyyy H:mm", "yyyy-MM-dd HH:mm:ss"])
    assert celulas(spark, base) == {("t", "01/02 03", "C"): 1.5}


def test_each_file_is_read_in_one_format(spark, tmp_path):
    """02/03 and 13/03 of one file are months and days of one format; a file that says nothing is reported."""
    base = str(tmp_path / "base")
    arquivos = {
        "a": ["02/03/2024 01:00", "13/03/2024 01:00", "ruim"],  # day first
        "b": ["02/03/2024 01:00", "03/13/2024 01:00"],  # month first
        "c": ["02/03/2024 01:00", "04/04/2024 01:00"],  # both, differently
        "d": ["05/05/2024 01:00"],  # both, equally
        "e": ["sem data"],
        "f": ["13/01/2024 01:00", "01/13/2024 01:00", "01/14/2024 01:00"],  # mixed: the more frequent one
    }
    linhas = [(a, f"{a} ({a}).txt", 0, "DATA/Hora;C", None) for a in arquivos]
    linhas += [(a, f"{a} ({a}).txt", i, f"{t};{i}", None) for a, todas in arquivos.items() for i, t in enumerate(todas, 1)]
    df = spark.createDataFrame(linhas, zips.ESQUEMA).repartition(5)
    resultado = carrega_linhas(spark, df, base, formatos=["d/M/yyyy H:mm", "M/d/yyyy H:mm"])
    assert {(k[0], k[1]) for k in celulas(spark, base)} == {
        ("a", "02/03 01"), ("a", "13/03 01"), ("b", "03/02 01"), ("b", "13/03 01"), ("c", "02/03 01"), ("c", "04/04 01"),
        ("d", "05/05 01"), ("f", "13/01 01"), ("f", "14/01 01"),
    }
    dia, mes = "d/M/yyyy H:mm", "M/d/yyyy H:mm"
    assert {r.arquivo: (r.formato, r.ambiguo, r.rejeitadas) for r in resultado.auditoria.collect()} == {
        "a": (dia, False, 1), "b": (mes, False, 0), "c": (dia, True, 0), "d": (dia, False, 0), "e": (dia, False, 1), "f": (mes, False, 1),
    }

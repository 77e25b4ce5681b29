import pytest
from pyspark.sql import functions as F

from tarmaq.plans import bronze, vocabulary
from tarmaq.sources.delimited import (
    NO_QUOTES,
    header_of,
    read_delimited,
    require_headers,
    write_delimited,
)
from tests.conftest import rows

HEADER = "Código;Nome;UF"


def write(folder, name, lines, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(folder)


def test_preamble_and_header_leave_every_file(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.csv", ["Atualizado em: 2025", HEADER, "A1;AZU;SP", 'B2;"x ""y"" z";RJ'])
    write(folder, "b.csv", ["Atualizado em: 2026", HEADER, "C3;curto", ";;", "Código;Nome;MG"])
    df = read_delimited(spark, str(folder), escape='"')
    assert df.columns == ["Código", "Nome", "UF"]
    assert rows(df) == sorted([
        ("A1", "AZU", "SP"), ("B2", 'x "y" z', "RJ"), ("C3", "curto", None),
        (None, None, None), ("Código", "Nome", "MG"),
    ], key=repr)


def test_split_files_keep_every_row(spark, tmp_path):
    body = [f"{i};name {i};SP" for i in range(20_000)]
    folder = write(tmp_path / "big", "a.csv", ["preamble", HEADER, *body])
    write(tmp_path / "big", "b.csv", ["preamble", HEADER, *body])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_delimited(spark, folder, ["Código", "Nome", "UF"])
        assert df.rdd.getNumPartitions() > 10
        assert df.count() == 40_000
        assert df.where(F.col("UF") != "SP").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_latin1_without_quoting(spark, tmp_path):
    folder = write(tmp_path / "latin", "a.csv", ["x", HEADER, 'S1;São "Paulo;"SP'], "iso-8859-1")
    df = read_delimited(spark, folder, encoding="ISO-8859-1", quote=NO_QUOTES)
    assert header_of(spark, folder, encoding="ISO-8859-1", quote=NO_QUOTES) == HEADER.split(";")
    assert rows(df) == [("S1", 'São "Paulo', '"SP')]


def test_flights_carry_file_and_load_time(spark, tmp_path):
    header = ";".join(vocabulary.FLIGHT_COLUMNS)
    line = "AZU;0042;0;N;SBGR;SBSP;2025-08-01 10:00:00.000;null;;null;REALIZADO;N/A"
    folder = tmp_path / "vra"
    write(folder, "VRA_1.csv", ["p", header, line])
    write(folder, "VRA_2.csv", ["p", header, line, line])
    df = bronze.flights(spark, f"{folder}/*.csv")
    assert len(df.columns) == 14
    assert set(dict(df.dtypes[:13]).values()) == {"string"}
    assert rows(df.groupBy("_arquivo_origem").count()) == [("VRA_1.csv", 1), ("VRA_2.csv", 2)]
    assert df.select("_ingerido_em").distinct().count() == 1


def test_company_columns_are_found_by_header(spark, tmp_path):
    folder = write(tmp_path / "c", "nac.csv", [
        "p", "Razao;ICAO;Estrangeira;Servico;Cidade;UF;Ativa;Extra",
        "Azul;AZU;AD;Regular;Barueri;SP;ATIVA;1", "Sem Codigo;;;;;;INATIVA;2"])
    df = bronze.companies(spark, folder, "nac.csv")
    assert df.columns[:7] == list(vocabulary.COMPANY_COLUMNS.values())
    assert rows(df.select("icao", "legal_name", "_arquivo_origem")) == sorted(
        [("AZU", "Azul", "nac.csv"), (None, "Sem Codigo", "nac.csv")], key=repr)


@pytest.mark.parametrize("name, lines", [
    ("swapped", ["p", "Nome;Código;UF", "a;b;c"]),
    ("renamed", ["p", "Código;Nome;Estado", "a;b;c"]),
    ("extra", ["p", HEADER + ";X", "a;b;c;d"]),
    ("missing", ["p", "Código;Nome", "a;b"]),
    ("twopreambles", ["p", "p2", HEADER, "a;b;c"]),
    ("headless", ["p", "a;b;c"]),
    ("preambleonly", ["p"]),
])
def test_other_headers_are_refused(spark, tmp_path, name, lines):
    columns = HEADER.split(";")
    folder = write(tmp_path / "in", "good.csv", ["p", HEADER, "a;b;c"])
    write(tmp_path / "in", "quoted.csv", ["p", '"Código";"Nome";"UF"', "a;b;c"])
    require_headers(spark, folder, columns)
    (tmp_path / "in" / f"{name}.csv").write_text("".join(x + "\n" for x in lines))
    with pytest.raises(ValueError, match=f"of {name}.csv$"):
        require_headers(spark, folder, columns)


def test_written_files_read_back(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), F.lit("é").alias("b"))
    write_delimited(df, str(tmp_path / "out"), F.col("a").cast("int") % 3, "preamble")
    files = f"{tmp_path}/out/file=*/*.txt"
    require_headers(spark, files, ["a", "b"])
    assert rows(read_delimited(spark, files)) == rows(df)
    assert header_of(spark, files) == ["a", "b"]

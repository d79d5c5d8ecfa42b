"""Reading the published files: banner, header, charset, quotes, provenance."""

from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pontualis import model
from pontualis.operators.rows import MissingColumns
from pontualis.plans.bronze import MALFORMED, Source, bronze_table
from pontualis.plans.silver import silver_airports
from pontualis.sources.delimited import (
    AIRLINES,
    AIRPORTS,
    FLIGHTS,
    HeaderMismatch,
    Layout,
    headers_of,
    read_delimited,
)

BOM = "\ufeff"
HEADER = ";".join(f'"{h}"' for h in model.FLIGHT_HEADERS)
ROW = ('"GLO";"0123";"0";"N";"SBGR";"SBSP";"2026-01-27 19:45:00";'
       '"2026-01-27 19:50:12.123456789";"2026-01-27 21:00:00";"null";"REALIZADO";"N/A"')


def write(path, lines, charset="utf-8", newline="\n"):
    path.write_bytes((newline.join(lines) + newline).encode(charset))
    return str(path)


def test_banner_and_header_leave_every_file_and_empty_rows_stay(spark, tmp_path):
    for month in ("2025-08", "2025-09"):
        write(tmp_path / f"VRA_{month}.csv",
              [BOM + f"Atualizado em: {month}-30", HEADER, ROW, ";" * 11])
    df = read_delimited(spark, f"{tmp_path}/*.csv", FLIGHTS, provenance=model.SOURCE_FILE)
    assert df.columns == [*model.FLIGHT_COLUMNS, model.SOURCE_FILE]
    rows = df.orderBy(model.SOURCE_FILE, F.col("icao_empresa").desc_nulls_last()).collect()
    assert [r[model.SOURCE_FILE] for r in rows] == ["VRA_2025-08.csv"] * 2 + ["VRA_2025-09.csv"] * 2
    assert rows[0].numero_voo == "0123" and rows[0].chegada_real == "null"
    assert rows[0].partida_real == "2026-01-27 19:50:12.123456789"
    assert all(rows[1][c] is None for c in model.FLIGHT_COLUMNS)


def test_windows_line_ends(spark, tmp_path):
    write(tmp_path / "a.csv", ["Atualizado em: x", HEADER, ROW], newline="\r\n")
    rows = read_delimited(spark, str(tmp_path), FLIGHTS).collect()
    assert len(rows) == 1 and rows[0].codigo_justificativa == "N/A"


def test_missing_column_raises_before_reading(spark, tmp_path):
    write(tmp_path / "a.csv", ["Atualizado em: x", HEADER.replace("Situação Voo", "Status"), ROW])
    with pytest.raises(MissingColumns, match="Situação Voo"):
        read_delimited(spark, str(tmp_path), FLIGHTS)


def test_reordered_columns_are_never_read_into_the_wrong_ones(spark, tmp_path):
    layout = Layout({"a": "first", "b": "second"})
    write(tmp_path / "1.csv", ["banner", '"a";"b"', '"1";"2"'])
    write(tmp_path / "2.csv", ["banner", '"b";"a"', '"4";"3"'])
    write(tmp_path / "3 with blanks.csv", ["banner", '"x y";"b";"a"', '"0";"6";"5"'])
    write(tmp_path / "4.csv", [BOM + '"b";"a"', '"8";"7"', '"b";"a"'])
    rows = read_delimited(spark, f"{tmp_path}/*.csv", layout).collect()
    # Without a banner a second line like the header is a row.
    assert sorted(map(tuple, rows)) == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8"), ("a", "b")]
    plain = layout.without_banner()
    assert sorted(map(tuple, read_delimited(spark, f"{tmp_path}/*.csv", plain).collect())) == sorted(
        map(tuple, rows))


def test_a_file_that_lacks_a_column(spark, tmp_path):
    layout = Layout({"a": "first", "b": "second", "c": "third"})
    write(tmp_path / "1.csv", ["banner", "a;b;c", "1;2;3"])
    write(tmp_path / "2.csv", ["banner", "c;a", "6;4"])
    with pytest.raises(HeaderMismatch, match=r"1 of 2 files lack .*\['b'\]"):
        read_delimited(spark, f"{tmp_path}/*.csv", layout)
    rows = read_delimited(spark, f"{tmp_path}/*.csv", layout, missing="null").collect()
    assert sorted(map(tuple, rows)) == [("1", "2", "3"), ("4", None, "6")]
    write(tmp_path / "3.csv", ["banner"])
    write(tmp_path / "4.csv", [])
    rows = read_delimited(spark, f"{tmp_path}/*.csv", layout, missing="null", malformed="line").collect()
    assert len(rows) == 2 and all(r.line is None for r in rows)
    write(tmp_path / "5.csv", ["banner", "no;header", "1;2"])
    with pytest.raises(MissingColumns, match="1 of 5 files have no header"):
        read_delimited(spark, f"{tmp_path}/*.csv", layout, missing="null")


def test_a_column_that_comes_twice_is_refused(spark, tmp_path):
    write(tmp_path / "1.csv", ["banner", "a;b;a", "1;2;3"])
    with pytest.raises(ValueError, match="columns twice"):
        read_delimited(spark, str(tmp_path), Layout({"a": "a"}))


def test_headers_are_found_without_reading_the_files(spark, tmp_path):
    for i in range(5):
        write(tmp_path / f"{i}.csv", ["banner", "a;b" if i else "b;a", *["1;2"] * 50_000])
    groups = headers_of(spark, f"{tmp_path}/*.csv", Layout({"a": "a", "b": "b"}))
    assert [(g.header, g.skipped, g.files, len(g.named)) for g in groups] == [
        (("a", "b"), 1, 4, 0), (("b", "a"), 1, 1, 1)]
    df = read_delimited(spark, f"{tmp_path}/*.csv", Layout({"a": "a", "b": "b"}), groups=groups)
    assert {r.a: r["count"] for r in df.groupBy("a").count().collect()} == {"1": 200_000, "2": 50_000}


def test_headers_are_found_where_files_come_in_blocks(spark, tmp_path, monkeypatch):
    """A session may be unable to choose its splits: files in many blocks, and many small files in one task."""
    held = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
    conf, new_session = type(spark.conf), type(spark).newSession
    put = conf.set

    def hold(session):
        for key, value in held.items():
            put(session.conf, key, value)
        return session

    monkeypatch.setattr(type(spark), "newSession", lambda self: hold(new_session(self)))
    monkeypatch.setattr(conf, "set", lambda self, key, value: None if key in held else put(self, key, value))
    rows = [f"{i};{i * 2}" for i in range(3000)]
    for i in range(12):
        order = "a;b" if i % 4 else "b;a"
        write(tmp_path / f"{i}.csv", ["banner", order, *(rows if i < 3 else rows[:2])])
    # Its header begins in the third block.
    write(tmp_path / "late.csv", ["banner" * 800, "a;b", *rows])
    layout = Layout({"a": "a", "b": "b"})
    groups = headers_of(spark, f"{tmp_path}/*.csv", layout)
    assert [(g.header, g.skipped, g.files, len(g.named)) for g in groups] == [
        (("a", "b"), 1, 10, 0), (("b", "a"), 1, 3, 3)]
    df = read_delimited(spark, f"{tmp_path}/*.csv", layout, groups=groups)
    swapped = sum(int(b) < int(a) for a, b in df.collect())
    assert (df.count(), swapped) == (4 * 3000 + 9 * 2, 2999 + 2)


def test_a_duplicated_unnamed_column_does_no_harm(spark, tmp_path):
    write(tmp_path / "1.csv", ["banner", "x;a;x", "1;2;3"])
    assert read_delimited(spark, str(tmp_path), Layout({"a": "a"})).collect() == [("2",)]


def test_lines_with_other_numbers_of_fields_are_kept_whole(spark, tmp_path):
    layout = Layout({"a": "first", "b": "second"})
    write(tmp_path / "1.csv", ["banner", '"a";"b"', '"1";"2"', '"3";"4";"5"', '"6"', ';'])
    rows = read_delimited(spark, str(tmp_path), layout, malformed="line").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("1", "2", None), ("3", "4", '"3";"4";"5"'), ("6", None, '"6"'), (None, None, None)], key=str)
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path), layout).collect()][1] == ("3", "4")


def test_empty_file_has_no_columns(spark, tmp_path):
    write(tmp_path / "a.csv", ["Atualizado em: x"])
    with pytest.raises(MissingColumns):
        read_delimited(spark, str(tmp_path), FLIGHTS)


def test_header_order_and_extra_columns_follow_the_file(spark, tmp_path):
    write(tmp_path / "a.csv", ["banner", '"b c";"x";"a"', '"2";"9";"1"'])
    df = read_delimited(spark, str(tmp_path), Layout({"a": "first", "b c": "second"}))
    assert df.collect() == [("1", "2")]


def test_file_without_banner(spark, tmp_path):
    write(tmp_path / "a.csv", [BOM + "a;b", "a;b", "1;"])
    layout = Layout({"a": "a", "b": "b"}).without_banner()
    assert sorted(read_delimited(spark, str(tmp_path), layout).collect()) == [
        ("1", None), ("a", "b")]


def test_headers_are_counted_while_the_rows_are_read(spark, tmp_path):
    for i in range(3):
        header = "a;b" if i < 2 else "a;c"
        write(tmp_path / f"{i}.csv", ["banner", header, "1;2"])
    seen = Observation()
    df = read_delimited(spark, str(tmp_path / "[01].csv"), Layout({"a": "a"}), headers_seen=seen)
    assert df.count() == 2 and seen.get["headers"] == 2


def test_latin1_airports_without_quoting(spark, tmp_path):
    fields = ["SBRB", "AC0001", "Plácido de Castro", '"Rio Branco', "Acre", "Rio Branco\\x",
              "Acre", "09°52'06\"S", "067°53'53\"W", "193,0", "Situação"]
    write(tmp_path / "a.csv",
          ["Atualizado em: x", ";".join(model.AIRPORT_HEADERS), ";".join(fields)], "iso-8859-1")
    bronze = bronze_table(spark, Source(str(tmp_path), AIRPORTS, provenance=False))
    assert bronze.columns == [*model.AIRPORT_HEADERS.values(), MALFORMED, model.INGESTED_AT]
    assert list(bronze.drop(MALFORMED, model.INGESTED_AT).first()) == fields
    silver = silver_airports(bronze.drop(MALFORMED))
    assert len(silver.columns) == 13
    row = silver.first()
    assert row.altitude_m == 193.0 and row.latitude_dms == "09°52'06\"S" and row.uf_nome == "Acre"


def test_doubled_quotes_and_constant_provenance(spark, tmp_path):
    header = ";".join(f'"{h}"' for h in model.AIRLINE_HEADERS)
    write(tmp_path / "a.csv", [
        BOM + "Atualizado em: x", header,
        '"GLO";"G3";"GOL ""LINHAS"" S.A.";"REGULAR; CARGA";"";"SP";"ATIVA"'])
    row = bronze_table(spark, Source(str(tmp_path), AIRLINES, label="nacionais.csv")).first()
    assert row.razao_social == 'GOL "LINHAS" S.A.' and row.servico == "REGULAR; CARGA"
    assert row.cidade is None and row[model.SOURCE_FILE] == "nacionais.csv"


def test_only_one_banner_line_is_known():
    with pytest.raises(ValueError):
        Layout({"a": "a"}, banner_lines=2)


def test_scan_is_splittable(spark, tmp_path):
    lines = ["banner", "a;b", *[f"{i};{i}" for i in range(20000)]]
    write(tmp_path / "a.csv", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_delimited(spark, str(tmp_path), Layout({"a": "a", "b": "b"}))
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 20000 == df.distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_month_is_written_by_several_tasks(spark, small, monkeypatch):
    from workload import queries

    flights, paths = queries.w.raw_flights, []
    monkeypatch.setattr(queries.w, "raw_flights", lambda *a: flights(*a).repartition(3))
    new_path = queries.fresh_path
    monkeypatch.setattr(queries, "fresh_path", lambda *a: paths.append(new_path(*a)) or paths[-1])
    rows = queries.QUERIES["rows_per_file"](spark, small).collect()
    assert len(rows) == 12 and all(r.identificado for r in rows)
    assert sum(r.linhas for r in rows) == flights(spark, small).count()
    for month in range(12):
        files = list(Path(paths[0].removeprefix("file:"), f"pasta={month}").glob("*.csv"))
        assert len(files) == 3
        for file in files:
            lines = file.read_text(encoding="utf-8").splitlines()
            assert lines[0].startswith(BOM + "Atualizado em") and lines[1].startswith('"ICAO Empresa')
            assert all(line[0] in '";' for line in lines[1:])


@pytest.mark.parametrize("folders", [1, 3])
def test_a_file_of_several_batches_has_one_head(spark, tmp_path, folders):
    from workload.files import write_published

    layout = Layout({"a": "id", "b": "text"})
    df = spark.range(0, 25_000, 1, 1).withColumn("text", F.concat(F.lit("t"), "id"))
    folder = None if folders == 1 else F.col("id") % folders
    write_published(df, str(tmp_path / "out"), layout, folder=folder)
    files = list((tmp_path / "out").rglob("*.csv"))
    assert len(files) == folders
    numbers = []
    for file in files:
        lines = file.read_text(encoding="utf-8").splitlines()
        assert lines[0].startswith(BOM + "Atualizado em") and lines[1] == '"a";"b"'
        numbers.append([int(line.split(";")[0].strip('"')) for line in lines[2:]])
    assert all(n == sorted(n) for n in numbers)
    assert sorted(sum(numbers, [])) == list(range(25_000))
    assert read_delimited(spark, str(tmp_path / "out"), layout, provenance="file").count() == 25_000


def test_names_with_folders(spark, tmp_path):
    (tmp_path / "2025").mkdir()
    write(tmp_path / "2025/a.csv", ["banner", "a;b", "1;2"])
    df = read_delimited(spark, str(tmp_path / "2025"), Layout({"a": "a"}), provenance="file", folders=1)
    assert df.collect() == [("1", "2025/a.csv")]

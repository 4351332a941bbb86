from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quipu import session
from quipu.operators import load, runlog
from quipu.operators.consolidate import consolidate, country_stats
from quipu.functions.text import scrub_control_chars
from quipu.sources import catalog, extract, jdbc, landing
from quipu.sources.erp import Erp, date_column, rolling_scan
from quipu.streaming import landing as stream


def write(folder: Path, name: str, text: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_comma_bom_and_quoted_comma(spark, tmp_path):
    df = landing.read_csv(spark, write(tmp_path, "a.csv", '﻿Cód. Cliente,Nombre\n007,"Pérez, Ana"\n'))
    assert df.columns == ["COD_CLIENTE", "NOMBRE"]
    assert rows(df) == [("007", "Pérez, Ana")]


def test_semicolon_and_crlf(spark, tmp_path):
    df = landing.read_csv(spark, write(tmp_path, "a.csv", "A;B;C, D\r\n1;2;3\r\n"))
    assert df.columns == ["A", "B", "C,_D"] and rows(df) == [("1", "2", "3")]


def test_long_rows_go_and_short_rows_stay(spark, tmp_path):
    text = 'A,B,C\n1,x,1\n2,y\n3,z,4,5\n6,x,7,\n7,"q,r"\n8,"s,""t""",9\n'
    path = write(tmp_path, "a.csv", text)
    want = [("1", "x", "1"), ("2", "y", None), ("7", "q,r", None), ("8", 's,"t"', "9")]
    assert rows(landing.read_csv(spark, path)) == want
    assert landing.read_csv(spark, path).count() == 4
    assert landing.read_csv(spark, path).select("C").count() == 4
    whole = write(tmp_path, "b.csv", text + '9,"two\nlines"\n')
    assert rows(landing.read_csv(spark, whole)) == [*want, ("9", "two\nlines", None)]


def test_words_for_no_value(spark, tmp_path):
    df = landing.read_csv(spark, write(tmp_path, "a.csv", 'A,EAN\n"",NULL\nNone,NaN\nNA, NA\n'))
    assert rows(df) == [(None, None), (None, None), (None, " NA")]


def test_cells_that_span_lines(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A,B\n1,"two\nlines"\n2,x\n')
    assert rows(landing.read_csv(spark, path)) == [("1", "two\nlines"), ("2", "x")]


def test_headers_repeated_or_alike(spark, tmp_path):
    path = write(tmp_path, "a.csv", "Razon,Razón Social,A,a\n1,2,3,4\n")
    df = landing.read_csv(spark, path)
    assert df.columns == ["RAZON_SOCIAL", "RAZON_SOCIAL_1", "A", "A_1"]
    assert landing.read_csv(spark, path, normalise=False).columns == ["Razon", "Razón Social", "A", "a_1"]


def test_typed_keeps_codes(spark):
    df = spark.createDataFrame([("007", "12", "x")], "COD_X string, N string, M string")
    out = landing.typed(df, {"COD_X": "int", "N": "int", "M": "int"})
    assert rows(out) == [("007", 12, None)]


def test_latest_snapshots(spark, tmp_path):
    for name in ("V_20240101_000000.csv", "V_20240201_000000.csv", "W_CHILE_20230101_000000_normalizado.csv"):
        write(tmp_path / "CHILE", name, "A\n1\n")
    write(tmp_path / "PERU", "V_20220101_000000.csv", "A\n1\n")
    newest = landing.latest_snapshots(landing.landed_files(spark, str(tmp_path)))
    got = {(r.PAIS, r.archivo, r.nombre, r.tabla) for r in newest.collect()}
    assert got == {
        ("CHILE", "V_20240201_000000.csv", "V_CHILE_normalizado.csv", "V_CHILE"),
        ("CHILE", "W_CHILE_20230101_000000_normalizado.csv", "W_CHILE_normalizado.csv", "W_CHILE"),
        ("PERU", "V_20220101_000000.csv", "V_PERU_normalizado.csv", "V_PERU"),
    }


@pytest.fixture
def database(spark, tmp_path):
    name = "t_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_load_landing(spark, tmp_path, database):
    write(tmp_path / "in/CHILE", "Ventas_20240101_000000.csv", "A,EAN\n9,9\n")
    write(tmp_path / "in/CHILE", "Ventas_20240301_000000.csv", "A,EAN\n1,7\n2,\n")
    write(tmp_path / "in/PERU", "Ventas_20240101_000000.csv", "A,EAN\n3,8\n")
    write(tmp_path / "in/PERU", "Vacio_20240101_000000.csv", "A,EAN\n")
    write(tmp_path / "in/PERU", "Malo_20240101_000000.csv", "")
    records = load.load_landing(spark, str(tmp_path / "in"), database)
    got = {(r.tabla, r.filas_cargadas, r.exito, r.error is None) for r in records.collect()}
    assert ("VENTAS_CHILE", 2, True, True) in got and ("VENTAS_PERU", 1, True, True) in got
    assert ("VACIO_PERU", 0, False, True) in got
    assert rows(spark.table(f"{database}.VENTAS_CHILE").orderBy("A")) == [("1", "7"), ("2", None)]
    states = {r.estado: r.archivos for r in runlog.load_states(records).collect()}
    assert states["exitoso"] == 2 and states["omitido"] == 1
    summary = {r.pais: (r.tablas, r.filas) for r in runlog.load_summary(records).collect()}
    assert summary == {"CHILE": (1, 2), "PERU": (1, 1), "TOTAL": (2, 3)}


def test_replace_keeps_one_backup(spark, database):
    table = lambda name: rows(spark.table(f"{database}.{name}"))
    for n in (1, 2, 3):
        assert load.replace_with_backup(spark, spark.createDataFrame([(n,)], "a int"), database, "T")
    assert table("T") == [(3,)] and table("T_OLD") == [(2,)]
    assert not load.replace_with_backup(spark, spark.createDataFrame([], "a int"), database, "T")
    assert table("T") == [(3,)] and table("T_OLD") == [(2,)]


def test_failed_replace_leaves_the_table(spark, database):
    load.replace_with_backup(spark, spark.createDataFrame([(1,)], "a int"), database, "T")
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("a"))
    with pytest.raises(Exception):
        load.replace_with_backup(spark, bad, database, "T")
    assert rows(spark.table(f"{database}.T")) == [(1,)]


def test_replace_may_read_the_table_it_replaces(spark, database):
    load.replace_with_backup(spark, spark.createDataFrame([(1,)], "a int"), database, "T")
    more = spark.table(f"{database}.T").unionAll(spark.createDataFrame([(2,)], "a int"))
    load.replace_with_backup(spark, more, database, "T")
    assert sorted(rows(spark.table(f"{database}.T"))) == [(1,), (2,)]


def test_catalog_stats(spark, database):
    load.replace_with_backup(spark, spark.range(5).toDF("a"), database, "T")
    stats = catalog.catalog_stats(spark, database)
    row = stats.first()
    assert (row.tabla.lower(), row.filas) == ("t", 5) and row.bytes > 0
    assert catalog.catalog_totals(stats).first().tablas == 1
    assert catalog.session_info(spark).first().base == spark.catalog.currentDatabase()


def test_matching_columns(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    out = load.matching_columns(df, ["A", "B", "C"])
    assert out.columns == ["A", "B", "C"] and rows(out) == [(2, 1, None)]


def test_append_by_name(spark, database):
    load.replace_with_backup(spark, spark.createDataFrame([(1, "x")], "a int, b string"), database, "T")
    load.append_by_name(spark, spark.createDataFrame([("y", 2)], "B string, A int"), database, "T")
    load.append_by_name(spark, spark.createDataFrame([(3,)], "a int"), database, "T")
    name = f"{database}.T"
    assert sorted(rows(spark.table(name)), key=str) == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(Exception):
        load.append_by_name(spark, spark.createDataFrame([("no", "z")], "a string, b string"), database, "T")
    assert spark.table(name).count() == 3


def test_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("CHILE", ' padded ', 'say "hi", ok'), ("PERU", None, "ñ;")], "PAIS string, a string, b string"
    )
    path = str(tmp_path / "out")
    load.write_csv(df, path)
    back = load.read_export(spark, path, ["a", "b"])
    assert sorted(rows(back.select("PAIS", "a", "b")), key=str) == sorted(rows(df), key=str)


def test_scrub(spark):
    df = spark.createDataFrame([("a\x00b\x1fc\td\ne\x0b", 1)], "t string, n int")
    assert rows(scrub_control_chars(df)) == [("abc\td\ne", 1)]


def test_consolidate(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([(2.5, "old")], "n double, PAIS string")
    out = consolidate({"CHILE": a, "PERU": b})
    got = {(r.PAIS, r.n, r.t) for r in out.collect()}
    assert got == {("CHILE", 1.0, "x"), ("PERU", 2.5, None)}
    stats = {tuple(r) for r in country_stats({"CHILE": a, "PERU": b}).collect()}
    assert stats == {("CHILE", 1, 2), ("PERU", 1, 1)}


def test_extract_records(spark):
    df = spark.createDataFrame([("CHILE", 1), ("PERU", 2), ("PERU", 3)], "PAIS string, n int")
    records = runlog.extract_records({"T": df, "E": df.drop("PAIS").limit(0), "F": None})
    got = {(r.pais, r.tabla, r.registros, r.estado) for r in records.collect()}
    assert got == {
        ("CHILE", "T", 1, "OK"),
        ("PERU", "T", 2, "OK"),
        (None, "E", 0, "SIN DATOS"),
        (None, "F", 0, "ERROR"),
    }
    assert tuple(runlog.extract_summary(records).first()) == (2, 3, 2, 4, 3)


def test_extract_stacks_countries(spark):
    tables = {
        ("CHILE", "movGC_VtDocumentoVtaDet"): spark.createDataFrame([("P1", 1), ("P2", 2)], "cProductoVta string, n int"),
        ("PERU", "movGC_VtDocumentoVtaDet"): spark.createDataFrame([("P1", 3, "x")], "cProductoVta string, n int, extra string"),
        ("CHILE", "maeGC_ProductoEquiv"): spark.createDataFrame(
            [("P1", "780", "EAN12", "CL"), ("P1", "775", "EAN12", "PE")],
            "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string",
        ),
        ("PERU", "maeGC_ProductoEquiv"): spark.createDataFrame(
            [("P1", "776", "EAN12", "PE")],
            "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string",
        ),
        ("PERU", "RM00101"): spark.sql("SELECT 'C1' c, date '2024-01-01' d UNION ALL SELECT 'C2', date '2019-01-01'"),
    }
    names = ["movGC_VtDocumentoVtaDet", "maeGC_ProductoEquiv", "RM00101", "RM00201"]
    out = extract.extract(lambda c, t: tables.get((c, t)), date(2024, 6, 1), names)
    lines = {(r.PAIS, r.cProductoVta, r.n, r.extra, r.EAN) for r in out.tables[names[0]].collect()}
    assert lines == {("CHILE", "P1", 1, None, "780"), ("CHILE", "P2", 2, None, ""), ("PERU", "P1", 3, "x", "776")}
    assert [r.c for r in out.tables["RM00101"].collect()] == ["C1"]
    assert out.tables["RM00201"] is None
    records = {(r.tabla, r.pais): (r.registros, r.columnas, r.estado) for r in out.records().collect()}
    assert len(records) == 16
    assert records["RM00101", "PERU"] == (1, 2, "OK")
    assert records["RM00201", "CHILE"] == (0, 0, "ERROR")
    assert records["movGC_VtDocumentoVtaDet", "PERU"] == (1, 4, "OK")
    everything = extract.extract(lambda c, t: tables.get((c, t)), date(2024, 6, 1), ["RM00101"], date_columns={"rm00101": "d"}, days=5000)
    assert everything.tables["RM00101"].count() == 2


def test_stored_tables_read_back(spark, tmp_path, database):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    facts = spark.range(100).select(F.when(F.col("id") < 30, "PERU").otherwise("CHILE").alias("PAIS"), day.alias("d"), "id")
    plain = spark.createDataFrame([("x ",)], "CUSTNMBR string")
    load.store_tables({"FACTS": facts, "RM00101": plain, "NONE": None}, str(tmp_path / "lake"))
    tables = Erp.from_parquet(spark, str(tmp_path / "lake"), ["FACTS", "RM00101"])
    assert sorted(rows(tables["FACTS"].select("PAIS", "d", "id"))) == sorted(rows(facts))
    assert (tmp_path / "lake/FACTS/PAIS=PERU").is_dir() and rows(tables["RM00101"]) == [("x",)]
    load.replace_with_backup(spark, plain, database, "RM00101")
    assert rows(Erp.from_catalog(spark, database)["RM00101"]) == [("x",)]


def test_export_is_stamped(spark, tmp_path):
    df = spark.createDataFrame([("PERU", 1)], "PAIS string, n int")
    path = load.export(df, str(tmp_path), "Reporte Cartera", datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("/Reporte_Cartera_20240102_030405.csv")
    assert (Path(path) / "PAIS=PERU").is_dir()


def test_rolling_scan(spark):
    df = spark.sql("SELECT 1 a, date '2024-01-01' d UNION ALL SELECT 2, date '2020-01-01' UNION ALL SELECT 3, NULL")
    assert date_column(df) == "d" and date_column(df, "other") == "other"
    assert rows(rolling_scan(df, date(2024, 6, 1)).select("a")) == [(1,)]
    assert rolling_scan(df.drop("d"), date(2024, 6, 1)).count() == 3
    edge = spark.sql("SELECT timestamp_ntz '2024-01-01 00:00:00' t")
    assert rolling_scan(edge, date(2024, 1, 2), days=1).count() == 1


def test_table_list(spark, tmp_path):
    path = write(tmp_path, "t.csv", "nombre_tabla\nRM00101\n\n movGC_X \n")
    assert landing.read_table_list(spark, path) == ["RM00101", "movGC_X"]
    assert len(landing.read_table_list(spark)) == 11


def test_erp_names_ignore_case_and_keys_lose_blanks(spark):
    tables = Erp({"rm00101": spark.createDataFrame([("C1  ", "x ")], "CUSTNMBR string, CUSTNAME string")})
    assert "RM00101" in tables and rows(tables["Rm00101"]) == [("C1", "x ")]


def test_jdbc_slices_cover_the_window_once():
    slices = jdbc.day_slices("d", date(2024, 1, 1), days=100, slices=7)
    assert len(slices) == 7 and slices[0].startswith("d >= '2023-09-23'") and "<" not in slices[-1]
    ends = [s.split("< ")[1] for s in slices[:-1]]
    starts = [s.split(">= ")[1].split(" AND")[0] for s in slices[1:]]
    assert ends == starts


def test_jdbc_settings_come_from_the_environment(monkeypatch):
    with pytest.raises(KeyError):
        jdbc.connection("ATLANTIS")
    monkeypatch.setenv("ERP_PERU_URL", "jdbc:x")
    monkeypatch.setenv("ERP_PERU_USER", "u")
    assert jdbc.connection("PERU") == {"url": "jdbc:x", "user": "u"}


class FakeSession:
    """Just enough of a session to hold one setting."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="a1")


def test_scratch_folder_is_the_sessions(spark):
    assert session.scratch_path(FakeSession("/shared/", "yarn"), "x").startswith("/shared/x-")
    assert session.shared_dir(spark).endswith("/_scratch") or spark.conf.get("spark.checkpoint.dir", None)


def test_quotes_count_only_where_a_cell_begins(spark, tmp_path):
    path = write(tmp_path, "inch.csv", 'A,B,C\n1,5",6",9\n2,"x,y",3\n4,5",6"\n')
    got = rows(landing.read_csv(spark, path))
    assert sorted(got) == [("2", "x,y", "3"), ("4", '5"', '6"')]


def test_files_of_one_folder_keep_their_own_headers(spark, tmp_path):
    write(tmp_path / "in", "1.csv", "A,B\n1,2\n")
    write(tmp_path / "in", "2.csv", "B,A\n20,10\n")
    got = {(r.A, r.B) for r in landing.read_csv(spark, str(tmp_path / "in")).collect()}
    assert got == {("1", "2"), ("10", "20")}


def test_current_rows_keep_every_table_and_part(spark):
    data = [
        ("CHILE", "f:/l/CHILE/Ventas_20240101_000000.csv", "20240101_000000", 1),
        ("CHILE", "f:/l/CHILE/Ventas_20240201_000000.csv/part-0.csv", "20240201_000000", 2),
        ("CHILE", "f:/l/CHILE/Ventas_20240201_000000.csv/part-1.csv", "20240201_000000", 3),
        ("CHILE", "f:/l/CHILE/Clientes_20230101_000000.csv", "20230101_000000", 4),
    ]
    df = spark.createDataFrame(data, f"PAIS string, {stream.FILE} string, {stream.STAMP} string, n int")
    assert sorted(r.n for r in stream.current_rows(df).collect()) == [2, 3, 4]


def test_a_country_on_one_side_only_is_refused(spark):
    from quipu.operators.joins import on_keys

    plain, owned = spark.sql("SELECT 1 k"), spark.sql("SELECT 1 k, 'PERU' PAIS")
    assert on_keys(owned, plain, "k") == ["k"] and on_keys(owned, owned, "k") == ["PAIS", "k"]
    with pytest.raises(ValueError):
        on_keys(plain, owned, "k")


def test_files_with_different_headers_and_odd_names(spark, tmp_path):
    one = write(tmp_path, "📊 Año [1].csv", "A;B\n1;2\n")
    two = write(tmp_path, "b+c%20.csv", 'B,A,Z\n20,10,"x\ny"\n')
    df = landing.read_csv(spark, [landing.literal(one), landing.literal(two)], tag="f")
    got = {(r.A, r.B, r.Z) for r in df.collect()}
    assert got == {("1", "2", None), ("10", "20", "x\ny")}


def test_folder_of_files_where_some_cells_span_lines(spark, tmp_path):
    write(tmp_path / "in", "1.csv", 'A,B\n1,"x\ny"\n')
    write(tmp_path / "in", "2.csv", "A,B\n2,z\n3\n")
    got = sorted(rows(landing.read_csv(spark, str(tmp_path / "in"))), key=str)
    assert got == [("1", "x\ny"), ("2", "z"), ("3", None)]


def test_landed_files_are_listed_without_content(spark, tmp_path):
    write(tmp_path / "PERU", "📊 Ventas_20240101_000000.csv", "A\n1\n")
    df = landing.latest_snapshots(landing.landed_files(spark, str(tmp_path)))
    row = df.first()
    assert (row.PAIS, row.archivo, row.tabla) == ("PERU", "📊 Ventas_20240101_000000.csv", "VENTAS_PERU")
    assert rows(landing.read_csv(spark, landing.literal(row.path))) == [("1",)]
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_stream_reads_each_file_once(spark, tmp_path):
    drop, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    header = "Cód. Cliente;Cupo\n"
    write(tmp_path / "in/CHILE", "C_20240101_000000.csv", header + "1;10\n2;NULL\n")
    run = lambda: stream.ingest(spark, drop, "C_*.csv", target, checkpoint)
    run()
    write(tmp_path / "in/PERU", "C_20240101_000000.csv", header + "3;30\n4;40;9\n")
    write(tmp_path / "in/CHILE", "C_20240201_000000.csv", 'Cupo,Cód. Cliente,Nota\n50,5,"a\nb"\n')
    write(tmp_path / "in/CHILE", "other.csv", "x\n1\n")
    run()
    run()
    everything = stream.ingested(spark, target)
    got = sorted(rows(everything.select("PAIS", "COD_CLIENTE", "CUPO", "NOTA")), key=str)
    assert got == [
        ("CHILE", "1", "10", None),
        ("CHILE", "2", None, None),
        ("CHILE", "5", "50", "a\nb"),
        ("PERU", "3", "30", None),
    ]
    current = stream.current_rows(everything)
    assert sorted(rows(current.select("PAIS", "COD_CLIENTE"))) == [("CHILE", "5"), ("PERU", "3")]
    assert set(current.columns) == {"COD_CLIENTE", "CUPO", "NOTA", "PAIS"}


def test_jdbc_tables_are_read_in_slices(spark, monkeypatch):
    monkeypatch.setenv("ERP_PERU_URL", "jdbc:x")
    with pytest.raises(TypeError):
        jdbc.read_table(spark, "PERU", "T")
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "PERU", "T", "id", 5, 1)


def test_an_export_is_one_landed_file_per_country(spark, tmp_path):
    df = spark.createDataFrame([("CHILE", "a", 1), ("PERU", "b", 2)], "PAIS string, A string, N int")
    load.export(df.repartition(2), str(tmp_path), "Mis Ventas", datetime(2024, 1, 5))
    load.export(df.drop("PAIS").repartition(2), str(tmp_path / "ECUADOR"), "Mis Ventas", datetime(2024, 1, 5))
    landed = {(r.PAIS, r.archivo) for r in landing.landed_files(spark, str(tmp_path)).collect()}
    assert landed == {(c, "Mis_Ventas_20240105_000000.csv") for c in ("CHILE", "PERU", "ECUADOR")}
    assert {r.tabla for r in landing.latest_snapshots(landing.landed_files(spark, str(tmp_path))).collect()} == {
        "MIS_VENTAS_CHILE", "MIS_VENTAS_PERU", "MIS_VENTAS_ECUADOR"
    }


def test_records_are_counted_without_a_barcode_join(spark):
    lines = spark.createDataFrame([("1", "x")], "cProductoVta string, N string")
    codes = spark.createDataFrame([("1", "9", "EAN", "CHL")], "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string")
    read = lambda c, t: lines if t == extract.SALES_LINES else codes
    out = extract.extract(read, date(2024, 1, 1), [extract.SALES_LINES], ["CHILE"])
    records = out.records()
    assert "cProductoEquiv" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.registros, r.columnas) for r in records.collect()] == [(1, 3)]

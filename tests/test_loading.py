"""Type inference, accounts of loads, the inventory of deliveries, and the sweep of old table folders."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quipu.operators import infer, load, retention, runlog
from quipu.operators.account import Counter, Refused
from quipu.sources import landing, listing
from test_files import database, rows, write  # noqa: F401


def types(spark, *cells, name="x"):
    df = spark.createDataFrame([(c,) for c in cells], f"`{name}` string")
    return infer.infer_types(df).first().tipo


@pytest.mark.parametrize(
    "cells, kind",
    [
        (["true", "FALSE", None], "boolean"),
        (["1", "-20", "+0"], "bigint"),
        (["1", "true"], "string"),
        (["999999999999999999"], "bigint"),
        (["9999999999999999999"], "decimal(19,0)"),
        (["1.50", "-200"], "decimal(5,2)"),
        (["0.000", "0"], "decimal(4,3)"),
        (["1" * 38], "decimal(38,0)"),
        (["1" * 39], "string"),
        (["1" * 30 + ".5", "0." + "1" * 20], "string"),
        (["1e5", "2.5"], "double"),
        (["5.", ".5", "1"], "double"),
        (["e5"], "string"),
        (["."], "string"),
        (["007", "1"], "string"),
        (["1,5"], "string"),
        ([" 1"], "string"),
        (["2024-02-29", "1999-12-31"], "date"),
        (["2023-02-29"], "string"),
        (["2024-02-29", "2024-02-29 10:00:00"], "timestamp_ntz"),
        (["2024-02-29T10:00:00.25"], "timestamp_ntz"),
        (["2024-02-29 25:00:00"], "string"),
        (["2024-02-29", "5"], "string"),
        ([None, None], "string"),
        ([], "string"),
        (["table", "true"], "string"),
        (["é"], "string"),
        (["1\n"], "string"),
    ],
)
def test_types(spark, cells, kind):
    assert types(spark, *cells) == kind


@pytest.mark.parametrize("name", ["EAN", "Ruc", "COD_CLIENTE", "NUMERODOCUMENTO"])
def test_codes_stay_text(spark, name):
    assert types(spark, "1", "2", name=name) == "string"


def test_states_of_parts_merge_into_the_state_of_all(spark):
    cells = ["1", "2.25", None, "300", "x", "2024-01-01", "true", "1e3"]
    df = spark.range(400).select(
        (F.col("id") % 3).alias("part"),
        F.element_at(F.array(*[F.lit(c) for c in cells]), (F.col("id") % 4 + 1).cast("int")).alias("a"),
        F.element_at(F.array(*[F.lit(c) for c in cells]), (F.col("id") % 8 + 1).cast("int")).alias("b.c"),
    )
    whole = {r.columna: r.asDict() for r in infer.cell_states(df).collect()}
    parts = infer.cell_states(df, by=["part"])
    assert parts.count() == 6
    names = ("celdas", *infer.RUNGS, *infer.WIDTHS)
    for r in infer.merged(parts).collect():
        assert {n: r[n] for n in names} == {n: whole[r.columna][n] for n in names}
    assert infer.inferred(infer.merged(parts)) == {"a": "decimal(5,2)"}


def test_one_scan_and_one_partial_aggregate(spark, tmp_path):
    df = spark.range(50).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(12)])
    df.write.parquet(f"{tmp_path}/t")
    plan = infer.infer_types(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Aggregate(") + plan.count("Aggregate (") <= 2
    assert plan.count("partial_") > 0


def test_load_typed_loses_no_cell(spark):
    data = [("1", "1.5", "2024-01-01", "x", None, "01"), (None, "20", None, "1", None, "2"), ("3", "0.25", "2024-01-02", "", None, "3")]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string")
    out = infer.load_typed(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "decimal(4,2)", "c": "date", "d": "string", "e": "string", "f": "string"}
    assert rows(out)[0] == (1, Decimal("1.50"), date(2024, 1, 1), "x", None, "01")
    assert rows(infer.load_typed(df, infer.cell_states(df))) == rows(out)
    sent = {r.columna: r.tipo for r in infer.warehouse_schema(out).collect()}
    assert sent["a"] == "INTEGER" and sent["b"] == "DECIMAL(4,2)" and sent["c"] == "DATE" and sent["d"] == "VARCHAR"


RAGGED = "Cod,Monto,Fecha\n1,5,2024-01-01\n2,x,2024-01-02\n3,7\n4,8,2024-01-03,9\n5,,nunca\n"


def test_account_of_every_row(spark, tmp_path):
    marked = landing.read_marked(spark, write(tmp_path, "a.csv", RAGGED))
    counter = Counter(marked, {"MONTO": "int", "FECHA": "date", "COD": "int"})
    counter.rows.write.parquet(f"{tmp_path}/out")
    found = counter.account()
    assert (found.read, found.long, found.short, found.loaded) == (5, 1, 1, 4)
    assert found.invalid == {"MONTO": 1, "FECHA": 1} and found.invalid_cells == 2
    found.check(2)
    with pytest.raises(Refused, match="1 in FECHA, 1 in MONTO"):
        found.check(1)


def test_account_over_splits_and_headers(spark, tmp_path):
    body = "".join(f"{i},{i if i % 10 else 'x'},2024-01-01{',z' if i % 7 == 0 else ''}\n" for i in range(2000))
    write(tmp_path / "d", "a.csv", "Cod,Monto,Fecha\n" + body)
    write(tmp_path / "d", "b.csv", "Cod;Fecha;Monto\n1;2024-01-01;y\n2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        counter = Counter(landing.read_marked(spark, f"{tmp_path}/d"), {"MONTO": "int"})
        counter.rows.write.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = counter.account()
    over = [i for i in range(2000) if i % 7 == 0]
    assert (found.read, found.long, found.short) == (2002, len(over), 1)
    assert found.invalid == {"MONTO": 1 + sum(i % 10 == 0 and i % 7 != 0 for i in range(2000))}
    assert spark.read.parquet(f"{tmp_path}/out").count() == found.loaded


def test_refused_load_leaves_table_and_no_folder(spark, tmp_path, database):  # noqa: F811
    good = write(tmp_path / "CHILE", "V_20240101_000000.csv", "A,B\n1,2\n")
    bad = write(tmp_path / "CHILE", "V_20240201_000000.csv", "A,B\n1,x\n2,3\n4,5,6\n")
    declared = {"B": "int"}
    assert load.load_counted(spark, good, database, "V", declared)[0]
    with pytest.raises(Refused):
        load.load_counted(spark, bad, database, "V", declared)
    assert rows(spark.table(f"{database}.V")) == [("1", 2)]
    loaded, found = load.load_counted(spark, bad, database, "V", declared, max_invalid=1)
    assert loaded and (found.read, found.long, found.loaded, found.invalid) == (3, 1, 2, {"B": 1})
    assert retention.orphans(spark, f"{tmp_path}/db", [database]).count() == 0


def test_landing_with_inference_and_records_for_all_files(spark, tmp_path, database):  # noqa: F811
    write(tmp_path / "in/CHILE", "Ventas_20240301_000000.csv", "A,EAN,Dia\n1,7,2024-01-01\n2.5,8,2024-01-02\n")
    write(tmp_path / "in/CHILE", "Malo_20240101_000000.csv", "A,B\n1,x\n1,2,3\n2\n")
    write(tmp_path / "in/PERU", "Nada_20240101_000000.csv", "")
    write(tmp_path / "in/PERU", "Vacio_20240101_000000.csv", "A,EAN\n")
    found = load.load_landing(spark, f"{tmp_path}/in", database, declared={"MALO": {"B": "int"}}, infer=True)
    got = {r.tabla: r for r in found.collect()}
    assert set(got) == {"VENTAS_CHILE", "MALO_CHILE", "NADA_PERU", "VACIO_PERU"}
    assert dict(spark.table(f"{database}.VENTAS_CHILE").dtypes) == {"A": "decimal(2,1)", "EAN": "string", "DIA": "date"}
    assert (got["VENTAS_CHILE"].filas_leidas, got["VENTAS_CHILE"].filas_cargadas) == (2, 2)
    assert "no header" in got["NADA_PERU"].error and not got["NADA_PERU"].exito
    assert "1 in B" in got["MALO_CHILE"].error
    assert got["VACIO_PERU"].error is None and not got["VACIO_PERU"].exito
    assert {r.estado: r.archivos for r in runlog.load_states(found).collect()} == {"exitoso": 1, "error": 2, "omitido": 1}


def test_inventory_holds_every_delivery(spark, tmp_path):
    write(tmp_path / "CHILE", "a b%.csv", "x\n")
    write(tmp_path / "CHILE/deep", "b.csv", "")
    write(tmp_path / "CHILE", "note.txt", "x")
    write(tmp_path / "CHILE", "_hidden.csv", "x")
    write(tmp_path / "CHILE/_temporary", "c.csv", "x")
    write(tmp_path, "loose.csv", "12345")
    write(tmp_path / "R_20240101_000000.csv/PAIS=PERU", "part-0.csv", "abc")
    write(tmp_path / "R_20240101_000000.csv/PAIS=PERU", "part-1.csv", "de")
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        found = {(r.PAIS, r.archivo, r.bytes, r.vacio) for r in listing.inventory(spark, root).collect()}
        assert found == {
            ("CHILE", "a b%.csv", 2, False),
            ("deep", "b.csv", 0, True),
            (tmp_path.name, "loose.csv", 5, False),
            ("PERU", "R_20240101_000000.csv", 5, False),
        }
    paths = {r.path for r in listing.inventory(spark, str(tmp_path)).where("not vacio").collect()}
    assert paths == {r.path for r in landing.landed_files(spark, str(tmp_path)).collect()}
    assert listing.listed(spark, str(tmp_path)).rdd.getNumPartitions() == 3


def test_sweep_after_grace(spark, tmp_path):
    root = f"{tmp_path}/kept-{'a' * 32}"  # named as a version of something is
    database = "t_sweep"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    try:
        swept(spark, root, database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def swept(spark, root, database):
    for n in range(5):
        load.replace_with_backup(spark, spark.range(n + 1), database, "T")
    load.replace_with_backup(spark, spark.range(0), database, "T")
    spark.range(3).write.parquet(f"{root}/else/where-{'1' * 32}")
    spark.range(3).write.parquet(f"{root}/other-{'0' * 32}/_temporary/0")  # what a load that died left behind
    now = datetime.now(timezone.utc) + timedelta(minutes=1)
    assert retention.sweep(spark, root, [database], now).count() == 0
    gone = retention.sweep(spark, root, [database], now, grace=timedelta(0))
    assert gone.count() == 4
    assert retention.orphans(spark, root, [database]).count() == 0 and retention.versions(spark, root).count() == 2
    assert spark.table(f"{database}.T").count() == 5 and spark.table(f"{database}.T_OLD").count() == 4

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions import names

HEADERS = {
    "Cod. Cliente": "COD_CLIENTE",
    "Razón Social": "RAZON_SOCIAL",
    "Número Cliente": "NUMERO_CLIENTE",
    "Fill Rate %": "FILL_RATE_%",
    "% Diferencia": "%_DIFERENCIA",
    "Razón": "RAZON",
    "Razon": "RAZON_SOCIAL",
    " Razon ": "RAZON",
    "TC": "TIPO_CAMBIO",
    "Rebate Fact.": "REBATE_FACT",
    "Fecha Emision": "FECHA_EMISION",
    "  a--b..c  ": "A_B_C",
    "Año Fiscal": "ANO_FISCAL",
}

TABLES = {
    "MAEGC_PRODUCTO_CHILE_normalizado.csv": "MAEGC_PRODUCTO_CHILE",
    "👥_Listar_Clientes_CHILE_normalizado.csv": "LISTAR_CLIENTES_CHILE",
    "📊_Reporte_Único_de_Ventas_CHILE_normalizado.csv": "REPORTE_UNICO_DE_VENTAS_CHILE",
}

FILES = {
    "Año_Fiscal": "ANO_FISCAL",
    "Región-País": "REGION_PAIS",
    "Venta/Día.csv": "VENTA_DIA_CSV",
    "¿Qué? [漢字] a&b": "QUE_A_B",
    "x" * 200: "X" * 128,
    "a" * 127 + "_b": "A" * 127,
}

SNAPSHOTS = {
    ("X_20260122_143025_normalizado.csv", "CHILE"): "X_CHILE_normalizado.csv",
    ("X_CHILE_20260122_143025_normalizado.csv", "CHILE"): "X_CHILE_normalizado.csv",
    ("A_PERU_B_20260101_000000_20260102_000000_normalizado.csv", "PERU"): "A_B_PERU_normalizado.csv",
}


@pytest.mark.parametrize("raw,name", HEADERS.items())
def test_header(raw, name):
    assert names.normalize_header(raw) == name


@pytest.mark.parametrize("raw,name", TABLES.items())
def test_table(raw, name):
    assert names.table_name(raw) == name


@pytest.mark.parametrize("raw,name", FILES.items())
def test_file(raw, name):
    assert names.ascii_name(raw) == name


@pytest.mark.parametrize("raw,name", SNAPSHOTS.items())
def test_snapshot(raw, name):
    assert names.snapshot_name(*raw) == name


def test_column_forms_agree_with_python(spark):
    def check(pairs, python, column):
        df = spark.createDataFrame([(r,) for r in pairs], "raw string")
        got = {r.raw: r.out for r in df.withColumn("out", column(F.col("raw"))).collect()}
        assert got == {r: python(r) for r in pairs}

    check(HEADERS, names.normalize_header, names.normalize_header_of)
    check(TABLES, names.table_name, names.table_name_of)
    check(FILES, names.ascii_name, names.ascii_name_of)
    df = spark.createDataFrame(list(SNAPSHOTS), "f string, c string")
    got = {
        (r.f, r.c): r.out
        for r in df.withColumn("out", names.snapshot_name_of(F.col("f"), F.col("c"))).collect()
    }
    assert got == SNAPSHOTS


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("aÁñ ._-%1Z\tüÇé"), max_size=12), min_size=1, max_size=40))
def test_column_headers_on_random_text(spark, raws):
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    out = df.select("raw", names.normalize_header_of(F.col("raw")).alias("o")).collect()
    assert all(r.o == names.normalize_header(r.raw) for r in out)


def test_stamp(spark):
    df = spark.createDataFrame([("a_20260101_010101_20260202_020202.csv",), ("plain.csv",)], "f string")
    stamps = [r[0] for r in df.select(names.snapshot_stamp_of(F.col("f"))).collect()]
    assert stamps == ["20260202_020202", ""]


@pytest.mark.parametrize(
    "given_names,expected",
    [
        (["Nombre", "Dirección", "Dirección", "Teléfono"], ["Nombre", "Dirección", "Dirección_1", "Teléfono"]),
        (["A", "A", "A"], ["A", "A_1", "A_2"]),
        (["A", "A", "A_1"], ["A", "A_2", "A_1"]),
        (["a", "A"], ["a", "A_1"]),
        ([], []),
    ],
)
def test_disambiguate(given_names, expected):
    assert names.disambiguate(given_names) == expected


def test_mapped_headers_may_collide(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("Razon", "Razón Social")
    assert names.normalize_columns(df).columns == ["RAZON_SOCIAL", "RAZON_SOCIAL_1"]


@pytest.mark.parametrize(
    "data_type,name",
    [
        (T.LongType(), "INTEGER"),
        (T.DecimalType(19, 5), "DECIMAL(19,5)"),
        (T.DoubleType(), "FLOAT"),
        (T.BooleanType(), "BOOLEAN"),
        (T.TimestampNTZType(), "TIMESTAMP_NTZ"),
        (T.DateType(), "DATE"),
        (T.StringType(), "VARCHAR"),
        (T.ArrayType(T.IntegerType()), "VARCHAR"),
    ],
)
def test_warehouse_type(data_type, name):
    assert names.warehouse_type(data_type) == name


def test_quote_ident():
    assert names.quote_ident("a`b c") == "`a``b c`"

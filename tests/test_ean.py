import pytest
from pyspark.sql import functions as F

from quipu.demo.fixtures import erp
from quipu.operators.ean import ean_coverage, product_column, with_ean

PAIRS = [
    ("P1  ", "7802 ", "EAN12", "CL"),
    ("P1", "7801", "EAN12", "CL"),
    ("P1", "7801", "EAN12", "CL"),
    ("P2", "999", "DUN14", "CL"),
    ("P3", "775", "EAN12", "PE"),
]


@pytest.fixture
def equiv(spark):
    return spark.createDataFrame(PAIRS, "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string")


def sales(spark, rows, schema="ITEMNMBR string, n int"):
    return spark.createDataFrame(rows, schema)


def test_one_barcode_per_row(spark, equiv):
    df = sales(spark, [(" P1 ", 1), ("P2", 2), ("P3", 3), (None, 4), ("None", 5)])
    assert {(r.n, r.EAN) for r in with_ean(df, equiv).collect()} == {(1, "7801"), (2, ""), (3, ""), (4, ""), (5, "")}


def test_fanout_repeats_rows(spark, equiv):
    df = sales(spark, [("P1", 1)])
    assert sorted(r.EAN for r in with_ean(df, equiv, fanout=True).collect()) == ["7801", "7802"]
    raw = with_ean(df, equiv, fanout=True, distinct=False).collect()
    assert sorted(r.EAN for r in raw) == ["7801", "7801", "7802"]


def test_country_from_argument_or_column(spark, equiv):
    df = sales(spark, [("P3", 1)])
    assert with_ean(df, equiv, country="PERU").first().EAN == "775"
    tagged = df.withColumn("PAIS", F.lit("PERU"))
    assert with_ean(tagged, equiv).first().EAN == "775"
    unknown = df.withColumn("PAIS", F.lit("BOLIVIA"))
    assert with_ean(unknown, equiv).first().EAN == ""


def test_column_order_and_names_stay(spark, equiv):
    df = sales(spark, [("P1", "x", 1)], "cProducto string, `a.b` string, n int")
    assert with_ean(df, equiv).columns == ["cProducto", "a.b", "n", "EAN"]


def test_preferred_product_column(spark):
    df = spark.createDataFrame([("a", "b")], "ITEMNMBR string, cProducto string")
    assert product_column(df) == "cProducto"


def test_no_product_column_and_empty_input(spark, equiv):
    assert with_ean(sales(spark, [(1,)], "n int"), equiv).first().EAN == ""
    empty = with_ean(sales(spark, [], "ITEMNMBR string, n int"), equiv)
    assert empty.columns == ["ITEMNMBR", "n", "EAN"] and empty.isEmpty()


def test_enrichment_keeps_the_row_count(spark, sf):
    tables = erp(spark, sf, "SOP30300", "maeGC_ProductoEquiv")
    assert with_ean(tables["SOP30300"], tables["maeGC_ProductoEquiv"]).count() == tables["SOP30300"].count()


def test_coverage(spark):
    df = spark.createDataFrame([("x",), ("",), (None,), ("y",)], "EAN string")
    assert tuple(ean_coverage(df).first()) == (4, 2, 50.0)
    assert tuple(ean_coverage(df.limit(0)).first()) == (0, 0, 0.0)

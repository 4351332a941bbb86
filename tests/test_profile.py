import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quipu.operators import facets, profile, quartiles


def described(df, **options):
    return {r.columna: r for r in profile.describe_numeric(df, **options).collect()}


def check(df, pdf, **options):
    got = described(df, **options)
    for name in pdf.columns:
        want = pdf[name].astype(float).describe()
        r = got[name]
        mine = [r.filas, r["mean"], r["std"], r["min"], r.p25, r.p50, r.p75, r["max"]]
        assert mine == pytest.approx(list(want), rel=1e-9, abs=1e-9), name


@pytest.mark.parametrize("accuracy,tally", [(20_000, 1_000_000), (20, 50), (10, 5)])
def test_describe_is_exact(spark, accuracy, tally):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        hot = 5.0 if i % 3 == 0 else rng.gauss(0, 100)  # a third of all rows is one value
        rows.append((i, hot, rng.choice([1, 1, 1, 2]), None if i % 4 else rng.random()))
    pdf = pd.DataFrame(rows, columns=["i", "hot", "few", "gaps"])
    df = spark.createDataFrame(rows, "i long, hot double, few int, gaps double").repartition(5)
    check(df, pdf, accuracy=accuracy, tally_rows=tally)


def test_describe_interpolates_and_skips_text_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (float("nan"), "c"), (4.0, "d"), (7.0, None)], "x double, t string")
    got = described(df)
    assert list(got) == ["x"]
    assert (got["x"].filas, got["x"].p25, got["x"].p50, got["x"].p75) == (4, 1.75, 3.0, 4.75)


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "x double, y int")
    got = described(df)
    assert got["x"].filas == 0 and got["x"].p50 is None
    assert got["y"].p50 == 1.0 and got["y"]["std"] is None


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",), ("c",)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_distinct_values_keep_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("b",), ("a",)], "`odd name.` string")
    assert [r.valor for r in profile.distinct_values(df, "odd name.").collect()] == [None, "a", "b"]


def test_filters(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("odd"))
    assert profile.where_in(df, "id", [1, 2, 99]).count() == 2
    assert profile.where_all(df, {"odd": 1, "id": None}).count() == 5
    assert profile.where_all(df, {"odd": None}).count() == 10


def test_run_sql_binds_parameters(spark):
    row = profile.run_sql(spark, "SELECT :name AS n", name="x'; DROP TABLE t").first()
    assert row.n == "x'; DROP TABLE t"


def test_tables_by_country(spark):
    names = ["A_CHILE", "B_PERU", "C", "A_CHILE_OLD", "XGOLD", "D_PERU_X"]
    df = spark.createDataFrame([(n,) for n in names], "tabla string")
    got = {tuple(r) for r in profile.tables_by_country(df).collect()}
    assert got == {("CHILE", "A_CHILE"), ("PERU", "B_PERU"), ("OTROS", "C"), ("OTROS", "XGOLD"), ("OTROS", "D_PERU_X")}


def test_preview_and_counts(spark):
    df = spark.range(50).toDF("id")
    assert [r.id for r in profile.preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    counts = profile.table_counts({"a": df, "b": df.limit(0)}).collect()
    assert {tuple(r) for r in counts} == {("a", 50, 1), ("b", 0, 1)}


def exact(values, ranks):
    import numpy as np

    ordered = np.sort(np.array(values, float))
    return {r: float(ordered[r]) for r in ranks}


def test_order_keys_are_in_order_and_exact(spark):
    import math
    import struct

    rng = random.Random(3)
    values = [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, s) for e in range(-1020, 1023) for s in (0.0, math.inf)]
    values += [struct.unpack(">d", rng.getrandbits(64).to_bytes(8, "big"))[0] for _ in range(4000)]
    values += [0.0, math.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.1, 1e22, 123456.789]
    values = [v for v in values if v == v]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", quartiles.order_key(F.col("x")).alias("k")).collect()
    for r in got:
        bits = int.from_bytes(struct.pack(">d", abs(r.x)), "big")
        assert r.k == (bits if r.x >= 0 else -bits - 1), r.x
        assert quartiles.value_of(r.k) == r.x


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_order_statistics(spark, few):
    rng = random.Random(5)
    close = [1.0 + i * 2.0**-50 for i in range(2000)]  # they differ in their last bits only
    wide = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(2000)]
    hot = [7.0 if i % 3 else float(i) for i in range(2000)]
    rows = list(zip(close, wide, hot))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "close double, wide double, hot double").repartition(3)
    ranks = {"close": [0, 1, 999, 1000, 1999], "wide": [0, 500, 1500], "hot": [10, 11, 1000]}
    found = quartiles.order_statistics(df, ranks, few)
    for column, values in (("close", close), ("wide", wide), ("hot", hot)):
        assert {r: found[column, r] for r in ranks[column]} == exact(values, ranks[column])


def test_at_most_five_scans_whatever_the_values(spark, tmp_path):
    close = spark.range(20_000).select((F.lit(1.0) + F.col("id") * 2.0**-45).alias("x"), F.col("id").cast("double").alias("y"))
    close.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    seen = []
    whole = quartiles._counted

    def counted(*args):
        seen.append(args[3])
        return whole(*args)

    quartiles._counted = counted
    try:
        got = described(df, tally_rows=0)
    finally:
        quartiles._counted = whole
    assert seen == [16, 16, 16, 16] and got["y"].p50 == 9999.5


def test_describe_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf,), (-inf,), (1.0,), (inf,), (inf,)], "x double")
    r = described(df)["x"]
    assert (r.p25, r.p50, r.p75, r["max"]) == (-inf, 1.0, inf, inf)


def counted(rows, names, top):
    from collections import Counter

    out = set()
    for i, n in enumerate(names):
        tally = Counter(str(r[i]) for r in rows if r[i] is not None)
        shown = sorted(tally.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
        out |= {(n, v, c, k) for k, (v, c) in enumerate(shown, 1)}
    return out


def test_facets(spark):
    rng = random.Random(11)
    names = ["hot", "few", "key", "none", "odd.name", "tied"]
    rows = [
        (rng.choice([1, 1, rng.randrange(2000)]), rng.choice("abc"), i, None, rng.choice(["é", "", None, "x y"]), i % 25)
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "hot int, few string, key int, none string, `odd.name` string, tied int").repartition(3)
    for top in (3, 10):
        got = {tuple(r) for r in facets.facets(df, top=top).collect()}
        assert got == counted(rows, names, top)
    assert facets.facets(df.limit(0)).count() == 0
    assert {r.columna for r in facets.facets(df, ["few"]).collect()} == {"few"}


def test_facets_prove_what_they_show(spark):
    """A sketch too small for a column is found out, not believed."""
    rng = random.Random(2)
    values = [v for v in range(3000) for _ in range(1 + (v % 7 == 0))]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(2)
    got = {tuple(r) for r in facets.facets(df, top=5, tracked=200).collect()}
    assert got == counted([(v,) for v in values], ["v"], 5)

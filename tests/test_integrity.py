import hashlib
import re
from collections import Counter
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipu.operators import drift, integrity

ROW = st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]))


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def mark(df):
    return tuple(integrity.fingerprint(df).first())


def test_fingerprint_ignores_order_partitions_and_column_order(spark):
    df = spark.range(1000).select("id", (F.col("id") * 0.1).alias("x"), F.lit(None).cast("string").alias("n"))
    assert mark(df) == mark(df.repartition(7).orderBy(F.desc("id")).select("n", "x", "id"))


def test_fingerprint_sees_repeats_nulls_and_changes(spark):
    base = [(1, "a"), (2, None)]
    marks = {
        mark(table(spark, rows))
        for rows in (base, [*base, base[0]], [*base, base[0], base[0]], [(1, "a"), (2, "")], [(1, None), (2, "a")], [])
    }
    assert len(marks) == 6


def test_fingerprint_ignores_float_noise(spark):
    a = spark.createDataFrame([(0.1 + 0.2,)], "x double")
    b = spark.createDataFrame([(0.3,)], "x double")
    assert mark(a) == mark(b)


def brute(old, new):
    """Multiset comparison per key, in plain Python."""
    was, now = Counter(old), Counter(new)
    kept, gone, come = was & now, was - now, now - was
    out = {}
    for key in {r[0] for r in [*old, *new]}:
        pick = lambda c: sum(n for r, n in c.items() if r[0] == key)
        changed = min(pick(gone), pick(come))
        out[key] = (pick(kept), changed, pick(come) - changed, pick(gone) - changed)
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, max_size=12), st.lists(ROW, max_size=12))
def test_snapshot_changes_against_brute_force(spark, old, new):
    got = integrity.snapshot_changes(table(spark, old), table(spark, new), ["k"]).collect()
    assert {r.k: tuple(r)[1:] for r in got} == brute(old, new)


def test_verdicts(spark):
    old = table(spark, [(1, "a"), (1, "a"), (2, "b")])
    grown = table(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c")])
    fewer = table(spark, [(1, "a"), (2, "b")])
    assert integrity.snapshot_diff(old, grown, ["k"]).first().resultado == "OK"
    assert integrity.snapshot_diff(old, fewer, ["k"]).first().resultado == "MODIFICADO"
    assert integrity.snapshot_diff(old.limit(0), old.limit(0), ["k"]).first().resultado == "OK"


def test_control_history(spark):
    history = spark.createDataFrame([], integrity.HISTORY)
    snapshots = [[(1, "a")], [(1, "a"), (2, "b")], [(1, "z"), (2, "b")]]
    previous = None
    for day, rows in enumerate(snapshots, 1):
        new = table(spark, rows)
        entry = integrity.control(new, "PERU", "T", history, datetime(2024, 1, day), previous, ["k"])
        history = spark.createDataFrame([*history.collect(), *entry.collect()], integrity.HISTORY)
        previous = new
    rows = history.orderBy("version").collect()
    assert [r.estado for r in rows] == ["inicial", "actualizado_incremental", "modificacion_detectada"]
    assert [r.version for r in rows] == [1, 2, 3]
    assert tuple(integrity.history_metrics(history).first()) == (3, 1, 6, 1)
    stats = integrity.history_stats(history).first()
    assert stats.ultima_actualizacion == datetime(2024, 1, 3)
    assert integrity.history_filter(history, state="inicial").count() == 1
    assert integrity.history_filter(history).count() == 3
    assert integrity.last_version(history, "CHILE", "T") == 0


def test_key_columns(spark):
    df = spark.createDataFrame([], "a int, FechaDoc date, update_no int, x double")
    assert integrity.key_columns(df) == ["FechaDoc", "update_no"]
    assert integrity.float_columns(df) == ["x"]
    assert integrity.key_columns(df.select("x", "a")) == ["x", "a"]


def test_schema_drift(spark):
    same = spark.createDataFrame([(1, 2)], "a int, b int")
    frames = {"CHILE": same, "PERU": same.drop("b"), "ECUADOR": same.withColumn("z", F.lit(1))}
    got = {tuple(r) for r in drift.schema_drift(frames, "T").collect()}
    assert got == {
        ("PERU", "T", "b", "COLUMN_MISSING", 1, 1),
        ("ECUADOR", "T", "z", "COLUMN_EXTRA", 3, 1),
    }
    declared = drift.schema_drift({"CHILE": same}, "T", ["a", "c"])
    assert {(r.columna, r.kind) for r in declared.collect()} == {("c", "COLUMN_MISSING"), ("b", "COLUMN_EXTRA")}
    assert drift.schema_drift({"CHILE": same, "PERU": same}, "T").isEmpty()


def test_a_schema_change_is_a_modification(spark):
    old = spark.createDataFrame([(1, "a", "x")], "k int, v string, w string")
    assert integrity.snapshot_diff(old, old.drop("w"), ["k"]).first().resultado == "MODIFICADO"
    new = old.selectExpr("*", "1 AS added")
    assert integrity.snapshot_diff(old, new, ["k", "added"]).first().resultado == "MODIFICADO"


def test_separators_within_cells_do_not_make_rows_equal(spark):
    one = spark.createDataFrame([("a\x1fb", "c")], "p string, q string")
    two = spark.createDataFrame([("a", "b\x1fc")], "p string, q string")
    assert integrity.fingerprint(one).first() != integrity.fingerprint(two).first()


@pytest.mark.parametrize("copies", [1, 5])
def test_fingerprint_of_every_kind_of_row_in_plain_python(spark, copies):
    """Rows with and without nulls, few columns and many; the parts of a digest are summed without decimals."""
    def cell(value):
        return "-" if value is None else f"{len(value)}:{value}"

    data = [(i, None if i % 3 == 0 else "ñandú" * (i % 4), None if i % 5 == 0 else f"{i}.50000", f"2024-01-{1 + i % 28:02d}") for i in range(200)]
    df = spark.createDataFrame(data, "n int, s string, m string, d string")
    kinds = {"n": "int", "s": "string", "m": "decimal(19,5)", "d": "date"}
    df = df.select(*[F.col(c).cast(t).alias(f"{c}{k}") for k in range(copies) for c, t in kinds.items()])
    assert copies == 1 or len(df.columns) > integrity.FLAT
    found = integrity.fingerprints(df, [F.col("d0")])
    sums = {}
    for n, s, m, d in data:
        values = {"n": str(n), "s": s, "m": m, "d": d}
        text = integrity.SEPARATOR.join(cell(values[c[0]]) for c in sorted(df.columns))
        digest = hashlib.sha256(text.encode()).hexdigest()
        a, b = int(digest[:15], 16), int(digest[15:30], 16)
        rows, a0, b0, x = sums.get(d, (0, 0, 0, 0))
        sums[d] = (rows + 1, a0 + a, b0 + b, x ^ a)
    want = {d: hashlib.sha256(integrity.SEPARATOR.join(map(str, v)).encode()).hexdigest() for d, v in sums.items()}
    assert {str(r._g0): r.hash_sha256 for r in found.collect()} == want
    partial = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "partial_sum" in x]
    assert partial and not any(re.search(r"partial_sum\(cast\(\w+#\d+L? as decimal", x) for x in partial)

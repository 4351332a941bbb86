"""Controlled extraction, the rolling store, slices of equal depth, cached SQL, and the stream of newest snapshots."""

import re
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quipu.operators import cache, control, integrity, rolling
from quipu.operators.load import full_name
from quipu.sources import slices
from quipu.sources.erp import rolling_scan
from quipu.streaming import current
from test_files import database, rows, write  # noqa: F811, F401


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


SALES = "PAIS string, doc string, linea int, fecha date, monto double, nota string"
FIRST = [("CHILE", f"D{i}", i % 3, date(2024, 1 + i % 6, 1 + i % 28), i / 7, None if i % 5 else "x") for i in range(300)]
FIRST += [(p, d.replace("D", "E"), n, f, m, t) for _, d, n, f, m, t in FIRST for p in ("PERU", "ECUADOR")]
KEYS = ["doc", "linea"]


def extraction(spark, data):
    return spark.createDataFrame(data, SALES).repartition(3)


def records(df):
    return {r.pais: r for r in df.collect()}


def test_control_of_two_extractions(spark, tmp_path):
    root = f"{tmp_path}/x"
    one = records(control.control_run(spark, extraction(spark, FIRST), root, "VENTAS", datetime(2024, 7, 1), KEYS))
    assert {r.estado for r in one.values()} == {"inicial"} and {r.version for r in one.values()} == {1}
    assert one["CHILE"].agregadas == 300 and one["CHILE"].meses == 6

    second = []
    for pais, doc, linea, fecha, monto, nota in FIRST:
        if pais == "CHILE" and fecha.month == 3:
            monto += 1.0  # a month whose amounts changed
        if pais == "PERU" and int(doc[1:]) % 12 == 4:
            continue  # half of the rows of May went
        second.append((pais, doc, linea, fecha, monto, nota))
    second += [("ECUADOR", f"N{i}", 0, date(2024, 6, 3), 1.0, None) for i in range(10)]
    second += [("ECUADOR", f"N{i}", 0, date(2024, 7, 3), 1.0, None) for i in range(20)]
    two = records(control.control_run(spark, extraction(spark, second), root, "VENTAS", datetime(2024, 7, 2), KEYS))
    in_march = sum(f.month == 3 for p, *_, f, _, _ in FIRST if p == "CHILE")
    in_may = sum(int(d[1:]) % 12 == 4 for p, d, *_ in FIRST if p == "PERU")
    figures = lambda r: (r.estado, r.version, r.meses_comparados, r.iguales, r.modificadas, r.agregadas, r.eliminadas)
    assert figures(two["CHILE"]) == ("modificacion_detectada", 2, 1, 300 - in_march, in_march, 0, 0)
    assert figures(two["PERU"]) == ("modificacion_detectada", 2, 1, 300 - in_may, 0, 0, in_may)
    assert figures(two["ECUADOR"]) == ("actualizado_incremental", 2, 1, 300, 0, 30, 0)
    assert two["ECUADOR"].meses == 7 and two["ECUADOR"].archivo.endswith("_corrida=20240702_000000/PAIS=ECUADOR")

    three = records(control.control_run(spark, extraction(spark, second), root, "VENTAS", datetime(2024, 7, 3), KEYS))
    assert all(r.version == 3 and r.meses_comparados == 0 for r in three.values())
    assert {r.estado for r in three.values()} == {"actualizado_incremental"}
    assert {p: r.hash_sha256 for p, r in three.items()} == {p: r.hash_sha256 for p, r in two.items()}
    history = control.history(spark, root)
    assert history.count() == 9
    assert integrity.history_metrics(history.select(*integrity.HISTORY.names)).first().modificaciones == 2


def test_only_changed_months_are_read(spark, tmp_path):
    root = f"{tmp_path}/x"
    for run, change in (("a", 0.0), ("b", 1.0)):
        df = extraction(spark, FIRST)
        raised = F.when((F.col("PAIS") == "PERU") & (F.month("fecha") == 2), F.col("monto") + change).otherwise(F.col("monto"))
        control.store(df.withColumn("monto", raised), root, "T", run, "fecha")
    before = control.stored(spark, root, "T", "a")
    df = control.changes(spark, root, "T", before, "b", [("PERU", "2024-02", "a")], KEYS, None)
    assert df.collect()[0].modificadas == sum(f.month == 2 for p, *_, f, _, _ in FIRST if p == "PERU")
    scans = [x for x in plan(df).splitlines() if "FileScan" in x]
    assert scans and all(re.search(r"PartitionFilters: \[.*PERU.*2024-02", x) for x in scans)
    files = lambda df: df.select("_metadata.file_path").distinct().count()
    assert files(before) == 18
    assert files(before.where((F.col("PAIS") == "PERU") & (F.col(control.MONTH) == "2024-02"))) == 1


def test_window_and_schema_and_rows_without_date(spark, tmp_path):
    root = f"{tmp_path}/x"
    data = [*FIRST, ("CHILE", "S", 0, None, 1.0, None)]
    control.control_run(spark, extraction(spark, data), root, "T", datetime(2024, 7, 1), KEYS)
    since = date(2024, 3, 10)
    kept = [r for r in data if r[3] is None or r[3] >= since]
    two = records(control.control_run(spark, extraction(spark, kept), root, "T", datetime(2024, 7, 2), KEYS, since=since))
    assert {r.estado for r in two.values()} == {"actualizado_incremental"}
    assert all(r.eliminadas == 0 and r.modificadas == 0 for r in two.values())
    wider = extraction(spark, kept).withColumn("mas", F.lit(1))
    three = records(control.control_run(spark, wider, root, "T", datetime(2024, 7, 3), KEYS, since=since))
    assert {r.estado for r in three.values()} == {"modificacion_detectada"}


def test_tables_without_country_or_date(spark, tmp_path):
    root = f"{tmp_path}/x"
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    for day, version in ((1, 1), (2, 2)):
        out = control.control_run(spark, df, root, "T", datetime(2024, 7, day))
        assert [(r.pais, r.version, r.iguales) for r in out.collect()] == [("", version, 10 if version > 1 else 0)]
    other = control.control_run(spark, df.limit(0), root, "U", datetime(2024, 7, 1))
    assert other.count() == 0


def test_digest_tree_does_not_depend_on_files_or_zone(spark, tmp_path):
    def roots(run, parts):
        df = extraction(spark, FIRST).withColumn("hora", F.col("fecha").cast("timestamp")).repartition(parts)
        control.store(df, f"{tmp_path}/{run}", "T", run, "fecha")
        return control.leaves(control.stored(spark, f"{tmp_path}/{run}", "T", run))

    one, two = roots("a", 1), roots("b", 7)
    assert sorted(rows(one)) == sorted(rows(two)) and one.count() == 18
    whole = rows(control.table_root(one))
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        assert rows(control.table_root(two)) == whole
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def day_table(spark, tmp_path, first, last, extra=()):
    data = [(f"D{i}", first + timedelta(days=i % 90), i) for i in range(900)]
    data = [r for r in data if r[1] <= last]
    return spark.createDataFrame([*data, *extra], "doc string, fecha date, n int")


def test_rolling_store_equals_a_rescan(spark, tmp_path, database):  # noqa: F811
    days, first = 30, date(2024, 1, 1)
    sources = []
    for k, as_of in enumerate((date(2024, 2, 10), date(2024, 2, 13), date(2024, 2, 25))):
        late = [(f"L{k}", as_of - timedelta(days=2), -1)] * k  # rows that come late, one of them twice
        df = day_table(spark, tmp_path, first, as_of, late)
        sources.append((as_of, df.where(F.col("fecha") != F.lit(as_of - timedelta(days=1))) if k == 1 else df))
    starts = []
    for as_of, df in sources:
        source = lambda since, df=df: df.where(F.col("fecha") >= F.lit(since))
        # what is older than the late days does not change in this source, as in a ledger
        start, gone = rolling.refresh(spark, source, database, "V", as_of, days, late=20)
        starts.append(start)
        got = rolling.window(spark, database, "V", as_of, days)
        assert Counter(rows(got)) == Counter(rows(rolling_scan(df, as_of, days)))
    assert starts[0] == date(2024, 1, 11) and starts[1] == date(2024, 1, 21)
    stored = rolling.days_of(spark, full_name(database, "V"))
    assert stored[0] >= date(2024, 2, 25) - timedelta(days=days)


def test_refresh_reads_and_writes_new_days_only(spark, tmp_path, database):  # noqa: F811
    first, as_of = date(2024, 1, 1), date(2024, 1, 20)
    path = f"{tmp_path}/source"
    day_table(spark, tmp_path, first, as_of).write.parquet(path)
    seen = []

    def source(since):
        df = spark.read.parquet(path).where(F.col("fecha") >= F.lit(since))
        seen.append(plan(df))
        return df

    rolling.refresh(spark, source, database, "V", as_of, 90)
    name = full_name(database, "V")
    old = {f for f in spark.table(name).where(f"{rolling.DAY} < '2024-01-18'").inputFiles()}
    rolling.refresh(spark, source, database, "V", as_of, 90, late=2)
    assert "GreaterThanOrEqual(fecha,2024-01-18)" in seen[1]
    assert old == {f for f in spark.table(name).where(f"{rolling.DAY} < '2024-01-18'").inputFiles()}
    assert spark.table(name).count() == 200
    assert len(rolling.expire(spark, name, date(2024, 1, 11))) == 10
    assert spark.table(name).agg(F.min("fecha")).first()[0] == date(2024, 1, 11)


def in_slices(spark, view, found):
    return [spark.sql(f"SELECT * FROM {view} WHERE {p}").count() for p in found]


def test_slices_are_equally_deep(spark):
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-02-02").cast("date")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")))
    third = F.when(F.col("id") % 11 != 0, F.col("id") % 1000)
    df = spark.range(3000).select(day.alias("d"), third.alias("k"), F.concat(F.lit("it's "), "id").alias("t"))
    df.union(spark.createDataFrame([(None, 1, "no date")], df.schema)).createOrReplaceTempView("source_rows")
    found = slices.equal_slices(spark.sql, "source_rows", ["d", "k", "t"], 7)
    sizes = in_slices(spark, "source_rows", found)
    assert len(found) == 7 and sum(sizes) == 3000 and max(sizes) == -(-3000 // 7)
    assert max(in_slices(spark, "source_rows", slices.equal_slices(spark.sql, "source_rows", ["d"], 7))) >= 1000
    some = slices.equal_slices(spark.sql, "source_rows", ["d", "t"], 4, where="k < 100")
    assert sum(in_slices(spark, "source_rows", some)) == df.where("k < 100").count()


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, None), (1, None), (1, 2)], [(i % 2, i) for i in range(5)]])
def test_slices_of_next_to_nothing(spark, data):
    spark.createDataFrame(data, "a int, b int").createOrReplaceTempView("few_rows")
    found = slices.equal_slices(spark.sql, "few_rows", ["a", "b"], 3)
    assert sum(in_slices(spark, "few_rows", found)) == len(data)


@pytest.mark.parametrize("per_range", [1, 40, 10_000])
def test_session_ranks_in_ranges_what_sql_ranks_in_one_task(spark, per_range):
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-02-02").cast("date")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")))
    third = F.when(F.col("id") % 11 != 0, F.col("id") % 5)
    df = spark.range(400).select(F.when(F.col("id") % 17 != 0, day).alias("d"), third.alias("k"), F.concat(F.lit("it's "), F.col("id") % 20).alias("t"))
    df.createOrReplaceTempView("ranked_rows")
    for columns, n, where in ((["d", "k", "t"], 7, ""), (["d"], 36, "k < 3 OR k IS NULL"), (["k", "d"], 1, ""), (["d"], 3, "k > 9")):
        theirs = spark.sql(slices.bounds_sql("ranked_rows", columns, n, where)).collect()
        mine = slices.ranked(spark, "ranked_rows", columns, n, where, per_range)
        assert sorted(mine, key=lambda r: r[0]) == sorted(map(tuple, theirs), key=lambda r: r[0])
        same = [slices.equal_slices(ask, "ranked_rows", columns, n, where) for ask in (spark, spark.sql)]
        assert same[0] == same[1]


def test_cached_sql(spark, tmp_path):
    path, kept = f"{tmp_path}/t", f"{tmp_path}/cache"
    spark.range(10).write.parquet(path)
    read = lambda: spark.read.parquet(path).createOrReplaceTempView("cached_rows")
    read()
    clock = [1000.0]
    ask = lambda text="SELECT sum(id) AS s FROM cached_rows WHERE id > :low", low=1: cache.cached_sql(
        spark, text, kept, 300, lambda: clock[0], low=low
    )
    first = ask()
    assert rows(first) == [(44,)] and path not in plan(first)
    assert ask().inputFiles() == first.inputFiles()
    assert ask("SELECT sum(id) s FROM  cached_rows  WHERE id > :low").inputFiles() == first.inputFiles()
    assert ask(low=5).inputFiles() != first.inputFiles() and rows(ask(low=5)) == [(30,)]
    clock[0] += 301
    assert ask().inputFiles() != first.inputFiles()
    spark.range(10, 12).write.mode("append").parquet(path)
    read()
    assert rows(ask()) == [(65,)]


def test_what_is_not_cached(spark, tmp_path):
    df = spark.range(3).select(F.rand().alias("x"))
    assert cache.cached(df, str(tmp_path)) is df
    assert cache.key_of(spark.range(3)) is not None
    twice = spark.range(3).select("id", "id")
    assert cache.cached(twice, str(tmp_path)) is twice


def land(folder, name, text):
    return write(folder, name, text)


def test_stream_keeps_the_newest_snapshot(spark, tmp_path):
    root, target, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    chile, peru = tmp_path / "in/CHILE", tmp_path / "in/PERU"
    run = lambda: current.stream_current(spark, root, "*.csv", target, checkpoint).awaitTermination()
    land(chile, "V_20240201_000000.csv", "A,B\n1,x\n2,y\n")
    land(peru, "V_20240301_000000.csv", "A\n9\n")
    run()
    got = lambda: {(r.PAIS, r._tabla, r.A, r.B) for r in current.current(spark, target).collect()}
    first = {("CHILE", "V", "1", "x"), ("CHILE", "V", "2", "y"), ("PERU", "V", "9", None)}
    assert got() == first
    land(chile, "V_20240101_000000.csv", "A,B\n0,old\n")  # stamped before, landed after
    land(chile, "W_20240101_000000.csv", "A,B\n5,w\n")
    run()
    assert got() == first | {("CHILE", "W", "5", "w")}
    land(chile, "V_20240401_000000.csv", "A,B\n3,new\n")
    run()
    run()
    assert got() == {("CHILE", "V", "3", "new"), ("PERU", "V", "9", None), ("CHILE", "W", "5", "w")}
    assert {r.sello for r in current.pointers(spark, target).collect()} == {"20240401_000000", "20240301_000000", "20240101_000000"}


def test_stream_repeats_a_killed_batch(spark, tmp_path, monkeypatch):
    root, target, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    chile = tmp_path / "in/CHILE"
    land(chile, "V_20240201_000000.csv", "A\n1\n")
    current.stream_current(spark, root, "*.csv", target, checkpoint).awaitTermination()
    land(chile, "V_20240301_000000.csv", "A\n2\n")
    whole = current.read_csv

    def dies(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(current, "read_csv", dies)
    with pytest.raises(Exception):
        current.stream_current(spark, root, "*.csv", target, checkpoint).awaitTermination()
    monkeypatch.setattr(current, "read_csv", whole)
    land(chile, "V_20240101_000000.csv", "A\n0\n")
    current.stream_current(spark, root, "*.csv", target, checkpoint).awaitTermination()
    assert [r.A for r in current.current(spark, target).collect()] == ["2"]


def test_controlled_extraction_of_listed_tables(spark, tmp_path):
    from quipu.sources.extract import controlled, extract

    def read(rows):
        def table(country, name):
            if name == "GONE" or (name == "B" and country == "PERU"):
                return None
            return spark.createDataFrame([r for r in rows if r[0] == (country, name)], "k struct<c:string,t:string>, id long, fecha date, v double").drop("k")

        return table

    rows = [((c, t), i, date(2024, 1 + i % 4, 5), float(i)) for c in ("CHILE", "PERU") for t in ("A", "B") for i in range(20)]
    run = lambda data, day: {
        (r.pais, r.tabla): r
        for r in controlled(
            extract(read(data), date(2024, 6, 1), ["A", "B", "GONE"], ["CHILE", "PERU"]),
            f"{tmp_path}/x", datetime(2024, 6, day), date(2024, 6, 1), keys={"A": ["id"], "B": ["id"]},
        ).collect()
    }
    one = run(rows, 1)
    assert {k: (r.estado, r.version, r.control) for k, r in one.items()} == {
        ("CHILE", "A"): ("OK", 1, "inicial"), ("PERU", "A"): ("OK", 1, "inicial"), ("CHILE", "B"): ("OK", 1, "inicial"),
        ("PERU", "B"): ("ERROR", None, None), ("CHILE", "GONE"): ("ERROR", None, None), ("PERU", "GONE"): ("ERROR", None, None),
    }
    assert all(len(r.hash_sha256) == 64 and r.archivo for r in one.values() if r.estado == "OK")
    two = run([(k, i, f, v + (k == ("PERU", "A") and i == 3)) for k, i, f, v in rows], 2)
    assert two["PERU", "A"].control == "modificacion_detectada" and two["PERU", "A"].version == 2
    assert two["CHILE", "A"].control == two["CHILE", "B"].control == "actualizado_incremental"
    assert two["CHILE", "A"].hash_sha256 == one["CHILE", "A"].hash_sha256


def test_a_report_of_ones_own(spark):
    from quipu.plans import registry

    report = registry.Report("Días  Hábiles", "cuenta", lambda erp, start, end: spark.range(3), True)
    registry.register(report)
    try:
        assert registry.run("dias habiles", None, date(2024, 1, 1), date(2024, 1, 2)).count() == 3
        with pytest.raises(ValueError):
            registry.run("DIAS HABILES", None)
    finally:
        del registry.REPORTS["Días  Hábiles"]

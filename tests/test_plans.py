"""What the plans do: filters in the scan, no cross joins, no Python rows, hot keys split."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from quipu.demo.fixtures import erp
from quipu.demo.queries import END, MOV, QUERIES, SOP, START
from quipu.operators.ean import with_ean
from quipu.operators.order import arrange
from quipu.plans import reports
from quipu.sources.erp import Erp, rolling_scan


PERIOD = (START, END)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


REPORTS = [
    "sales_ean",
    "sales_report",
    "sales_detail",
    "price_diff",
    "fill_rate",
    "receivables",
    "stock_lot",
    "control_accounts",
    "ean_enrich",
    "snapshot_changes",
    "content_drift",
    "latest_snapshot",
    "row_hash",
    "fingerprint",
]


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoop", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


@pytest.mark.parametrize("name", [n for n in REPORTS if n not in ("content_drift",)])
def test_no_broadcast_is_forced(spark, sf, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def stored(spark, tmp_path):
    """ERP tables stored by country, as a landing job leaves them."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    headers = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, "CHILE").otherwise("PERU").alias("PAIS"),
        F.concat(F.lit("F"), "id").alias("SOPNUMBE"),
        F.lit(3).alias("SOPTYPE"),
        day.alias("DOCDATE"),
        F.lit("C1").alias("CUSTNMBR"),
        F.lit("B").alias("BACHNUMB"),
        *[F.lit(1).cast("decimal(19,5)").alias(c) for c in ("SUBTOTAL", "TAXAMNT", "DOCAMNT")],
        F.lit("unused").alias("NOTE"),
    )
    headers.write.partitionBy("PAIS").parquet(f"{tmp_path}/SOP30200")
    return Erp.from_parquet(spark, str(tmp_path), ["SOP30200"])


def test_period_and_columns_reach_the_scan(stored):
    text = plan(rolling_scan(stored["SOP30200"], date(2024, 9, 1), days=30).select("SOPNUMBE"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(DOCDATE,2024-08-02)" in scan
    assert re.search(r"ReadSchema: struct<SOPNUMBE:string,DOCDATE:date>", scan)


def test_country_prunes_folders(stored):
    df = stored["SOP30200"].filter("PAIS = 'PERU'").select("SOPNUMBE")
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(PAIS" in scan


def test_account_prefix_reaches_the_scan(spark, tmp_path):
    gl = spark.createDataFrame(
        [("CHILE", 1, 1, 1, date(2024, 1, 1), "R", "1101 ", "D", 1, 0)],
        "PAIS string, JRNENTRY long, SEQNUMBR int, ACTINDX int, TRXDATE date, REFRENCE string, "
        "ACTNUMST string, DSCRIPTN string, DEBITAMT int, CRDTAMNT int",
    )
    gl.write.parquet(f"{tmp_path}/GL20000")
    spark.createDataFrame([(1, "x")], "ACTINDX int, ACTDESCR string").write.parquet(f"{tmp_path}/GL00100")
    tables = Erp.from_parquet(spark, str(tmp_path), ["GL20000", "GL00100"])
    df = reports.control_accounts(tables, date(2024, 1, 1), date(2024, 12, 31))
    assert "StringStartsWith(ACTNUMST,1)" in spark._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
    assert df.count() == 1


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down so that a few thousand rows count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_product_is_split_in_the_barcode_join(spark, small_partitions):
    """A third of all lines name one product; the join divides its partition."""
    code = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), "id"))
    country = F.when(F.col("id") % 2 == 0, "CHILE").otherwise("PERU")
    lines = spark.range(0, 60_000, 1, 8).select("id", code.alias("ITEMNMBR"), country.alias("PAIS"))
    equiv = lines.select(
        F.col("ITEMNMBR").alias("cProducto"),
        F.concat(F.lit("78"), "ITEMNMBR").alias("cProductoEquiv"),
        F.lit("EAN12").alias("cEquivalencia"),
        F.explode(F.array(F.lit("CL"), F.lit("PE"))).alias("cPais"),
    )
    df = with_ean(lines, equiv)
    assert "SortMergeJoin(skew=true) [_key" in final_plan(df)
    assert df.filter("EAN = ''").count() == 0 and df.count() == 60_000


def hot_sales(spark, document: bool, customer: bool) -> Erp:
    """Sales where a third of the lines belong to one document, or of the documents to one customer."""
    third = F.col("id") % 3 == 0
    number = F.when(third & F.lit(document), F.lit("0")).otherwise(F.col("id").cast("string"))
    lines = spark.range(0, 60_000, 1, 8).select(
        number.alias("SOPNUMBE"),
        F.lit(3).alias("SOPTYPE"),
        F.col("id").cast("int").alias("LNITMSEQ"),
        F.concat(F.lit("P"), "id").alias("ITEMNMBR"),
        F.concat(F.lit("item "), F.sha2(F.col("id").cast("string"), 256)).alias("ITEMDESC"),
        F.lit("UN").alias("UOFM"),
        *[F.lit(2).cast("decimal(19,5)").alias(c) for c in ("QUANTITY", "QTYTOINV", "UNITPRCE", "XTNDPRCE")],
    )
    buyer = F.when(third & F.lit(customer), F.lit("C0")).otherwise(F.concat(F.lit("C"), "id"))
    headers = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("SOPNUMBE"),
        F.lit(3).alias("SOPTYPE"),
        F.lit(date(2024, 1, 1)).alias("DOCDATE"),
        buyer.alias("CUSTNMBR"),
        F.lit("B").alias("BACHNUMB"),
        *[F.lit(2).cast("decimal(19,5)").alias(c) for c in ("SUBTOTAL", "TAXAMNT", "DOCAMNT")],
    )
    master = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("C"), "id").alias("CUSTNMBR"), F.lit("name").alias("CUSTNAME")
    )
    return Erp({"SOP30200": headers, "SOP30300": lines, "RM00101": master})


YEAR = (date(2024, 1, 1), date(2024, 12, 31))


def test_hot_document_is_split(spark, small_partitions):
    df = reports.sales_detail(hot_sales(spark, True, False), *YEAR, ordered=False)
    assert "SortMergeJoin(skew=true) [SOPNUMBE" in final_plan(df)
    assert df.count() == 60_000


def test_hot_customer_is_split(spark, small_partitions):
    df = reports.fill_rate(hot_sales(spark, False, True), *YEAR, ordered=False)
    assert "SortMergeJoin(skew=true) [CUSTNMBR" in final_plan(df)
    assert df.count() == 60_000


def test_rows_of_one_day_sort_in_several_tasks(spark):
    df = spark.range(0, 40_000, 1, 4).select("id", F.lit(date(2024, 1, 1)).alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parted = arrange(df, ["day"], [F.col("id")]).select(F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in parted.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 20_000


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sales_report_asks_nothing_before_it_is_read(spark, sf):
    tables = erp(spark, sf, *MOV, *SOP)  # reading their schemas takes jobs
    for some in (tables, Erp({n: df.drop("PAIS") for n, df in tables.items()})):
        df, jobs = jobs_of(spark, f"sales-plan-{len(some['SOP30200'].columns)}", lambda some=some: reports.sales_report(some, *PERIOD))
        assert jobs == []
        rows, jobs = jobs_of(spark, f"sales-run-{len(some['SOP30200'].columns)}", df.collect)
        assert len(rows) > 0 and jobs
        spark.sparkContext.setJobGroup("none", "none")


def test_sales_report_shuffles_headers_and_lines_once(spark, sf):
    """The subquery that finds the countries with local sales reads the report's own shuffles."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["sales_report"](spark, sf)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = text.split("== Initial Plan ==")[0]
    assert "Subquery" in final and final.count("ReusedExchange") >= 2
    written = re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE_REQUIREMENTS", text)
    assert any("cSerie" in w for w in written)


def test_posted_tables_are_pruned_when_the_report_runs(spark, tmp_path, sf):
    names = (*MOV, *SOP)
    tables = erp(spark, sf, *names)
    for n in names:
        df = tables[n].where("PAIS <> 'PERU'") if n.startswith("movGC") else tables[n]
        df.write.partitionBy("PAIS").parquet(f"{tmp_path}/{n}")
    stored = Erp.from_parquet(spark, str(tmp_path), names)
    df = reports.sales_report(stored, *PERIOD)
    assert {r.PAIS for r in df.select("PAIS").distinct().collect()} == {"CHILE", "COLOMBIA", "ECUADOR", "PERU"}
    scan = next(x for x in plan(df).splitlines() if "FileScan" in x and "SOPNUMBE" in x and "DOCDATE" in x)
    assert re.search(r"PartitionFilters: \[[^]]*Subquery", scan) or "array_contains" in scan

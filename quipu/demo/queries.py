"""Every checked query: name -> function of (spark, folder of the test tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.demo.fixtures import erp, table
from quipu.functions import names, text
from quipu.functions.country import COUNTRIES
from quipu.operators import consolidate as stacked
from quipu.operators import cache, control, drift, ean, infer, integrity, load, profile, retention, rolling, runlog
from quipu.operators import facets as frequent
from quipu.operators.joins import COUNTRY
from quipu.plans import extra, registry, reports
from quipu.session import scratch_path
from quipu.sources import catalog, landing, listing, slices
from quipu.sources.erp import Erp, full_scan, rolling_scan
from quipu.sources.extract import Extraction, controlled, extract
from quipu.streaming import current
from quipu.streaming import landing as stream

START, END = date(1995, 2, 1), date(2001, 6, 30)
AS_OF = date(2001, 8, 1)

MOV = ("movGC_VtDocumentoVtaCab", "movGC_VtDocumentoVtaDet", "maeGC_ProductoEquiv")
SOP = ("SOP30200", "SOP30300", "RM00101")
ITEMS = ("SOP30200", "SOP30300", "IV00101")

TEST_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def loaded(df: DataFrame) -> DataFrame:
    """Column names as the warehouse load makes them, with % spelt out."""
    df = names.normalize_columns(df)
    return df.toDF(*[c.replace("%", "PCT") for c in df.columns])


# --- reports -------------------------------------------------------------------------------------


@query
def sales_ean(spark, sf):
    return loaded(reports.sales(erp(spark, sf, *MOV), START, END))


@query
def sales_ean_fanout(spark, sf):
    return loaded(reports.sales(erp(spark, sf, *MOV), START, END, fanout=True))


@query
def sales_fallback(spark, sf):
    return loaded(reports.sales_posted(erp(spark, sf, *SOP), START, END))


@query
def sales_report(spark, sf):
    """Peru has no local sales documents here, so its rows come from the posted ones."""
    tables = dict(erp(spark, sf, *MOV, *SOP).items())
    headers = tables["MOVGC_VTDOCUMENTOVTACAB"]
    tables["MOVGC_VTDOCUMENTOVTACAB"] = headers.filter(F.col(COUNTRY) != "PERU")
    return loaded(registry.run("Reporte Único de Ventas", Erp(tables), START, END))


@query
def sales_by_country(spark, sf):
    sales = reports.sales(erp(spark, sf, *MOV), START, END)
    return sales.groupBy(COUNTRY).agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum("PrecioExtendido").alias("total"),
        F.count_if(F.col("EAN") != "").alias("con_ean"),
    )


@query
def sales_detail(spark, sf):
    return loaded(reports.sales_detail(erp(spark, sf, *SOP), START, END))


@query
def price_diff(spark, sf):
    return loaded(reports.price_differences(erp(spark, sf, *ITEMS), START, END))


@query
def fill_rate(spark, sf):
    return loaded(reports.fill_rate(erp(spark, sf, *SOP), START, END))


@query
def customers(spark, sf):
    return loaded(reports.customers(erp(spark, sf, "RM00101")))


@query
def products(spark, sf):
    return loaded(reports.products(erp(spark, sf, "IV00101")))


@query
def price_list(spark, sf):
    return loaded(reports.price_list(erp(spark, sf, "IV00108")))


@query
def stock_lot(spark, sf):
    return loaded(reports.stock_by_lot(erp(spark, sf, "IV00102", "IV00101")))


@query
def receivables(spark, sf):
    tables = erp(spark, sf, "RM20101", "RM00101", "RM40401")
    return loaded(reports.receivables(tables, START, END, as_of=AS_OF))


@query
def journal(spark, sf):
    return loaded(reports.journal(erp(spark, sf, "GL20000"), START, END))


@query
def ledger(spark, sf):
    return loaded(reports.ledger(erp(spark, sf, "GL20000"), START, END))


@query
def control_accounts(spark, sf):
    return loaded(reports.control_accounts(erp(spark, sf, "GL20000", "GL00100"), START, END))


# --- extraction ----------------------------------------------------------------------------------


@query
def scan_full(spark, sf):
    return full_scan(erp(spark, sf, "RM00101"), "RM00101")


@query
def scan_rolling(spark, sf):
    return rolling_scan(erp(spark, sf, "SOP30200")["SOP30200"], AS_OF)


@query
def scan_detail_ean(spark, sf):
    tables = erp(spark, sf, "movGC_VtDocumentoVtaDet", "maeGC_ProductoEquiv")
    lines = rolling_scan(tables["movGC_VtDocumentoVtaDet"], AS_OF)
    return ean.with_ean(lines, tables["maeGC_ProductoEquiv"], "cProductoVta", strip=F.rtrim)


@query
def ean_lookup(spark, sf):
    equiv = erp(spark, sf, "maeGC_ProductoEquiv")["maeGC_ProductoEquiv"]
    lookup = ean.ean_lookup(equiv, fanout=True)
    return lookup.select(
        COUNTRY, F.col("_code").alias("cPais"), F.col("_product").alias("cProducto"), "EAN"
    )


@query
def ean_enrich(spark, sf):
    tables = erp(spark, sf, "SOP30300", "maeGC_ProductoEquiv")
    return ean.with_ean(tables["SOP30300"], tables["maeGC_ProductoEquiv"])


@query
def ean_coverage(spark, sf):
    tables = erp(spark, sf, "SOP30300", "maeGC_ProductoEquiv")
    rows = ean.with_ean(tables["SOP30300"], tables["maeGC_ProductoEquiv"])
    return ean.ean_coverage(rows, (COUNTRY,))


def _country_headers(spark, sf) -> dict[str, DataFrame]:
    """Document headers per country, whose schemas differ as those of real companies do."""
    headers = erp(spark, sf, "SOP30200")["SOP30200"]
    frames = {c: headers.filter(F.col(COUNTRY) == c).drop(COUNTRY) for c in COUNTRIES}
    frames["COLOMBIA"] = frames["COLOMBIA"].drop("BACHNUMB")
    frames["ECUADOR"] = frames["ECUADOR"].drop("TAXAMNT")
    frames["PERU"] = frames["PERU"].withColumn("RUC", F.col("CUSTNMBR"))
    return frames


@query
def consolidated(spark, sf):
    return stacked.consolidate(_country_headers(spark, sf))


@query
def country_stats(spark, sf):
    return stacked.country_stats(_country_headers(spark, sf))


def _extracted(spark, sf) -> Extraction:
    """Sales tables per country and the shared masters, as an extraction run leaves them."""
    names = (*MOV, "RM00101")
    tables = erp(spark, sf, *names)

    def read(country: str, name: str) -> DataFrame | None:
        df = tables[name]
        if COUNTRY in df.columns:
            return df.filter(F.col(COUNTRY) == country)
        return df if country == "CHILE" else None

    return extract(read, AS_OF, names)


@query
def extract_records(spark, sf):
    return _extracted(spark, sf).records()


@query
def extract_summary(spark, sf):
    return runlog.extract_summary(_extracted(spark, sf).records())


@query
def extract_controlled(spark, sf):
    """The listed tables extracted twice, the second time with a country's dearest documents gone."""
    first, root = _extracted(spark, sf), scratch_path(spark, "extractions")
    controlled(first, root, datetime(2001, 8, 1), AS_OF)
    cab = first.tables[MOV[0]]
    less = {MOV[0]: cab.where((F.col(COUNTRY) != "CHILE") | (F.col("nTotal") <= 400_000))}
    second = Extraction(first.tables | less, first.attempts, first.counted | less)
    out = controlled(second, root, datetime(2001, 8, 2), AS_OF, keys={MOV[0]: ["cSerie", "nCorrelativo"]})
    return out.select(
        "pais", "tabla", "registros", "estado", "version", "control",
        F.length("hash_sha256").alias("cifras"), F.col("archivo").isNotNull().alias("con_archivo"),
    )


# --- exploration ---------------------------------------------------------------------------------


@query
def preview(spark, sf):
    lines = table(spark, sf, "lineitem")
    return profile.preview(lines, 100, lines.columns)


@query
def adhoc_sql(spark, sf):
    view = "orders_" + uuid.uuid4().hex
    table(spark, sf, "orders").createTempView(view)
    sql = (
        f"SELECT o_orderstatus, count(*) AS n, sum(cast(o_totalprice AS decimal(19,5))) AS total "
        f"FROM {view} WHERE o_orderdate >= :since GROUP BY o_orderstatus"
    )
    return profile.run_sql(spark, sql, since=START)


@query
def filter_isin(spark, sf):
    return profile.where_in(table(spark, sf, "part"), "p_type", ["PROMO", "SMALL"])


@query
def table_counts(spark, sf):
    return profile.table_counts({t: table(spark, sf, t) for t in TEST_TABLES})


@query
def describe_numeric(spark, sf):
    out = profile.describe_numeric(table(spark, sf, "lineitem"))
    numbers = [c for c in out.columns if c not in ("columna", "filas")]
    return out.select("columna", "filas", *[F.round(c, 4).alias(c) for c in numbers])


@query
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "lineitem"), "l_partkey")


@query
def distinct_values(spark, sf):
    return profile.distinct_values(table(spark, sf, "part"), "p_name")


# --- names and text ------------------------------------------------------------------------------


def header_inventory(spark, sf) -> DataFrame:
    """Headers as files bring them, one per product."""
    head = F.concat(
        F.lit("  Cód. "), "p_type", F.lit("-"), "p_name", F.lit(" % "), F.col("p_partkey").cast("string")
    )
    exact = F.when(F.col("p_size") == 1, F.lit("Razon")).when(F.col("p_size") == 2, F.lit("TC"))
    exact = exact.when(F.col("p_size") == 3, F.lit(" TC ")).when(F.col("p_size") == 4, F.lit("TOTAL"))
    return table(spark, sf, "part").select("p_partkey", F.coalesce(exact, head).alias("original"))


def file_inventory(spark, sf) -> DataFrame:
    """Landed files, one per order: a report per customer, stamped with date and number."""
    headers = erp(spark, sf, "SOP30200")["SOP30200"]
    stamp = F.concat(
        F.date_format("DOCDATE", "yyyyMMdd"), F.lit("_"), F.substring("SOPNUMBE", -6, 6)
    )
    archivo = F.concat(
        F.lit("📊_Único de_"), F.rtrim("CUSTNMBR"), F.lit("_"), F.col(COUNTRY), F.lit("_"), stamp,
        F.lit(names.NORMALISED),
    )
    return headers.select(COUNTRY, archivo.alias("archivo"))


@query
def normalize_headers(spark, sf):
    headers = header_inventory(spark, sf)
    return headers.withColumn("normalizado", names.normalize_header_of(F.col("original")))


@query
def header_changes(spark, sf):
    return names.header_changes(header_inventory(spark, sf))


@query
def snapshot_name(spark, sf):
    return landing.snapshots(file_inventory(spark, sf))


@query
def latest_snapshot(spark, sf):
    return landing.latest_snapshots(file_inventory(spark, sf))


@query
def ascii_names(spark, sf):
    files = file_inventory(spark, sf)
    long_name = F.concat("archivo", F.lit("/Año[Región]"), F.repeat("archivo", 2))
    both = files.select("archivo", long_name.alias("largo"))
    return both.select(
        "archivo",
        names.ascii_name_of(F.col("archivo")).alias("corto_ascii"),
        names.ascii_name_of(F.col("largo")).alias("largo_ascii"),
    )


@query
def tables_by_country(spark, sf):
    tables = landing.snapshots(file_inventory(spark, sf)).select("tabla")
    backups = tables.select(F.concat("tabla", F.lit("_OLD")).alias("tabla"))
    other = table(spark, sf, "part").select(F.concat("p_type", F.lit("_"), "p_brand").alias("tabla"))
    return profile.tables_by_country(tables.unionAll(backups).unionAll(other))


@query
def scrub_control_chars(spark, sf):
    return text.scrub_control_chars(table(spark, sf, "documents").select("doc_id", "text"))


# --- control -------------------------------------------------------------------------------------


def load_records(spark, sf) -> DataFrame:
    """Load records, one per order: loaded, failed or empty."""
    orders = table(spark, sf, "orders")
    rows = F.col("o_custkey")
    ok = F.col("o_orderstatus") == "F"
    return orders.select(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("archivo"),
        F.col("o_orderpriority").alias("pais"),
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("tabla"),
        F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(rows).cast("long").alias("filas_leidas"),
        F.when(ok, rows).otherwise(F.lit(0)).cast("long").alias("filas_cargadas"),
        ok.alias("exito"),
        F.when(F.col("o_orderstatus") == "P", F.lit("sin columnas")).alias("error"),
    )


@query
def load_summary(spark, sf):
    return runlog.load_summary(load_records(spark, sf))


@query
def load_losses(spark, sf):
    """Of loads with accounts: an order's number of rows, of which some were over-long, some short."""
    rows = F.col("filas_leidas")
    counts = {"filas_largas": rows % 5, "filas_cortas": rows % 7, "celdas_invalidas": F.when(F.col("exito"), rows % 3)}
    return runlog.load_losses(load_records(spark, sf).withColumns(counts))


@query
def load_states(spark, sf):
    return runlog.load_states(load_records(spark, sf))


@query
def load_errors(spark, sf):
    return runlog.load_errors(load_records(spark, sf))


def history(spark, sf) -> DataFrame:
    """A control history, one row per order."""
    orders = table(spark, sf, "orders")
    states = F.create_map(
        F.lit("O"), F.lit("inicial"),
        F.lit("F"), F.lit("actualizado_incremental"),
        F.lit("P"), F.lit("modificacion_detectada"),
    )
    return orders.select(
        F.substring("o_orderpriority", 3, 20).alias("pais"),
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("tabla"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("version"),
        states[F.col("o_orderstatus")].alias("estado"),
        F.col("o_orderkey").alias("total_registros"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("hash_sha256"),
    )


@query
def history_filter(spark, sf):
    return integrity.history_filter(history(spark, sf), country="HIGH", state="inicial")


@query
def history_metrics(spark, sf):
    return integrity.history_metrics(history(spark, sf))


@query
def history_stats(spark, sf):
    return integrity.history_stats(history(spark, sf))


@query
def row_hash(spark, sf):
    headers = erp(spark, sf, "SOP30200")["SOP30200"]
    return headers.select("SOPNUMBE", integrity.row_hash(headers).alias("hash_sha256"))


@query
def fingerprint(spark, sf):
    return integrity.fingerprint(table(spark, sf, "lineitem"))


def _two_snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Line snapshots: later ones came, cancelled ones went, prices of others changed."""
    lines = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    old = lines.filter(day <= F.lit("2001-06-30").cast("date"))
    new = lines.filter(~((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 45)))
    raised = F.when(F.col("l_discount") == 0.1, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    return old, new.withColumn("l_tax", raised)


@query
def snapshot_changes(spark, sf):
    old, new = _two_snapshots(spark, sf)
    return integrity.snapshot_changes(old, new, integrity.key_columns(new))


@query
def snapshot_diff(spark, sf):
    old, new = _two_snapshots(spark, sf)
    return integrity.snapshot_diff(old, new, ["l_orderkey", "l_linenumber"])


@query
def schema_drift(spark, sf):
    return drift.schema_drift(_country_headers(spark, sf), "SOP30200")


@query
def content_drift(spark, sf):
    return drift.content_drift(stacked.consolidate(_country_headers(spark, sf)))


@query
def drift_totals(spark, sf):
    return drift.drift_totals(drift.schema_drift(_country_headers(spark, sf), "SOP30200"))


# --- files and tables ----------------------------------------------------------------------------


def ragged_customers(spark, sf) -> DataFrame:
    """Customer lines as a careless export writes them: short, over-long, quoted, "no value"."""
    key = F.col("c_custkey").cast("string")
    name = F.concat(F.lit('"'), "c_name", F.lit('; ""SA"""'))
    amount = F.col("c_acctbal").cast("decimal(19,2)").cast("string")
    segment = F.col("c_mktsegment")
    line = (
        F.when(segment == "BUILDING", F.concat_ws(";", key, name))
        .when(segment == "FURNITURE", F.concat_ws(";", key, name, amount, segment, F.lit("")))
        .when(segment == "MACHINERY", F.concat_ws(";", key, F.lit("NULL"), amount, F.lit('""')))
        .otherwise(F.concat_ws(";", key, name, amount, segment))
    )
    return table(spark, sf, "customer").select(line.alias("Cód. Cliente;Razón Social;Cupo;Crédito"))


@query
def csv_ingest(spark, sf):
    path = scratch_path(spark, "landing") + "/CHILE"
    lines = ragged_customers(spark, sf).write.option("header", "true")
    lines.option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return landing.read_csv(spark, path)


@query
def csv_roundtrip(spark, sf):
    headers = erp(spark, sf, "SOP30200")["SOP30200"]
    path = scratch_path(spark, "export")
    load.write_csv(headers, path)
    return load.read_export(spark, path, [c for c in headers.columns if c != COUNTRY])


@contextmanager
def _database(spark):
    """A database that is gone afterwards, with its folder; results that must last are kept elsewhere."""
    name = "quipu_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query
def report_to_table(spark, sf):
    """Two reports, exported twice, landed by country, and the newer content loaded with its types."""
    tables = erp(spark, sf, "SOP30200", "RM00101")
    reports_ = {"Documentos": (tables["SOP30200"], "DOCAMNT"), "Clientes": (tables["RM00101"], "CRLMTAMT")}
    root, sums = scratch_path(spark, "reports"), []
    for at, part in ((datetime(2024, 1, 5), F.col(COUNTRY) != "PERU"), (datetime(2024, 2, 5), F.lit(True))):
        for report, (df, _) in reports_.items():
            load.export(df.filter(part), root, report, at)
    declared = {r.upper(): {amount: "decimal(19,5)"} for r, (_, amount) in reports_.items()}
    with _database(spark) as name:
        records = load.load_landing(spark, root, name, declared=declared).select("pais", "tabla", "filas_cargadas")
        for report, (_, amount) in reports_.items():
            for country in COUNTRIES:
                stored = spark.table(load.full_name(name, f"{report}_{country}".upper()))
                total = F.sum(amount).cast("decimal(38,5)").alias("total")
                sums.append(stored.agg(total).withColumn("tabla", F.lit(f"{report}_{country}".upper())))
        return _kept(records.join(reduce(DataFrame.unionAll, sums), "tabla"))


@query
def replace_with_backup(spark, sf):
    orders = table(spark, sf, "orders")
    with _database(spark) as name:
        for content in (orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")):
            load.replace_with_backup(spark, content, name, "ORDERS_CHILE")
        load.replace_with_backup(spark, orders.limit(0), name, "ORDERS_CHILE")
        both = ("ORDERS_CHILE", "ORDERS_CHILE" + load.BACKUP)
        return _kept(profile.table_counts({t: spark.table(load.full_name(name, t)) for t in both}))


def _catalog(spark, sf, name) -> DataFrame:
    for t in TEST_TABLES:
        spark.catalog.createTable(f"{name}.{t}", path=f"{sf}/{t}.parquet", source="parquet")
    return catalog.catalog_stats(spark, name)


@query
def catalog_stats(spark, sf):
    with _database(spark) as name:
        stats = _catalog(spark, sf, name)
        return _kept(stats.select("tabla", "filas", (F.col("bytes") > 0).alias("con_bytes")))


@query
def catalog_totals(spark, sf):
    with _database(spark) as name:
        totals = catalog.catalog_totals(_catalog(spark, sf, name))
        return _kept(totals.select("tablas", "filas", (F.col("bytes") > 0).alias("con_bytes")))


@query
def stream_ingest(spark, sf):
    """Two drops of customers and three runs; every file is read exactly once."""
    tables = erp(spark, sf, "RM00101")["RM00101"]
    rows = tables.select("CUSTNMBR", "CUSTCLAS", F.col("CRLMTAMT").cast("string"))
    rows = rows.withColumn(COUNTRY, F.lit("CHILE"))
    base = scratch_path(spark, "stream")
    drop, target, checkpoint = f"{base}/drop", f"{base}/table", f"{base}/checkpoint"
    load.write_csv(rows.filter(F.col("CUSTCLAS") == "BUILDING"), f"{drop}/one")
    for second in (None, f"{drop}/two", None):
        if second:
            load.write_csv(rows.filter(F.col("CUSTCLAS") != "BUILDING"), second)
        stream.ingest(spark, drop, "*.csv", target, checkpoint)
    return stream.ingested(spark, target).select(COUNTRY, "CUSTNMBR", "CUSTCLAS", "CRLMTAMT")


# --- reports known by name only ------------------------------------------------------------------


@query
def x_sales_customer(spark, sf):
    return loaded(extra.sales_per_customer(erp(spark, sf, *SOP), START, END))


@query
def x_top_products(spark, sf):
    return loaded(extra.top_products(erp(spark, sf, *ITEMS), START, END))


@query
def x_inventory(spark, sf):
    return loaded(extra.inventory(erp(spark, sf, "IV00102", "IV00101")))


@query
def x_invoices_period(spark, sf):
    return loaded(extra.invoices_per_month(erp(spark, sf, *SOP), START, END))


@query
def x_active_customers(spark, sf):
    return loaded(extra.active_customers(erp(spark, sf, "RM00101")))


@query
def x_customer_master(spark, sf):
    return loaded(extra.customer_master(erp(spark, sf, "RM00101")))


@query
def x_sales_brand(spark, sf):
    return loaded(extra.sales_by_brand(erp(spark, sf, *ITEMS), START, END))


@query
def x_returns(spark, sf):
    return loaded(extra.returns(erp(spark, sf, *SOP), START, END))


@query
def x_products_ean(spark, sf):
    return loaded(extra.products_with_ean(erp(spark, sf, "IV00101", "maeGC_ProductoEquiv")))


# --- loads with an account -----------------------------------------------------------------------


def text_orders(spark, sf) -> DataFrame:
    """Orders as a file brings them: all text, of every kind of cell."""
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    day, key = F.col("o_orderdate").cast("date").cast("string"), F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.cast("string").alias("entero"),
        amount.alias("monto"),
        F.when(key % 10 == 0, "1.5e3").otherwise(amount).alias("real"),
        F.when(key % 3 > 0, day).alias("fecha"),
        F.when(key % 5 == 0, F.concat(day, F.lit(" 10:30:00"))).otherwise(day).alias("hora"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("FALSE").alias("logico"),
        F.when(key % 100 == 0, "n/d").otherwise(amount).alias("mezcla"),
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("ceros"),
        F.col("o_custkey").cast("string").alias("COD_CLIENTE"),
        F.lit(None).cast("string").alias("vacia"),
        F.col("o_orderpriority").alias("texto"),
    )


@query
def infer_types(spark, sf):
    """From the states of the days' parts, merged."""
    orders = text_orders(spark, sf)
    return infer.types_of(infer.merged(infer.cell_states(orders, by=["logico"]))).unionAll(
        infer.types_of(infer.cell_states(orders, ["logico"]))
    )


@query
def load_typed(spark, sf):
    """Orders written as CSV, read back as text, and loaded with the types found."""
    path = scratch_path(spark, "typed") + "/CHILE"
    load.write_csv(text_orders(spark, sf).drop("real", "mezcla"), path)
    rows = infer.load_typed(landing.read_csv(spark, path))
    return rows.withColumn("MONTO", F.col("MONTO").cast("decimal(19,2)"))


def faulty_customers(spark, sf) -> DataFrame:
    """Customer lines with short and over-long rows, and amounts that are none."""
    key, amount = F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    segment = F.col("c_mktsegment")
    line = (
        F.when(segment == "BUILDING", F.concat_ws(",", key, "c_name"))
        .when(segment == "FURNITURE", F.concat_ws(",", key, "c_name", amount, segment, key))
        .when((segment == "MACHINERY") & (F.col("c_custkey") % 2 == 0), F.concat_ws(",", key, "c_name", F.lit("n/d"), segment))
        .otherwise(F.concat_ws(",", key, "c_name", amount, segment))
    )
    return table(spark, sf, "customer").select(line.alias("Cliente,Nombre,Cupo,Giro"))


@query
def load_account(spark, sf):
    """The same file refused for what does not fit, and loaded where that is allowed."""
    path = scratch_path(spark, "account") + "/CHILE/Clientes_20240105_000000.csv"
    faulty_customers(spark, sf).write.option("header", "true").option("sep", "\u0001").option("quote", "\u0000").csv(path)
    types, many = {"CLIENTE": "bigint", "CUPO": "decimal(12,2)"}, table(spark, sf, "customer").count()
    out = []
    with _database(spark) as name:
        for limit in (0, many, 0):
            record = load.load_file(spark, path, "CHILE", "CLIENTES_CHILE", name, types, max_invalid=limit)
            full = load.full_name(name, "CLIENTES_CHILE")
            held = spark.table(full).count() if spark.catalog.tableExists(full) else 0
            out.append((len(out) + 1, held, *record))
    records = spark.createDataFrame(out, "intento int, en_tabla long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runlog.LOAD_RECORD))
    return records.select(
        "intento", "filas_leidas", "filas_cargadas", "filas_largas", "filas_cortas", "celdas_invalidas", "exito",
        F.col("error").isNotNull().alias("con_error"), "en_tabla",
    )


@query
def landing_inventory(spark, sf):
    """Every delivery with what its load made of it, files of zero bytes too."""
    root = scratch_path(spark, "deliveries")
    load.export(erp(spark, sf, "RM00101")["RM00101"], root, "Clientes", datetime(2024, 1, 5))
    for country in COUNTRIES:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{country}/Nada_20240105_000000.csv")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place).close()
    with _database(spark) as name:
        records = load.load_landing(spark, root, name, infer=True)
        loaded = records.select(F.col("pais").alias("PAIS"), "archivo", "filas_cargadas", F.col("error").isNotNull().alias("con_error"))
        found = listing.inventory(spark, root).select("PAIS", "archivo", "vacio")
        return _kept(found.join(loaded, ["PAIS", "archivo"], "left"))


@query
def sweep(spark, sf):
    """Five loads and an empty one, and the folders that are left after a sweep."""
    orders = table(spark, sf, "orders")
    with _database(spark) as name:
        root = spark.catalog.getDatabase(name).locationUri
        for day in range(5):
            load.replace_with_backup(spark, orders.where(F.col("o_orderkey") % 5 <= day), name, "T")
        load.replace_with_backup(spark, orders.limit(0), name, "T")
        before = retention.versions(spark, root).count()
        later = datetime.now(timezone.utc) + timedelta(minutes=5)
        gone = retention.sweep(spark, root, [name], later, timedelta(0)).count()
        left = profile.table_counts({t: spark.table(load.full_name(name, t)) for t in ("T", "T" + load.BACKUP)})
        found = {"antes": before, "borradas": gone, "quedan": retention.versions(spark, root).count()}
        return _kept(left.select("tabla", "filas", *[F.lit(n).cast("long").alias(c) for c, n in found.items()]))


# --- extractions over time -----------------------------------------------------------------------


@query
def control_run(spark, sf):
    """Posted documents extracted twice: later ones came, some of one month changed, some of another went."""
    headers, root = erp(spark, sf, "SOP30200")["SOP30200"], scratch_path(spark, "control")
    month = F.date_format("DOCDATE", "yyyy-MM")
    raised = F.when((F.col(COUNTRY) == "COLOMBIA") & (month == "1996-03"), F.col("TAXAMNT") + 1).otherwise(F.col("TAXAMNT"))
    went = (F.col(COUNTRY) == "PERU") & (month == "1997-05") & (F.col("SOPTYPE") == 4)
    old = headers.where("DOCDATE <= DATE '2001-05-31'")
    new = headers.where("DOCDATE <= DATE '2001-06-30'").where(~went)
    new = new.withColumn("TAXAMNT", raised.cast("decimal(19,5)"))
    keys = ["SOPNUMBE", "SOPTYPE"]
    control.control_run(spark, old, root, "SOP30200", datetime(2001, 6, 1), keys)
    out = control.control_run(spark, new, root, "SOP30200", datetime(2001, 7, 1), keys)
    return out.drop("archivo", "timestamp")


@query
def control_tree(spark, sf):
    """The digest of the whole table over its countries and months."""
    headers, root = erp(spark, sf, "SOP30200")["SOP30200"], scratch_path(spark, "tree")
    control.store(headers, root, "SOP30200", "1", "DOCDATE")
    return control.table_root(control.leaves(control.stored(spark, root, "SOP30200", "1", headers)))


@query
def rolling_refresh(spark, sf):
    """Three refreshes of a store; what it holds then is what a scan of the whole source gives."""
    headers = erp(spark, sf, "SOP30200")["SOP30200"]
    with _database(spark) as name:
        for as_of in (date(2001, 5, 1), date(2001, 6, 1), AS_OF):
            held = headers.where(F.col("DOCDATE") <= F.lit(as_of))
            rolling.refresh(spark, lambda since: held.where(F.col("DOCDATE") >= F.lit(since)), name, "DOCS", as_of, 120)  # noqa: B023
        return _kept(rolling.window(spark, name, "DOCS", AS_OF, 120))


@query
def slice_bounds(spark, sf):
    """Rows of each of twelve slices of a source of which a third lies on one day."""
    lines = table(spark, sf, "lineitem")
    day = F.when(F.col("l_linenumber") % 3 == 0, F.lit("1998-09-02")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
    view = "source_" + uuid.uuid4().hex
    lines.select(day.cast("date").alias("dia"), "l_orderkey", "l_linenumber", "l_partkey").createTempView(view)
    found = slices.equal_slices(spark, view, ["dia", "l_orderkey", "l_linenumber", "l_partkey"], 12)
    counts = [F.count_if(F.expr(p)).alias(f"c{i}") for i, p in enumerate(found)]
    rows = [F.struct(F.lit(i).alias("rebanada"), F.col(f"c{i}").alias("filas")) for i in range(len(found))]
    return spark.table(view).agg(*counts).select(F.inline(F.array(*rows)))


@query
def stream_current(spark, sf):
    """Customers landed in snapshots out of order, with a run after each; the newest one's rows are left."""
    rows = erp(spark, sf, "RM00101")["RM00101"].select("CUSTNMBR", "CUSTCLAS", F.col("CRLMTAMT").cast("string"), COUNTRY)
    base = scratch_path(spark, "current")
    for stamp, part in (((2024, 2, 1), "CUSTCLAS <> 'BUILDING'"), ((2024, 1, 1), "true"), ((2024, 3, 1), "CUSTCLAS = 'BUILDING'")):
        load.export(rows.where(part), f"{base}/drop", "Clientes", datetime(*stamp))
        current.stream_current(spark, f"{base}/drop", "*.csv", f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return current.current(spark, f"{base}/table").select(COUNTRY, "CUSTNMBR", "CUSTCLAS", "CRLMTAMT")


# --- exploration of whole tables -----------------------------------------------------------------


@query
def facets(spark, sf):
    names = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey", "l_orderkey"]
    lines = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("int"))
    return frequent.facets(lines, names)


@query
def cached_sql(spark, sf):
    """A statement asked twice: the second answer comes from the first one's entry."""
    path, root, view = scratch_path(spark, "source"), scratch_path(spark, "cache"), "orders_" + uuid.uuid4().hex
    table(spark, sf, "orders").write.parquet(path)
    spark.read.parquet(path).createTempView(view)
    sql = f"SELECT o_orderstatus, count(*) AS n, sum(cast(o_totalprice AS decimal(19,5))) AS total FROM {view} WHERE o_orderdate >= :since GROUP BY o_orderstatus"
    cache.cached_sql(spark, sql, root, since=START)
    again = cache.cached_sql(spark, sql, root, since=START)
    return again.withColumn("de_cache", F.lit(all(root.rsplit("/", 1)[-1] in f for f in again.inputFiles())))


# --- reports by name and names -------------------------------------------------------------------


@query
def sales_sellin(spark, sf):
    return loaded(registry.run("Reporte Único de Ventas Sellin", erp(spark, sf, *MOV, *SOP), START, END))


@query
def sales_market(spark, sf):
    return loaded(registry.run("reporte unico de ventas mercado", erp(spark, sf, *MOV), START, END))


@query
def ready_rows(spark, sf):
    """Rows that a source delivers ready-made win, even none; only where it has no answer is the report computed."""
    tables = erp(spark, sf, "IV00108", "IV00101")
    ready = {"Obtener Precio Lista": tables["IV00108"].limit(0), "Listar Productos Detallado": None}
    counted = [
        registry.run(n, tables, ready=ready).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("reporte"), "filas")
        for n in ready
    ]
    return reduce(DataFrame.unionAll, counted)


@query
def own_report(spark, sf):
    """A report that the user adds, run by its name like the others."""

    def per_class(tables: Erp, ordered: bool = True) -> DataFrame:
        rows = tables["RM00101"].groupBy(COUNTRY, F.rtrim("CUSTCLAS").alias("Clase"))
        return rows.agg(F.count(F.lit(1)).alias("Clientes"), F.sum("CRLMTAMT").alias("Cupo"))

    registry.register(registry.Report("Clientes por Clase", "Clientes y cupo de cada clase", per_class, False))
    out = loaded(registry.run("clientes POR clase", erp(spark, sf, "RM00101")))
    registry.forget("Clientes por Clase")  # the list of reports is the process's
    return out


@query
def repeated_headers(spark, sf):
    """Headers that are alike once normalised, or but for case, are told apart; blanks, dots and quotes may stand in them."""
    heads = ["Cód. Cliente", "COD-CLIENTE", "cód  cliente", "Razon", "a`b.c"]
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal").toDF(*heads)
    plain = names.normalize_columns(rows)
    return plain.select(*[F.col(names.quote_ident(c)) for c in plain.columns]).withColumnRenamed("A`B_C", "SALDO")


@query
def session_info(spark, sf):
    """What the session says of itself, next to the size of what it reads."""
    rows = table(spark, sf, "region").agg(F.count(F.lit(1)).alias("filas"))
    info = rows.select("filas", *catalog.session_columns())
    return info.select("filas", "catalogo", (F.col("usuario") != "").alias("con_usuario"))

"""Writing: CSV exports, warehouse tables with a backup, and loading landed files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.text import col, quoted, scrub_control_chars
from quipu.operators.account import Account, Counter, Refused
from quipu.operators.infer import cell_states, inferred
from quipu.operators.joins import COUNTRY
from quipu.operators.runlog import LOAD_RECORD
from quipu.sources.erp import date_column
from quipu.sources.landing import FILE_NAME, fitting, landed_files, latest_snapshots, literal, read_marked
from quipu.sources.listing import STORES, inventory, store_of

BACKUP = "_OLD"

EXPORT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one folder per country where there are several; written without a BOM.

    Blanks around a value are part of it and stay.
    """
    writer = df.write.mode("errorifexists").options(**EXPORT)
    if COUNTRY in df.columns:
        writer = writer.partitionBy(COUNTRY)
    writer.csv(path)


def export(df: DataFrame, root: str, report: str, at: datetime) -> str:
    """Write a report to ``{root}/{report}_{yyyyMMdd_HHmmss}.csv`` and return that path."""
    path = f"{root.rstrip('/')}/{report.replace(' ', '_')}_{at:%Y%m%d_%H%M%S}.csv"
    write_csv(df, path)
    return path


def write_workbook_rows(df: DataFrame, path: str) -> None:
    """The rows a workbook would show: text without control characters, a folder per country."""
    write_csv(scrub_control_chars(df), path)


def read_export(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An export read back as text, the country restored from the folder names."""
    schema = ", ".join(f"{quoted(c)} string" for c in columns)
    return spark.read.schema(schema).options(**EXPORT).csv(path)


def store_tables(tables: Mapping[str, DataFrame | None], root: str) -> None:
    """Keep extracted tables as Parquet folders that ``Erp.from_parquet`` reads.

    Countries become folders, so that a report on one of them reads no other. Within a task rows are
    sorted by country and date, which needs no shuffle and lets a period skip row groups.
    """
    for name, df in tables.items():
        if df is None:
            continue
        country = [COUNTRY] if COUNTRY in df.columns else []
        date = [c for c in (date_column(df),) if c]
        if country or date:
            df = df.sortWithinPartitions(*country, *date)
        writer = df.write.mode("errorifexists").option("compression", "snappy")
        (writer.partitionBy(*country) if country else writer).parquet(f"{root.rstrip('/')}/{name}")


def full_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def matching_columns(df: DataFrame, target: list[str]) -> DataFrame:
    """``df`` in the target's column order, matched by name in any case; absent ones become null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            col(have[t.lower()]).alias(t) if t.lower() in have else F.lit(None).alias(t)
            for t in target
        ]
    )


def append_by_name(spark: SparkSession, df: DataFrame, database: str, table: str) -> None:
    """Add rows to a table, columns matched by name in any case; a value that does not fit aborts."""
    name = full_name(database, table)
    matching_columns(df, spark.table(name).columns).write.insertInto(name)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this process wrote and no table names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def replace_with_backup(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    table: str,
    root: str | None = None,
    check: Callable[[], None] | None = None,
) -> bool:
    """Make ``df`` the new content of a table and keep the previous one as ``{table}_OLD``.

    Rows are first written in full to a folder of their own; only then are names swapped, which
    touches the catalog alone. A failed write leaves the table as it was, and so does an empty
    ``df``, or a ``check`` that raises once all is written; the folders of both are deleted. Tables live in
    folders below ``root``, by default the database's own. An older backup
    goes last, when the new table is there; its folder stays for those who still read it until
    ``retention.sweep``. Returns whether the table was replaced.
    """
    base = root or spark.catalog.getDatabase(database).locationUri
    path = f"{base.rstrip('/')}/{table.lower()}-{uuid.uuid4().hex}"
    try:
        df.write.mode("errorifexists").parquet(path)
        if check:
            check()
        empty = spark.read.parquet(path).isEmpty()
    except Exception:
        discard(spark, path)
        raise
    if empty:
        discard(spark, path)
        return False
    name, backup = full_name(database, table), full_name(database, table + BACKUP)
    had_one = spark.catalog.tableExists(name)
    aside = full_name(database, f"{table}{BACKUP}_{uuid.uuid4().hex[:8]}")
    had_backup = had_one and spark.catalog.tableExists(backup)
    if had_backup:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {aside}")
    if had_one:
        spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    try:
        spark.catalog.createTable(name, path=path, source="parquet")
    except Exception:
        if had_one:
            spark.sql(f"ALTER TABLE {backup} RENAME TO {name}")
        if had_backup:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {backup}")
        raise
    if had_backup:
        spark.sql(f"DROP TABLE {aside}")
    return True


def load_counted(
    spark: SparkSession,
    path: str,
    database: str,
    table: str,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    max_invalid: int = 0,
) -> tuple[bool, Account]:
    """Load one landed file, and account for all of its rows; too many cells that do not fit refuse it.

    Columns get their declared types. With ``infer`` the others get the narrowest that all their cells fit, which
    takes a scan of its own.
    """
    rows = read_marked(spark, literal(path))
    types = dict(types or {})
    if infer:
        types = inferred(cell_states(fitting(rows))) | types
    counter = Counter(rows, types)
    checked = lambda: counter.account().check(max_invalid)
    loaded = replace_with_backup(spark, counter.rows, database, table, check=checked)
    return loaded, counter.account()


def load_file(
    spark: SparkSession,
    path: str,
    country: str,
    table: str,
    database: str,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    max_invalid: int = 0,
) -> tuple:
    """Load one landed file into its table and return its record."""
    file = re.search(FILE_NAME, path)[1]
    try:
        loaded, rows = load_counted(spark, path, database, table, types, infer, max_invalid)
        kept = rows.loaded if loaded else 0
        return file, country, table, rows.read, kept, loaded, None, rows.long, rows.short, rows.invalid_cells
    except Refused as problem:
        rows = problem.account
        return file, country, table, rows.read, 0, False, str(problem), rows.long, rows.short, rows.invalid_cells
    except Exception as problem:  # one bad file must not stop the others
        return file, country, table, 0, 0, False, str(problem), None, None, None


def deliveries(spark: SparkSession, root: str) -> DataFrame:
    """The landed files below ``root``, empty ones too where the store can be listed for them."""
    return inventory(spark, root) if store_of(root) in STORES else landed_files(spark, root)


def load_landing(
    spark: SparkSession,
    root: str,
    database: str,
    at_once: int = 4,
    declared: Mapping[str, Mapping[str, str]] | None = None,
    infer: bool = False,
    max_invalid: int = 0,
) -> DataFrame:
    """Load the newest snapshot of every table found below ``root``; one record per file.

    ``declared`` has the column types of known tables, by their name without the country; columns
    of others stay text, or get the types that ``infer`` finds. A file of zero bytes gets a record with an error, as
    does one with more than ``max_invalid`` cells that do not fit. There is one such file per table and country. Each load is a Spark job of its own, and
    ``at_once`` of them run side by side, so that small files do not leave the cluster idle.
    """
    newest = latest_snapshots(deliveries(spark, root)).orderBy("PAIS", "nombre")
    picked = newest.select("path", "PAIS", "tabla").collect()  # a name per table and country

    def load(r) -> tuple:
        types = (declared or {}).get(r.tabla.removesuffix(f"_{r.PAIS.upper()}"))
        return load_file(spark, r.path, r.PAIS, r.tabla, database, types, infer, max_invalid)

    with ThreadPoolExecutor(at_once) as pool:
        records = list(pool.map(load, picked))
    return spark.createDataFrame(records, LOAD_RECORD)

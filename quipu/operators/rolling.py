"""The last days of a table as a store of day partitions, brought up to date instead of read again.

A refresh reads the source from a given day on. The days it brings replace theirs, and no other day is written; days that
have left the window go from the catalog, with their folders, and no file is opened for it. A refresh that
failed half-way can be repeated: it replaces the same days.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quipu.functions.text import col, quoted
from quipu.operators.load import full_name
from quipu.sources.erp import ROLLING_DAYS, bound, date_column

DAY = "_dia"

#: Gives the source's rows from a day on.
Since = Callable[[date], DataFrame]


def days_of(spark: SparkSession, name: str) -> list[date]:
    """The days a store has, from its catalog entry."""
    shown = spark.sql(f"SHOW PARTITIONS {name}").collect()  # at most the days of the window and of one gap
    return sorted(date.fromisoformat(r[0].split("=", 1)[1]) for r in shown)


def create(spark: SparkSession, df: DataFrame, name: str) -> None:
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {DAY} date) USING parquet PARTITIONED BY ({DAY})")


def replace_days(spark: SparkSession, df: DataFrame, name: str, column: str) -> set[date]:
    """Days that ``df`` has become what it brings of them, and are returned; rows without a date are left out.

    A day's rows come together in a few tasks, so that it has a few files and not one from every task of the
    refresh; a day too large for one task is divided by the engine. The write itself observes its days.
    """
    brought = Observation()
    dated = df.withColumn(DAY, col(column).cast("date")).where(F.col(DAY).isNotNull())
    rows = dated.select(*[col(c) for c in spark.table(name).columns])
    rows = rows.observe(brought, F.collect_set(F.col(DAY)).alias("days")).hint("rebalance", F.col(DAY))
    place = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY)
    writer.parquet(place)
    days = set(brought.get["days"])
    _alter(spark, name, "ADD IF NOT EXISTS", sorted(days), " ")
    spark.catalog.refreshTable(name)
    return days


def _alter(spark: SparkSession, name: str, how: str, days: list[date], between: str) -> None:
    for some in (days[i : i + 100] for i in range(0, len(days), 100)):
        spec = between.join(f"PARTITION ({DAY} = DATE '{d}')" for d in some)
        spark.sql(f"ALTER TABLE {name} {how} {spec}")


def expire(spark: SparkSession, name: str, first: date) -> list[date]:
    """Drop the days before ``first``; the catalog is asked and changed, no data is read."""
    old = [d for d in days_of(spark, name) if d < first]
    _alter(spark, name, "DROP IF EXISTS", old, ", ")
    return old


def refresh(
    spark: SparkSession,
    since: Since,
    database: str,
    table: str,
    as_of: date,
    days: int = ROLLING_DAYS,
    late: int = 3,
    declared: str | None = None,
) -> tuple[date, int]:
    """Bring a store up to ``as_of``; returns the day it was read from and how many days left.

    The source is read from ``late`` days before the newest stored day on, since rows may come late, or from the
    window's first day where nothing is stored yet. A day's rows are those the source has of it now: a row it
    lost is lost here as well.
    """
    name, first = full_name(database, table), as_of - timedelta(days=days)
    have = days_of(spark, name) if spark.catalog.tableExists(name) else []
    start = max(first, have[-1] - timedelta(days=late)) if have else first
    df = since(start)
    column = date_column(df, declared)
    if column is None:
        raise ValueError(f"{table} has no date column to roll by")
    create(spark, df, name)
    brought = replace_days(spark, df.where(col(column) >= bound(df, column, start)), name, column)
    _alter(spark, name, "DROP IF EXISTS", [d for d in have if d >= start and d not in brought], ", ")
    return start, len(expire(spark, name, first))


def window(spark: SparkSession, database: str, table: str, as_of: date, days: int = ROLLING_DAYS) -> DataFrame:
    """The stored rows of the window, by its folders; equal to a rolling scan of the source."""
    rows = spark.table(full_name(database, table))
    first = as_of - timedelta(days=days)
    return rows.where(F.col(DAY) >= F.lit(first)).drop(DAY)

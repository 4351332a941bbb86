"""ERP tables read from the country databases over JDBC, in parallel slices."""

from __future__ import annotations

import os
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.operators.joins import COUNTRY
from quipu.sources.erp import ROLLING_DAYS

FETCH_ROWS = "10000"


def connection(country: str) -> dict[str, str]:
    """Connection settings from the environment; nothing is stored in code."""
    prefix = f"ERP_{country.upper()}_"
    found = {k: os.environ.get(prefix + k.upper()) for k in ("url", "user", "password", "driver")}
    if not found["url"]:
        raise KeyError(f"set {prefix}URL to reach the {country} database")
    return {k: v for k, v in found.items() if v}


def day_slices(
    column: str, as_of: date, days: int = ROLLING_DAYS, slices: int = 36
) -> list[str]:
    """Disjoint date ranges that cover the window, one partition each; the last one is open.

    Each slice is a range the database can answer from an index, and no slice outgrows its days.
    """
    first = as_of - timedelta(days=days)
    cuts = [first + timedelta(days=days * i // slices) for i in range(slices)]
    ranges = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [*ranges, f"{column} >= '{cuts[-1]}'"]


def read_rolling(
    spark: SparkSession,
    country: str,
    table: str,
    column: str,
    as_of: date,
    days: int = ROLLING_DAYS,
    slices: int = 36,
) -> DataFrame:
    settings = connection(country)
    url = settings.pop("url")
    rows = spark.read.jdbc(
        url,
        table,
        predicates=day_slices(column, as_of, days, slices),
        properties={**settings, "fetchsize": FETCH_ROWS},
    )
    return rows.withColumn(COUNTRY, F.lit(country))


def read_table(
    spark: SparkSession,
    country: str,
    table: str,
    split_by: str,
    low: int,
    high: int,
    slices: int = 32,
) -> DataFrame:
    """A whole table in slices of a numeric column between its smallest and largest value."""
    if low > high:
        raise ValueError(f"no slices of {split_by} between {low} and {high}")
    reader = spark.read.format("jdbc").options(dbtable=table, fetchsize=FETCH_ROWS, **connection(country))
    slicing = {"partitionColumn": split_by, "lowerBound": low, "upperBound": high, "numPartitions": slices}
    return reader.options(**slicing).load().withColumn(COUNTRY, F.lit(country))

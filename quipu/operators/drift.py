"""Columns that a country's table lacks, or has beyond the others."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.functions.text import col
from quipu.operators.joins import COUNTRY

# The two kinds of difference.
MISSING, EXTRA = "COLUMN_MISSING", "COLUMN_EXTRA"


def expected_columns(columns: Mapping[str, Iterable[str]]) -> set[str]:
    """The columns more than half of the countries have."""
    names = [set(c) - {COUNTRY} for c in columns.values()]
    return {n for n in set().union(*names) if 2 * sum(n in have for have in names) > len(names)}


def schema_drift(
    by_country: Mapping[str, DataFrame], table: str, expected: Iterable[str] | None = None
) -> DataFrame:
    """One row per country and differing column, with the rows and columns of that country.

    Names come from the schemas; the row counts show how much data each difference touches and are
    taken in one job. ``expected`` defaults to the columns most countries share.
    """
    columns = {c: [n for n in df.columns if n != COUNTRY] for c, df in by_country.items()}
    base = set(expected) if expected is not None else expected_columns(columns)
    parts = []
    for country, df in by_country.items():
        have = set(columns[country])
        found = [(n, MISSING) for n in sorted(base - have)]
        found += [(n, EXTRA) for n in sorted(have - base)]
        if not found:
            continue
        pairs = [F.struct(F.lit(n).alias("columna"), F.lit(k).alias("kind")) for n, k in found]
        counted = df.agg(F.count(F.lit(1)).alias("registros"))
        parts.append(
            counted.select(
                F.lit(country).alias("pais"),
                F.lit(table).alias("tabla"),
                F.explode(F.array(*pairs)).alias("d"),
                F.lit(len(have)).alias("columnas"),
                "registros",
            ).select("pais", "tabla", "d.columna", "d.kind", "columnas", "registros")
        )
    if not parts:
        spark = next(iter(by_country.values())).sparkSession
        schema = "pais string, tabla string, columna string, kind string, columnas int, registros long"
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def content_drift(df: DataFrame) -> DataFrame:
    """The same for a consolidated table, where a country's missing column is null in all its rows.

    One partial aggregation counts the filled cells of every column; a column counts as a country's
    when any cell is filled.
    """
    names = [n for n in df.columns if n != COUNTRY]
    filled = df.groupBy(COUNTRY).agg(
        F.count(F.lit(1)).alias("registros"),
        *[F.count(col(n)).alias(f"c{i}") for i, n in enumerate(names)],
    )
    pairs = [
        F.struct(F.lit(n).alias("columna"), (F.col(f"c{i}") > 0).alias("presente"))
        for i, n in enumerate(names)
    ]
    cells = filled.select(
        F.col(COUNTRY).alias("pais"), "registros", F.explode(F.array(*pairs)).alias("d")
    )
    cells = cells.select("pais", "registros", "d.columna", "d.presente")
    shares = cells.groupBy("columna").agg(
        F.count_if("presente").alias("_with"), F.count(F.lit(1)).alias("_all")
    )
    usual = 2 * F.col("_with") > F.col("_all")
    kind = F.when(usual & ~F.col("presente"), F.lit(MISSING)).when(
        ~usual & F.col("presente"), F.lit(EXTRA)
    )
    marked = cells.join(shares, "columna").select("pais", "columna", kind.alias("kind"), "registros")
    return marked.filter(F.col("kind").isNotNull())


def drift_totals(drift: DataFrame) -> DataFrame:
    """Differences per country: all, missing, extra."""
    return drift.groupBy("pais").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind") == MISSING).alias("faltantes"),
        F.count_if(F.col("kind") == EXTRA).alias("extras"),
    )

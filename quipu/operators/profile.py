"""Looking at a table: preview, counts, describe, frequencies, value filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.country import COUNTRIES
from quipu.functions.text import col
from quipu.operators.quartiles import order_statistics

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

#: The most values that are counted whole instead of by their next bits.
TALLY_ROWS = 1_000_000


def preview(df: DataFrame, rows: int = 100, order_by: Iterable[str] = ()) -> DataFrame:
    keys = [col(c) for c in order_by]
    return (df.orderBy(*keys) if keys else df).limit(rows)


def run_sql(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """Free SQL over registered views, with named parameters instead of spliced text."""
    return spark.sql(text, args=parameters or None)


def where_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(col(column).isin(list(values)))


def where_all(df: DataFrame, wanted: Mapping[str, object | None]) -> DataFrame:
    """Rows that match every filter given; ``None`` stands for "all" and filters nothing."""
    tests = [col(name) == F.lit(v) for name, v in wanted.items() if v is not None]
    return df.filter(reduce(and_, tests)) if tests else df


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).alias("columnas")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """The most frequent values; equal counts are ordered by value, nulls do not count."""
    valor = col(column).alias("valor")
    counted = df.select(valor).filter(F.col("valor").isNotNull()).groupBy("valor")
    return (
        counted.agg(F.count(F.lit(1)).alias("frecuencia"))
        .orderBy(F.desc("frecuencia"), "valor")
        .limit(top)
    )


def distinct_values(df: DataFrame, column: str, limit: int = 100) -> DataFrame:
    """The choices a value filter offers: the first distinct values, null included."""
    return df.select(col(column).alias("valor")).distinct().orderBy("valor").limit(limit)


def tables_by_country(tables: DataFrame, name: str = "tabla") -> DataFrame:
    """Tables with the country their name ends in, else OTROS; ``_OLD`` backups are left out.

    One row per table: a list per country would be as long as the catalog.
    """
    found = F.regexp_extract(F.col(name), f"_({'|'.join(COUNTRIES)})$", 1)
    group = F.when(found == "", F.lit("OTROS")).otherwise(found)
    return (
        tables.filter(~F.col(name).endswith("_OLD"))
        .select(group.alias("grupo"), F.col(name).alias("tabla"))
        .distinct()
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _doubles(df: DataFrame, names: list[str]) -> DataFrame:
    """The numeric columns as doubles under plain names; NaN counts as missing."""
    return df.select(
        *[F.nanvl(col(n).cast("double"), F.lit(None)).alias(f"c{i}") for i, n in enumerate(names)]
    )


def describe_numeric(
    df: DataFrame,
    columns: list[str] | None = None,
    accuracy: int | None = None,
    tally_rows: int = TALLY_ROWS,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column.

    Quartiles are interpolated between the two neighbouring values, which radix selection finds for all columns at
    once: one scan for the other figures and at most four more, however the values are spread. Where at most ``tally_rows``
    values share the bits found so far, their distinct values are counted at once. ``accuracy`` was that of a sketch and has
    no effect any more.
    """
    names = columns or numeric_columns(df)
    values = _doubles(df, names)
    aggregates = []
    for i in range(len(names)):
        c = F.col(f"c{i}")
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"mean{i}"),
            F.stddev_samp(c).alias(f"std{i}"),
            F.min(c).alias(f"min{i}"),
            F.max(c).alias(f"max{i}"),
        ]
    first = values.agg(*aggregates).first()  # one row, a few numbers per column
    places = {f"c{i}": [(first[f"n{i}"] - 1) * q for q in QUARTILES.values()] for i in range(len(names)) if first[f"n{i}"]}
    ranks = {c: [r for p in own for r in (int(p), int(p) + (p > int(p)))] for c, own in places.items()}
    found = order_statistics(values, ranks, tally_rows) if ranks else {}

    def quartiles(column: str) -> list[float | None]:
        out = []
        for p in places.get(column, []):
            low, high = found[column, int(p)], found[column, int(p) + (p > int(p))]
            out.append(low + (high - low) * (p - int(p)) if high != low else low)
        return out or [None] * len(QUARTILES)

    rows = [
        (n, first[f"n{i}"], first[f"mean{i}"], first[f"std{i}"], first[f"min{i}"], *quartiles(f"c{i}"), first[f"max{i}"])
        for i, n in enumerate(names)
    ]
    schema = "columna string, filas long, mean double, std double, min double, "
    schema += "p25 double, p50 double, p75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)

"""Slices of a source table that hold equally many rows, however its keys are spread.

Slices of equal width follow the calendar or the numbers, not the rows: a busy day, or a range that most keys fall
into, is then one slice and one task. Here the source itself names the first row of every slice, by its place
in the order of some columns, so that a day with a third of all rows is divided by the columns after it. Slices are
disjoint ranges that an index on those columns answers; rows without a first column are left out, as in a rolling scan.

A ranking window is one task in Spark, so a table of the session's own is ranked in ranges of the order instead.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.operators.joins import COUNTRY
from quipu.session import scratch_path
from quipu.sources.jdbc import FETCH_ROWS, connection

#: Answers a SQL text with rows, in the source; or the session, for a table or view of its own.
Ask = Callable[[str], DataFrame] | SparkSession

#: Rows of a range of the order, about, where Spark ranks.
PER_RANGE = 500_000


def literal(value) -> str:
    """A bound as the source's SQL reads it."""
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"'{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"'{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def bounds_sql(table: str, columns: Sequence[str], slices: int, where: str = "") -> str:
    """The first row of each slice with its place: rows ranked in order, and those at multiples of the depth."""
    names = ", ".join(columns)
    order = ", ".join([columns[0], *[f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END, {c}" for c in columns[1:]]])
    test = " AND ".join([f"{columns[0]} IS NOT NULL", *([f"({where})"] if where else [])])
    return (
        f"SELECT slice_row, {names} FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS slice_row, "
        f"COUNT(*) OVER () AS slice_rows FROM {table} WHERE {test}) ranked "
        f"WHERE slice_row % FLOOR((slice_rows + {slices - 1}) / {slices}) = 0"
    )


def from_bound(columns: Sequence[str], bound: Sequence) -> str:
    """Rows at or behind a bound in the order of the columns, never unknown; nulls stand before all values."""
    tests, same = [], []
    for i, (c, v) in enumerate(zip(columns, bound)):
        last = i == len(columns) - 1
        there = [f"{c} IS NOT NULL"] if i else []
        if v is None:
            tests.append([*same, "1 = 1" if last else there[0]])
            same.append(f"{c} IS NULL")
        else:
            tests.append([*same, *there, f"{c} {'>=' if last else '>'} {literal(v)}"])
            same += [*there, f"{c} = {literal(v)}"]
    return "(" + " OR ".join("(" + " AND ".join(t) + ")" for t in tests) + ")"


def predicates(columns: Sequence[str], bounds: Sequence[Sequence], where: str = "") -> list[str]:
    """Disjoint ranges from each bound to the next; the first and the last are open, so that no row is lost."""
    held = f"{columns[0]} IS NOT NULL" + (f" AND ({where})" if where else "")
    starts = [from_bound(columns, b) for b in bounds][1:]
    out = []
    for low, high in zip([None, *starts], [*starts, None]):
        out.append(" AND ".join([held, *([low] if low else []), *([f"NOT {high}"] if high else [])]))
    return out


def ranked(
    spark: SparkSession, table: str, columns: Sequence[str], slices: int, where: str = "", per_range: int = PER_RANGE
) -> list[tuple]:
    """The rows that ``bounds_sql`` asks for, of a table or view of the session.

    All rows are dealt into ranges of the order, as many as their number asks for, and kept so; a random number divides
    rows alike in all columns. The ranges' counts tell which of them hold the first row of a slice, and
    only those are ranked, each in a task.
    """
    rows = spark.table(table).where(f"({columns[0]}) IS NOT NULL")
    rows = rows.where(where) if where else rows
    total = rows.count()
    if not total:
        return []
    names = [f"c{i}" for i in range(len(columns))]
    path = scratch_path(spark, "ranked")
    dealt = rows.select(*[F.expr(c).alias(n) for c, n in zip(columns, names)], F.rand(0).alias("_tie"))
    dealt = dealt.repartitionByRange(-(-total // per_range), *names, "_tie")
    dealt.select(F.spark_partition_id().alias("_range"), *names).write.parquet(path)
    kept = spark.read.parquet(path)
    counts = sorted(tuple(r) for r in kept.groupBy("_range").agg(F.count(F.lit(1))).collect())  # a row per range
    starts = [0, *accumulate(n for _, n in counts)]
    firsts: dict[int, dict[int, int]] = {}
    for place in range(0, total, (total + slices - 1) // slices):
        i = bisect_right(starts, place) - 1
        firsts.setdefault(counts[i][0], {})[place - starts[i]] = place
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*names)) - 1
    held = kept.where(F.col("_range").isin(list(firsts))).withColumn("_place", inside)
    wanted = reduce(or_, [(F.col("_range") == r) & F.col("_place").isin(list(places)) for r, places in firsts.items()])
    found = held.where(wanted).select("_range", "_place", *names).collect()  # a row per slice
    return [(firsts[r[0]][r[1]], *r[2:]) for r in found]


def equal_slices(ask: Ask, table: str, columns: Sequence[str], slices: int, where: str = "") -> list[str]:
    """Predicates of at most ``slices`` slices; rows alike in all columns stay in one of them."""
    if isinstance(ask, SparkSession):
        found = ranked(ask, table, columns, slices, where)
    else:
        found = ask(bounds_sql(table, columns, slices, where)).collect()  # a row per slice
    bounds = list(dict.fromkeys(tuple(r)[1:] for r in sorted(found, key=lambda r: r[0])))
    return predicates(columns, bounds, where)


def read_equal(
    spark: SparkSession, country: str, table: str, columns: Sequence[str], slices: int = 36, where: str = ""
) -> DataFrame:
    """A country's table over JDBC in slices of equal depth; the bounds are a query at the source."""
    settings = connection(country)

    def ask(text: str) -> DataFrame:
        return spark.read.format("jdbc").options(query=text, **settings).load()

    found = equal_slices(ask, table, columns, slices, where)
    url = settings["url"]
    rest = {k: v for k, v in settings.items() if k != "url"}
    rows = spark.read.jdbc(url, table, predicates=found, properties={**rest, "fetchsize": FETCH_ROWS})
    return rows.withColumn(COUNTRY, F.lit(country))

"""What the catalog holds: tables, rows, bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.text import quoted

SCHEMA = "tabla string, filas long, bytes long"


def analyze(spark: SparkSession, database: str) -> None:
    """Refresh the row and byte counts Spark keeps for each table of a database."""
    spark.sql(f"ANALYZE TABLES IN {quoted(database)} COMPUTE STATISTICS")


def catalog_stats(spark: SparkSession, database: str, refresh: bool = True) -> DataFrame:
    """Tables with rows and bytes, from the statistics in the catalog; no table is read twice."""
    if refresh:
        analyze(spark, database)
    rows = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW":
            continue
        name = f"{quoted(database)}.{quoted(t.name)}"
        detail = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").first()
        rows.append((t.name, *_parse(detail["data_type"] if detail else "")))
    return spark.createDataFrame(rows, SCHEMA).orderBy("tabla")


def _parse(statistics: str) -> tuple[int | None, int | None]:
    """``"1024 bytes, 10 rows"`` as (rows, bytes)."""
    numbers = {unit: int(n) for n, unit in (p.split() for p in statistics.split(", ") if p)}
    return numbers.get("rows"), numbers.get("bytes")


def catalog_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("tablas"),
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


def session_columns() -> list[Column]:
    return [F.current_catalog().alias("catalogo"), F.current_database().alias("base"), F.current_user().alias("usuario")]


def session_info(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(*session_columns())

"""Table folders that no table names any more: found by what the catalog has, and deleted after a grace period.

Loads write a folder per version of a table. Replaced backups leave theirs behind on purpose, since someone may be reading
them, and a load that died half-way leaves what it had written.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions.text import quoted
from quipu.operators.load import discard
from quipu.sources.listing import full, listed

#: A folder of one version of a table, as ``replace_with_backup`` names it, directly below the root.
VERSION = r"^([^/]+-[0-9a-f]{32})/.+$"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(carpeta, archivos, bytes, ultimo): the version folders below ``root``, by their files, unfinished ones too."""
    top = full(root) + "/"
    below = F.substr("path", F.lit(len(top) + 1))
    files = listed(spark, root, "*", hidden=True).where(F.startswith("path", F.lit(top)))
    files = files.withColumn("name", F.regexp_extract(below, VERSION, 1)).where("name <> ''")
    return files.groupBy(F.concat(F.lit(top), "name").alias("carpeta")).agg(
        F.count(F.lit(1)).alias("archivos"), F.sum("bytes").alias("bytes"), F.max("modificationTime").alias("ultimo")
    )


def named(spark: SparkSession, databases: list[str]) -> DataFrame:
    """The folders of all tables of some databases."""
    rows = []
    for database in databases:
        for t in spark.catalog.listTables(database):
            if t.isTemporary or t.tableType == "VIEW":
                continue
            name = f"{quoted(database)}.{quoted(t.name)}"
            where = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()
            rows.append((where["data_type"].rstrip("/") if where else None,))
    return spark.createDataFrame(rows, "carpeta string").where("carpeta is not null")


def orphans(spark: SparkSession, root: str, databases: list[str]) -> DataFrame:
    """Version folders below ``root`` that are no table's, in any of the databases that live there."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    mine = versions(spark, root).withColumn("_at", plain("carpeta"))
    theirs = named(spark, databases).select(plain("carpeta").alias("_at"))
    return mine.join(theirs, "_at", "left_anti").drop("_at")


def sweep(
    spark: SparkSession, root: str, databases: list[str], now: datetime, grace: timedelta = timedelta(days=2)
) -> DataFrame:
    """Delete the orphans nobody has written to for ``grace``, and return them.

    All databases with tables below ``root`` must be named. The grace period must be longer than a load or a query
    takes, since a load's folder is no table's until it is whole.
    """
    old = orphans(spark, root, databases).where(F.col("ultimo") <= F.lit(now - grace))
    gone = old.collect()  # a folder per replaced version since the last sweep
    for row in gone:
        discard(spark, row.carpeta)
    return spark.createDataFrame(gone, "carpeta string, archivos long, bytes long, ultimo timestamp")

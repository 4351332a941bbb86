"""The newest snapshot of every table, kept as the state of a stream and as rows ready to read.

Files arrive in any order. The stream's state is one line per country and table, the newest stamp seen and the file that
bears it; nothing grows with the number of files. A batch in which a table's newest file changes replaces that
table's rows, folder by folder, and an older file that comes late changes nothing. A batch that is repeated after a
failure writes the same folders again. A newest file without rows leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quipu.functions.names import snapshot_stamp_of
from quipu.functions.text import col
from quipu.operators.control import _kept
from quipu.operators.joins import COUNTRY
from quipu.sources.landing import PARTS, country_of, describe_files, literal, read_csv
from quipu.streaming.landing import ARRIVALS, table_of

TABLE, FILE = "_tabla", "_archivo"
POINTER = "PAIS string, _tabla string, sello string, hora timestamp, archivo string"


def newest_files(arrivals: DataFrame) -> DataFrame:
    """(PAIS, _tabla, sello, hora, archivo): the file of the newest stamp per country and table.

    Of a folder of parts the time is that of the part that came last, so that a late part counts as a change.
    """
    files = arrivals.withColumn("whole", F.regexp_replace("path", PARTS, "$1"))
    named = describe_files(files, "whole").withColumn(TABLE, table_of(F.col("path")))
    stamp = F.coalesce(snapshot_stamp_of(F.col("archivo")), F.lit(""))
    newest = F.max(F.struct(stamp.alias("sello"), F.col("modificationTime").alias("hora"), F.col("whole").alias("archivo")))
    return named.groupBy(COUNTRY, TABLE).agg(newest.alias("n")).select(COUNTRY, TABLE, "n.sello", "n.hora", "n.archivo")


def pointers(spark: SparkSession, target: str) -> DataFrame:
    """The files that the target's rows come from, by the last batch that changed any."""
    found = _kept(spark, f"{target}/_punteros", "lote long, " + POINTER)
    last = found.groupBy(COUNTRY, TABLE).agg(F.max_by(F.struct("sello", "hora", "archivo"), "lote").alias("n"))
    return last.select(COUNTRY, TABLE, "n.*")


def stream_current(
    spark: SparkSession, root: str, pattern: str, target: str, checkpoint: str, files_per_batch: int = 200
) -> StreamingQuery:
    """Keep ``target`` at the newest snapshot of every table below ``root``; ends when all files are seen."""
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARRIVALS)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path", "modificationTime")
    )

    def replace(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        before = pointers(own, target).select(COUNTRY, TABLE, F.col("sello").alias("_s"), F.col("hora").alias("_h"), F.col("archivo").alias("_a"))
        same = F.col("sello").eqNullSafe(F.col("_s")) & F.col("hora").eqNullSafe(F.col("_h")) & F.col("archivo").eqNullSafe(F.col("_a"))
        changed = batch.join(before, [COUNTRY, TABLE], "left").where(~same).select(*batch.columns)
        rows = changed.collect()  # at most files_per_batch tables
        if not rows:
            return
        names = {r.archivo: r for r in rows}
        content = read_csv(own, [literal(p) for p in names], tag=FILE)
        tagged = content.withColumn(TABLE, table_of(F.col(FILE))).withColumn(COUNTRY, _country(F.col(FILE)))
        writer = tagged.drop(FILE).write.mode("overwrite").partitionBy(COUNTRY, TABLE)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{target}/filas")
        kept = own.createDataFrame(rows, POINTER).select(F.lit(number).cast("long").alias("lote"), "*")
        kept.coalesce(1).write.mode("append").parquet(f"{target}/_punteros")

    query = newest_files(arrivals).writeStream.outputMode("update").foreachBatch(replace)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _country(path):
    """The country a row's file lies in; parts go by the folder of their report."""
    whole = F.regexp_replace(path, PARTS, "$1")
    below = F.nullif(F.regexp_extract(whole, "/PAIS=([^/]+)$", 1), F.lit(""))
    return F.coalesce(below, country_of(whole))


def current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the newest snapshots; tables may differ in their columns."""
    rows = spark.read.option("mergeSchema", "true").parquet(f"{target}/filas")
    return rows.select(*[col(c) for c in rows.columns])

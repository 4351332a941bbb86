"""Incremental ingest: every landed file is read once, as it arrives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.names import snapshot_stamp_of
from quipu.functions.text import col
from quipu.operators.joins import COUNTRY
from quipu.sources.landing import country_of, literal, read_csv

FILE, STAMP, BATCH = "_archivo", "_sello", "_batch"

#: What the stream itself carries: which files arrived. Their content is read batch by batch.
ARRIVALS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def ingest(
    spark: SparkSession,
    root: str,
    pattern: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 200,
) -> None:
    """Append all files below ``root`` that match ``pattern`` and were not read before.

    The stream follows file names only, so each file can be read by its own header and in splits.
    Each batch replaces its own ``_batch`` folder: one that is repeated after a failure leaves no
    rows twice.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARRIVALS)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path")
    )

    def store(batch: DataFrame, number: int) -> None:
        paths = [literal(r.path) for r in batch.collect()]  # at most files_per_batch names
        if paths:
            rows = read_csv(batch.sparkSession, paths, tag=FILE)
            tagged = rows.withColumn(COUNTRY, country_of(F.col(FILE))).withColumn(
                STAMP, snapshot_stamp_of(F.col(FILE))
            )
            tagged.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    query = (
        arrivals.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """All rows read so far; files of different batches may differ in their columns."""
    return spark.read.option("mergeSchema", "true").parquet(target)


def current_rows(rows: DataFrame) -> DataFrame:
    """The rows of the newest snapshot of each country and table among all ingested ones.

    The table is the file's name, or its folder's where Spark wrote the parts of one. All files of
    the newest stamp belong to the snapshot. One row per file is compared; the rows themselves are
    picked by a join on the file's name.
    """
    files = rows.select(COUNTRY, FILE, STAMP).distinct().withColumn("_tabla", table_of(F.col(FILE)))
    newest = files.groupBy(COUNTRY, "_tabla").agg(F.max(F.coalesce(STAMP, F.lit(""))).alias("_ultimo"))
    same = files.join(newest, [COUNTRY, "_tabla"]).where(F.coalesce(STAMP, F.lit("")) == F.col("_ultimo"))
    kept = rows.join(same.select(FILE), FILE, "left_semi")
    hidden = {FILE, STAMP, BATCH}
    return kept.select(*[col(c) for c in rows.columns if c not in hidden])


def table_of(path: Column) -> Column:
    """The name a landed file has without country folder, stamp and ending; parts go by their folder."""
    inside = F.regexp_replace(path, r"/(PAIS=[^/]*/)?part-[^/]*$", "")
    name = F.regexp_extract(inside, "([^/]+)$", 1)
    return F.upper(F.regexp_replace(name, r"(_\d{8}_\d{6})|(_normalizado)|(\.csv$)", ""))

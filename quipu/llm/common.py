"""Helpers shared by the operators: staged tables, positions in large groups, links to components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.session import scratch_path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: fewer of them in a batch that goes to Python keep its memory small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def buckets_for(rows: int, per_bucket: int = 50_000, least: int = 64) -> int:
    return max(least, -(-rows // per_bucket))


def positions(df: DataFrame, group: list[str], order: list[str], name: str, buckets: int) -> DataFrame:
    """Adds each row's place in its group, gapless from 0, without meeting a group in one task.

    A group is divided by a hash of the ordering columns; the divisions' counts give every division
    its first place. Rows equal in all ordering columns must be interchangeable.
    """
    parted = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = parted.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy(*group, "_b").orderBy(*order)
    return (
        parted.join(base, [*group, "_b"])
        .withColumn(name, F.col("_from") + F.row_number().over(inside) - 1)
        .drop("_b", "_from")
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of the undirected links (x, y); the root is the smallest node.

    Alternates the two star contractions, each of which replaces links by links to smaller
    neighbours, until every link is one from a node to its root. A node's neighbours meet only in
    a minimum and in a join that Spark can split.
    """
    now = staged(
        edges.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(),
        label,
    )
    seen = None
    while True:
        both = now.union(now.select("y", "x"))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("m").alias("x"), "y").where("x <> y").distinct()
        low = large.groupBy("y").agg(F.min("x").alias("m"))
        small = large.join(low, "y").select(F.col("m").alias("a"), F.col("x").alias("b"), "y")
        small = small.select("a", F.explode(F.array("b", "y")).alias("y")).where("a <> y")
        now = staged(small.select(F.col("a").alias("x"), "y").distinct(), label)
        state = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == seen:
            return now.select(F.col("y").alias("node"), F.col("x").alias("root")).union(
                now.select(F.col("x").alias("node"), F.col("x").alias("root")).distinct()
            )
        seen = state


def small(df: DataFrame, most: int = 500_000) -> DataFrame:
    """Marked for broadcast where a count shows at most ``most`` rows; left to a shuffle otherwise."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def local_path(path: str) -> str:
    """A shared folder's path as files see it; every executor must have the folder mounted."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {path}")
    return path

"""Results of free SQL kept for a while, by what was asked and by what the source files were.

A key is the statement's analysed plan, without the names and numbers that differ between runs, and a digest of the
names, sizes and times of all files below it. The digest is an aggregate over a listing: no file is opened, and
one line per task comes back. A changed, new or missing file gives another key. Plans over anything but files and
values (a database, a stream) and plans that give something else each time are not kept.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.operators.load import discard
from quipu.operators.profile import run_sql

#: Seconds an entry is good for.
LIFE = 300


def _leaves(df: DataFrame) -> list:
    """The plan's leaves, subqueries' included."""
    plan = df._jdf.queryExecution().analyzed()
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        leaves, inner = node.collectLeaves(), node.subqueriesAll()
        found += [leaves.apply(i) for i in range(leaves.size())]
        open_ += [inner.apply(i) for i in range(inner.size())]
    return found


def source_folders(df: DataFrame) -> list[str] | None:
    """The files and folders a plan reads, or ``None`` where it reads something else as well."""
    out: set[str] = set()
    for leaf in _leaves(df):
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            out |= {paths.apply(i).toString() for i in range(paths.size())}
        elif kind not in ("LocalRelation", "OneRowRelation", "Range", "OneRowRelation$"):
            return None
    return sorted(out)


def files_digest(spark: SparkSession, folders: list[str]) -> str:
    """One digest of the names, sizes and times of all files below some folders, the same in any order."""
    if not folders:
        return "-"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    each = F.xxhash64("path", "length", "modificationTime")
    again = F.xxhash64(F.lit(1), "path", "length", "modificationTime")
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (each, again)]
    return str(tuple(listed.agg(F.count(F.lit(1)), F.sum("length"), *sums).first()))


def key_of(df: DataFrame) -> str | None:
    """The entry's name, or ``None`` for a plan that must not be kept."""
    analyzed = df._jdf.queryExecution().analyzed()
    folders = source_folders(df)
    names = [c.lower() for c in df.columns]
    if folders is None or not analyzed.deterministic() or len(set(names)) < len(names):
        return None
    plan = analyzed.canonicalized().toString()
    parts = (plan, str(df.semanticHash()), df.schema.json(), files_digest(df.sparkSession, folders))
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()


def _entries(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Finished entries of a key with the milliseconds they were made at, the newest first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    found = []
    for status in store.listStatus(place):
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if store.exists(done):
            found.append((int(status.getPath().getName().split("-")[0]), status.getPath().toString()))
    return sorted(found, reverse=True)


def cached(df: DataFrame, root: str, life: float = LIFE, clock: Callable[[], float] = time.time) -> DataFrame:
    """The result of ``df``, from an entry no older than ``life`` seconds where there is one.

    Otherwise it is computed and kept; rows of an entry come in no order. Older entries of the key are deleted when a new one is there, except the
    youngest of them, which someone may still be reading.
    """
    spark, key = df.sparkSession, key_of(df)
    if key is None:
        return df
    folder, now = f"{root.rstrip('/')}/{key}", int(clock() * 1000)
    entries = _entries(spark, folder)
    if entries and now - entries[0][0] <= life * 1000:
        return spark.read.schema(df.schema).parquet(entries[0][1])
    path = f"{folder}/{now}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for _, old in entries[1:]:
        discard(spark, old)
    return spark.read.schema(df.schema).parquet(path)


def cached_sql(
    spark: SparkSession, text: str, root: str, life: float = LIFE, clock: Callable[[], float] = time.time, **parameters
) -> DataFrame:
    """Free SQL with a result cache."""
    return cached(run_sql(spark, text, **parameters), root, life, clock)

"""Controlled extraction: what changed between two extractions of a table, by a tree of digests.

Every extraction is stored by country and month. Its leaves are the digests of those parts, a country's digest is that of
its leaves, the table's that of its countries. Leaves are kept as a history. The next run compares them, and only parts
whose digests differ are read again and compared row by row; an untouched month costs one line. A country gets a
new version with each run, and a record with its file, digest and verdict:

* ``INICIAL`` where nothing was extracted before,
* ``OK`` where all rows of before are still there, more may have come,
* ``MODIFICADO`` where rows changed or went, or a column came, went or changed its type.

Months before the start of a rolling window left with the window; that is no modification.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.text import col
from quipu.operators.integrity import (
    INITIAL,
    MODIFIED,
    SEPARATOR,
    STATES,
    UNCHANGED,
    fingerprints,
    key_columns,
    snapshot_changes,
)
from quipu.operators.joins import COUNTRY
from quipu.sources.erp import bound, date_column

#: The folder column of a row's month; rows without a date have the empty month's folder.
MONTH = "_mes"
RUN = "_corrida"
NO_MONTH = "-"

LEAF = "tabla string, pais string, mes string, corrida string, version int, registros long, hash_sha256 string"
RECORD = (
    "pais string, tabla string, version int, estado string, total_registros long, timestamp timestamp_ntz, "
    "hash_sha256 string, archivo string, meses int, meses_comparados int, iguales long, modificadas long, "
    "agregadas long, eliminadas long"
)


def month_of(df: DataFrame, column: str | None) -> Column:
    return F.coalesce(F.date_format(col(column), "yyyy-MM"), F.lit(NO_MONTH)) if column else F.lit(NO_MONTH)


def store(df: DataFrame, root: str, table: str, run: str, column: str | None) -> str:
    """Keep an extraction by country and month; returns its folder.

    A part's rows come together in a few tasks, so that it has a few files and not one from every task; a part too
    large for one task is divided by the engine.
    """
    path = f"{root.rstrip('/')}/{table}/{RUN}={run}"
    rows = df if COUNTRY in df.columns else df.withColumn(COUNTRY, F.lit(""))
    rows = rows.withColumn(MONTH, month_of(df, column)).hint("rebalance", F.col(COUNTRY), F.col(MONTH))
    rows.write.mode("errorifexists").partitionBy(COUNTRY, MONTH).parquet(path)
    return path


def stored(spark: SparkSession, root: str, table: str, run: str, like: DataFrame | None = None) -> DataFrame:
    """An extraction read back; country and month are its folders' names, as text. ``like`` is what was stored."""
    path = f"{root.rstrip('/')}/{table}/{RUN}={run}"
    found = spark.read.parquet(path).schema if like is None else like.schema
    found = T.StructType([*[f for f in found if f.name not in (COUNTRY, MONTH)], *(T.StructField(n, T.StringType()) for n in (COUNTRY, MONTH))])
    df = spark.read.schema(found).parquet(path)
    return df.withColumn(COUNTRY, F.coalesce(F.col(COUNTRY), F.lit("")))


def leaves(rows: DataFrame) -> DataFrame:
    """(pais, mes, registros, hash_sha256) of a stored extraction, in one scan and one small shuffle."""
    columns = sorted(c for c in rows.columns if c != MONTH)
    found = fingerprints(rows, [F.col(COUNTRY), F.col(MONTH)], columns)
    return found.select(
        F.col("_g0").alias("pais"), F.col("_g1").alias("mes"), F.col("total_registros").alias("registros"), "hash_sha256"
    )


def roots(leaves_: DataFrame) -> DataFrame:
    """(pais, registros, meses, hash_sha256): the node over each country's months; there are as many as in a calendar."""
    text = F.concat_ws(":", "mes", "hash_sha256")
    return leaves_.groupBy("pais").agg(
        F.sum("registros").alias("registros"),
        F.count(F.lit(1)).cast("int").alias("meses"),
        F.sha2(F.concat_ws(SEPARATOR, F.array_sort(F.collect_list(text))), 256).alias("hash_sha256"),
    )


def table_root(leaves_: DataFrame) -> DataFrame:
    """(registros, hash_sha256) of the whole table, over its countries' nodes."""
    text = F.concat_ws(":", "pais", "hash_sha256")
    return roots(leaves_).agg(
        F.sum("registros").alias("registros"),
        F.sha2(F.concat_ws(SEPARATOR, F.array_sort(F.collect_list(text))), 256).alias("hash_sha256"),
    )


def _kept(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A history folder, or nothing where there is none yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def leaf_history(spark: SparkSession, root: str) -> DataFrame:
    return _kept(spark, f"{root.rstrip('/')}/_control/hojas", LEAF)


def history(spark: SparkSession, root: str) -> DataFrame:
    """All records so far; its first columns are those of ``integrity.HISTORY``."""
    return _kept(spark, f"{root.rstrip('/')}/_control/registros", RECORD)


def newest(leaves_: DataFrame) -> DataFrame:
    """The leaves of each country's newest version."""
    by = Window.partitionBy("tabla", "pais")
    return leaves_.withColumn("_last", F.max("version").over(by)).where("version = _last").drop("_last")


def compared(old: Sequence[Row], new: Sequence[Row], first_month: str | None) -> list[tuple[str, str, str | None, int, int, str]]:
    """(country, month, earlier run, rows before, rows now, case) of all leaves of either side.

    A case is igual, distinta, nueva, ausente, or vencida for a month that has left the window. There are as many
    leaves as countries times months, so they are compared in the driver.
    """
    before, now = ({(r.pais, r.mes): r for r in side} for side in (old, new))
    out = []
    for country, month in sorted(before.keys() | now.keys()):
        was, is_ = before.get((country, month)), now.get((country, month))
        if was is None:
            case = "nueva"
        elif is_ is None:
            case = "vencida" if first_month and month != NO_MONTH and month < first_month else "ausente"
        else:
            case = "igual" if was.hash_sha256 == is_.hash_sha256 else "distinta"
        run = was.corrida if was else None
        out.append((country, month, run, was.registros if was else 0, is_.registros if is_ else 0, case))
    return out


def node(leaves_: Sequence[Row]) -> str:
    """The digest over a country's leaves, as ``roots`` has it."""
    texts = sorted((f"{r.mes}:{r.hash_sha256}" for r in leaves_), key=str.encode)
    return hashlib.sha256(SEPARATOR.join(texts).encode()).hexdigest()


def parts(rows: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """The named (country, month) parts of a stored extraction; the others' folders are not read."""
    by: dict[str, list[str]] = {}
    for country, month in wanted:
        by.setdefault(country, []).append(month)
    tests = [(F.col(COUNTRY) == c) & F.col(MONTH).isin(sorted(m)) for c, m in by.items()]
    return rows.where(reduce(or_, tests, F.lit(False)))


def changes(
    spark: SparkSession,
    root: str,
    table: str,
    before: DataFrame,
    run: str,
    differing: Sequence[tuple[str, str, str]],
    keys: Sequence[str],
    since: Column | None,
) -> DataFrame:
    """Per country, rows kept, changed, added and removed within the differing parts (country, month, earlier run)."""
    new = parts(stored(spark, root, table, run), [(c, m) for c, m, _ in differing])
    old = parts(before, [(c, m) for c, m, _ in differing])
    if since is not None:
        old = old.where(since)
    shared = [k for k in keys if k in old.columns and k in new.columns and k != COUNTRY]
    found = snapshot_changes(old.drop(MONTH), new.drop(MONTH), [COUNTRY, *shared])
    names = ("iguales", "modificadas", "agregadas", "eliminadas")
    return found.groupBy(F.col(COUNTRY).alias("pais")).agg(*[F.sum(n).alias(n) for n in names])


def control_run(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    table: str,
    at: datetime,
    keys: Sequence[str] | None = None,
    declared_date: str | None = None,
    since: date | None = None,
) -> DataFrame:
    """Store an extraction, compare it with the one before, append to the history, and return this run's records.

    ``since`` is the first day of a rolling window. One table is extracted by one run at a time.
    """
    run = f"{at:%Y%m%d_%H%M%S}"
    column = date_column(df, declared_date)
    path = store(df, root, table, run, column)
    new_rows = stored(spark, root, table, run, df)
    new = leaves(new_rows).collect()  # countries times months, here and below
    old = newest(leaf_history(spark, root).where(F.col("tabla") == table)).collect()
    versions = {r.pais: r.version for r in old}
    found = compared(old, new, f"{since:%Y-%m}" if since else None)
    moved: dict[str, list[int]] = {}
    schemas_differ: set[str] = set()
    for earlier in sorted({run_ for _, _, run_, _, _, case in found if run_ and case != "vencida"}):
        before = stored(spark, root, table, earlier)
        if dict(before.dtypes) != dict(new_rows.dtypes):
            schemas_differ |= {country for country, _, run_, *_ in found if run_ == earlier}
        mine = [(country, month, run_) for country, month, run_, _, _, case in found if case == "distinta" and run_ == earlier]
        if mine:
            limit = (F.col(column) >= bound(before, column, since)) if since and column and column in before.columns else None
            rows = changes(spark, root, table, before, run, mine, keys or key_columns(df), limit)
            moved |= {r.pais: [r.iguales, r.modificadas, r.agregadas, r.eliminadas] for r in rows.collect()}
    records, kept = [], []
    for country in sorted({r.pais for r in new}):
        own, held = [f for f in found if f[0] == country], [r for r in new if r.pais == country]
        same, changed, came, gone = moved.get(country, [0, 0, 0, 0])
        same += sum(was for *_, was, _, case in own if case == "igual")
        came += sum(now for *_, now, case in own if case == "nueva")
        gone += sum(was for *_, was, _, case in own if case == "ausente")
        version = versions.get(country, 0) + 1
        verdict = MODIFIED if changed or gone or country in schemas_differ else UNCHANGED
        verdict = verdict if version > 1 else INITIAL
        read = sum(f[-1] == "distinta" for f in own)
        total, file = sum(r.registros for r in held), f"{path}/{COUNTRY}={country}"
        records.append(
            (country, table, version, STATES[verdict], total, at, node(held), file, len(held), read, same, changed, came, gone)
        )
        kept += [(table, country, r.mes, run, version, r.registros, r.hash_sha256) for r in held]
    out = spark.createDataFrame(records, RECORD)
    base = f"{root.rstrip('/')}/_control"
    spark.createDataFrame(kept, LEAF).coalesce(1).write.mode("append").parquet(f"{base}/hojas")  # first: versions are counted here
    out.coalesce(1).write.mode("append").parquet(f"{base}/registros")
    return out

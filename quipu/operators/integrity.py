"""Fingerprints of snapshots, what changed between two of them, and the control history."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.text import col
from quipu.operators.profile import where_all

SEPARATOR = "\x1f"
MISSING = "-"

# Verdicts of a control run and the states the history shows for them.
INITIAL, UNCHANGED, MODIFIED = "INICIAL", "OK", "MODIFICADO"
STATES = {
    INITIAL: "inicial",
    UNCHANGED: "actualizado_incremental",
    MODIFIED: "modificacion_detectada",
}

#: Types whose text has one byte per character, so that its length need not be counted.
ASCII_TYPES = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

#: Up to so many columns a row's text is written out twice in the plan; more would make methods too long to be compiled.
FLAT = 16

HISTORY = T.StructType(
    [
        T.StructField("pais", T.StringType()),
        T.StructField("tabla", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("estado", T.StringType()),
        T.StructField("total_registros", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("hash_sha256", T.StringType()),
    ]
)


def key_columns(df: DataFrame) -> list[str]:
    """The columns that identify a row for control: those named after a date, else the first two."""
    dated = [n for n in df.columns if "fecha" in n.lower() or "date" in n.lower()]
    return dated or df.columns[:2]


def float_columns(df: DataFrame) -> list[str]:
    keys = set(key_columns(df))
    floats = (T.FloatType, T.DoubleType)
    return [f.name for f in df.schema if isinstance(f.dataType, floats) and f.name not in keys]


def row_text(df: DataFrame, columns: Iterable[str] | None = None, digits: int = 6) -> Column:
    """A row as one text; floats are rounded first so that noise in the last digits is no change.

    Each cell is led by its length, or is a mark for null, so no two rows have one text, whatever
    separators and control characters their cells hold. Instants are written at UTC, whatever the session's zone.
    """
    types = {f.name: f.dataType for f in df.schema}
    pieces, cells = [], []
    for name in columns or sorted(df.columns):
        value, kind = col(name), types.get(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = F.round(value, digits)
        cell = (_at_utc(value) if isinstance(kind, T.TimestampType) else value).cast("string")
        size = (F.octet_length if isinstance(kind, ASCII_TYPES) else F.length)(cell).cast("string")
        cells.append(F.coalesce(F.concat(size, F.lit(":"), cell), F.lit(MISSING)))
        pieces += [F.lit(SEPARATOR), size, F.lit(":"), cell]
    marked = F.concat_ws(SEPARATOR, *cells)
    return F.coalesce(F.concat(*pieces[1:]), marked) if len(cells) <= FLAT else marked  # rows without nulls are joined in one step


def _at_utc(instant: Column) -> Column:
    """An instant as the clock at UTC shows it; counted from the epoch, so no zone's summer time gets in between."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    return F.sha2(row_text(df, columns), 256)


def fingerprint(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One SHA-256 per table, the same for any order or partitioning of its rows.

    Row digests are combined by order-free sums, so every task reduces its rows to one line before
    anything is shuffled. Sums over two independent 60-bit parts of the digest, an exclusive or and
    the row count tell apart tables that differ in a repeated row. Only SHA-256 and integer sums are
    involved, so other engines can verify the value.
    """
    return fingerprints(df, [], columns)


def fingerprints(df: DataFrame, by: Sequence[Column], columns: Iterable[str] | None = None) -> DataFrame:
    """A fingerprint per group; a task sends one line per group, whatever its rows."""
    names = [f"_g{i}" for i in range(len(by))]
    digest = row_hash(df, columns)
    groups = [c.alias(n) for c, n in zip(by, names)]
    halves = df.select(*groups, _bits(digest, 1).alias("a"), _bits(digest, 16).alias("b"))
    # summed as three 20-bit numbers each: exact in a long up to 2**43 rows, and cheaper than a sum of decimals
    piece = lambda c, k: F.shiftright(c, 20 * k).bitwiseAND(F.lit((1 << 20) - 1))
    sums = halves.groupBy(*names).agg(
        F.count(F.lit(1)).alias("total_registros"),
        *[F.coalesce(F.sum(piece(c, k)), F.lit(0)).cast("decimal(38,0)").alias(f"{c}{k}") for c in "ab" for k in range(3)],
        F.coalesce(F.bit_xor("a"), F.lit(0)).alias("x"),
    )
    for c in "ab":
        sums = sums.withColumn(c, F.col(f"{c}0") + F.col(f"{c}1") * F.lit(1 << 20) + F.col(f"{c}2") * F.lit(1 << 40))
    parts = [F.col(c).cast("string") for c in ("total_registros", "a", "b", "x")]
    text = F.concat_ws(SEPARATOR, *parts)
    return sums.select(*names, "total_registros", F.sha2(text, 256).alias("hash_sha256"))


def _bits(digest: Column, start: int) -> Column:
    """Fifteen hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: rows kept, changed, added and removed between two snapshots.

    Keys may repeat, so rows are compared as multisets. Both snapshots are tagged and counted in
    one grouping by key and row digest, which spreads a frequent key (one busy day) over all tasks;
    only those counts are then grouped by key.
    """
    columns = sorted(c for c in new.columns if c in old.columns)

    def tagged(df: DataFrame, was: int) -> DataFrame:
        text = row_text(df, columns)
        return df.select(
            *[col(k) for k in keys],
            F.xxhash64(text).alias("_row"),
            F.xxhash64(F.lit(1), text).alias("_row2"),
            F.lit(was).alias("_old"),
            F.lit(1 - was).alias("_new"),
        )

    both = tagged(old, 1).unionAll(tagged(new, 0))
    per_row = both.groupBy(*[col(k) for k in keys], "_row", "_row2").agg(
        F.sum("_old").alias("_old"), F.sum("_new").alias("_new")
    )
    kept = F.sum(F.least("_old", "_new"))
    gone = F.sum(F.greatest(F.col("_old") - F.col("_new"), F.lit(0)))
    come = F.sum(F.greatest(F.col("_new") - F.col("_old"), F.lit(0)))
    per_key = per_row.groupBy(*[col(k) for k in keys]).agg(
        kept.alias("iguales"), gone.alias("_gone"), come.alias("_come")
    )
    changed = F.least("_gone", "_come")
    return per_key.select(
        *[col(k) for k in keys],
        "iguales",
        changed.alias("modificadas"),
        (F.col("_come") - changed).alias("agregadas"),
        (F.col("_gone") - changed).alias("eliminadas"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows kept, changed, added and removed in all, and the verdict.

    Rows that were there before must all be there unchanged; more rows may have come. A column that
    came, went or changed its type is a modification of its own; keys that only one of the snapshots
    has cannot be compared by.
    """
    keys = [k for k in keys if k in old.columns and k in new.columns]
    names = ("iguales", "modificadas", "agregadas", "eliminadas")
    totals = snapshot_changes(old, new, keys).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    )
    untouched = (F.col("modificadas") == 0) & (F.col("eliminadas") == 0)
    alike = F.lit(dict(old.dtypes) == dict(new.dtypes))
    verdict = F.when(untouched & alike, F.lit(UNCHANGED)).otherwise(F.lit(MODIFIED))
    return totals.withColumn("resultado", verdict)


def last_version(history: DataFrame, country: str, table: str) -> int:
    """The newest version of a table in the history, 0 when it has none."""
    mine = where_all(history, {"pais": country, "tabla": table})
    return mine.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def control(
    new: DataFrame,
    country: str,
    table: str,
    history: DataFrame,
    at,
    previous: DataFrame | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """The history row for a new snapshot, given the previous one and the history so far.

    A first snapshot is INICIAL and version 1; each later one raises the version.
    """
    version = last_version(history, country, table)
    if version == 0 or previous is None:
        verdict = INITIAL
    else:
        verdict = snapshot_diff(previous, new, keys or key_columns(new)).first()["resultado"]
    return fingerprint(new).select(
        F.lit(country).alias("pais"),
        F.lit(table).alias("tabla"),
        F.lit(version + 1).alias("version"),
        F.lit(STATES[verdict]).alias("estado"),
        "total_registros",
        F.lit(at).cast("timestamp_ntz").alias("timestamp"),
        "hash_sha256",
    )


def history_filter(
    history: DataFrame,
    country: str | None = None,
    table: str | None = None,
    state: str | None = None,
) -> DataFrame:
    wanted = where_all(history, {"pais": country, "tabla": table, "estado": state})
    return wanted.select(*HISTORY.names)


def history_metrics(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(F.col("estado") == STATES[MODIFIED]).alias("modificaciones"),
        F.coalesce(F.sum("version"), F.lit(0)).alias("total_versiones"),
        F.countDistinct("tabla").alias("tablas_unicas"),
    )


def history_stats(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.countDistinct("tabla").alias("tablas_unicas"),
        F.countDistinct("pais").alias("paises_unicos"),
        F.count_if(F.col("estado") == STATES[MODIFIED]).alias("modificaciones_detectadas"),
        F.max("timestamp").alias("ultima_actualizacion"),
    )

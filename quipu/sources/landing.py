"""Landed CSV files: which ones there are, and reading them tolerantly."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.names import (
    NORMALISED,
    disambiguate,
    normalize_header,
    snapshot_name_of,
    snapshot_stamp_of,
    table_name_of,
)
from quipu.functions.text import blank_to_null, col
from quipu.sources.erp import BASE_TABLES

BOM = "\ufeff"
CORRUPT = "_corrupt"

#: Marks of rows with more cells than their header, and with fewer.
LONG, SHORT = "_larga", "_corta"

#: A part of a file that is a folder, and the name of a file or of such a folder.
PARTS = r"(/[^/]+\.csv(?:/PAIS=[^/]*)?)/[^/]+$"
FILE_NAME = r"([^/]+)(?:/PAIS=[^/]*)?$"

#: Columns that hold codes and stay text whatever they look like.
CODE_PREFIXES = ("COD", "CODIGO", "NUMERO")
CODE_NAMES = ("EAN", "RUC", "RFC", "NIT", "DNI")


def landed_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """One row per landed file: country (its folder), name, path, size, time.

    A folder named ``*.csv`` is one file in several parts, by country below it where Spark wrote one so. No
    content is read. Spark passes over files of zero bytes, which have not even a header.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.regexp_replace("path", PARTS, "$1").alias("path"), "length", "modificationTime")
    )
    whole = files.groupBy("path").agg(
        F.sum("length").alias("bytes"), F.max("modificationTime").alias("modificationTime")
    )
    return describe_files(whole, "path").select("PAIS", "archivo", "path", "bytes", "modificationTime")


def describe_files(df: DataFrame, path: str) -> DataFrame:
    below = F.nullif(F.regexp_extract(F.col(path), "/PAIS=([^/]+)$", 1), F.lit(""))
    return df.withColumn("PAIS", F.coalesce(below, country_of(F.col(path)))).withColumn(
        "archivo", F.regexp_extract(F.col(path), FILE_NAME, 1)
    )


def country_of(path: Column) -> Column:
    """The folder a file lies in: ``CHILE/x.csv``, or ``PAIS=CHILE/x.csv`` as Spark writes it."""
    return F.regexp_extract(path, "([^/=]+)/[^/]+$", 1)


def snapshots(files: DataFrame) -> DataFrame:
    """Each file with the name it has without its time stamp, its table, and the stamp."""
    finished = F.when(
        F.col("archivo").endswith(NORMALISED), F.col("archivo")
    ).otherwise(F.concat(F.regexp_replace("archivo", r"\.csv$", ""), F.lit(NORMALISED)))
    return (
        files.withColumn("nombre", snapshot_name_of(finished, F.col("PAIS")))
        .withColumn("tabla", table_name_of(F.col("nombre")))
        .withColumn("sello", snapshot_stamp_of(F.col("archivo")))
    )


def latest_snapshots(files: DataFrame) -> DataFrame:
    """The newest file per country and name; all files may stay where they are.

    An aggregation instead of a window: each task keeps one candidate per name, so a name with very
    many files needs no sort and no large group.
    """
    named = snapshots(files)
    newest = F.max_by(F.struct(*[F.col(c) for c in named.columns]), F.struct("sello", "archivo"))
    return named.groupBy("PAIS", "nombre").agg(newest.alias("n")).select("n.*")


def read_table_list(spark: SparkSession, path: str | None = None) -> list[str]:
    """Table names from a one-column list file, or the usual ones."""
    if path is None:
        return list(BASE_TABLES)
    rows = spark.read.option("header", "true").csv(path).collect()  # a short list of names
    return [r[0].strip() for r in rows if r[0] and r[0].strip()]


def literal(path: str) -> str:
    """A file path with the characters a reader would take for a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def sniff_delimiter(line: str) -> str:
    return ";" if line.count(";") > line.count(",") else ","


def header_of(line: str) -> list[str]:
    return next(csv.reader([line], delimiter=sniff_delimiter(line)), [])


def warehouse_names(header: list[str]) -> list[str]:
    return disambiguate(normalize_header(h) for h in header)


def layouts(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, bool]]:
    """Each file with its first line, and whether a quoted cell in it spans lines: some line opens one and does not
    close it. One scan over all files; every task sends one row per file, and files without a line are not there."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).select(
        "value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")
    )
    rest = F.regexp_replace("value", '(^|[,;])[ ]*"(?:[^"]|"")*"', "$1")
    opens = F.col("value").contains('"') & rest.rlike('(^|[,;])[ ]*"')  # few lines have a quote to look for
    found = lines.groupBy("file_path").agg(
        F.min_by("value", F.struct("file_block_start", "at")).alias("first"), F.max(opens).alias("spans")
    )
    clean = lambda line: line.removeprefix(BOM).rstrip("\r")
    return {unquote(r.file_path): (clean(r.first), r.spans) for r in found.collect()}  # one row per file


def read_csv(
    spark: SparkSession, paths: str | list[str], normalise: bool = True, tag: str | None = None
) -> DataFrame:
    """Landed CSV files as text columns; ``tag`` names a column for the file a row came from.

    The first line of each file gives its delimiter and names, also among the files of one folder;
    columns that some files lack are null there. Rows with more cells than the header are skipped,
    shorter ones are filled with nulls, and the words for "no value" become null.

    Files are read in splits. Only one with a cell that spans lines has to be parsed from its start,
    by one task and as a stream; one scan gives all headers and finds those files.
    """
    return fitting(read_marked(spark, paths, normalise, tag))


def read_marked(
    spark: SparkSession, paths: str | list[str], normalise: bool = True, tag: str | None = None
) -> DataFrame:
    """As ``read_csv``, with over-long rows kept and both kinds of ragged rows marked (``LONG``, ``SHORT``)."""
    paths = [paths] if isinstance(paths, str) else paths
    alike: dict[tuple[str, bool], list[str]] = {}
    for path, layout in sorted(layouts(spark, paths).items()):
        alike.setdefault(layout, []).append(literal(path))
    if not alike:
        raise ValueError(f"no header in {paths}: no line at all")
    parts = []
    for (line, multi_line), members in alike.items():
        header = header_of(line)
        if not header:
            raise ValueError(f"no header in {members}")
        names = warehouse_names(header) if normalise else disambiguate(header)
        options = csv_options(sniff_delimiter(line), multi_line)
        raw = spark.read.schema(text_schema(names)).options(**options).csv(members)
        if tag:
            raw = raw.select("*", F.col("_metadata.file_path").alias(tag))
        parts.append(marked(raw, names, sniff_delimiter(line), [tag] if tag else []))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def csv_options(delimiter: str, multi_line: bool = False) -> dict[str, str]:
    return {
        "sep": delimiter,
        "header": "true",
        "enforceSchema": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": "false",
        "multiLine": str(multi_line).lower(),
        "quote": '"',
        "escape": '"',
        "emptyValue": "",
        "encoding": "UTF-8",
    }


def marked(
    raw: DataFrame, names: list[str], delimiter: str, tags: Sequence[str] = ()
) -> DataFrame:
    """Marks over-long and short rows, and turns words for "no value" into null.

    Spark marks both kinds as corrupt and keeps their text. The delimiters outside quoted cells tell
    them apart; a quote counts only where a cell begins, inch marks within one do not. ``tags`` are
    columns to pass on next to the file's own.
    """
    bare = F.regexp_replace(CORRUPT, quoted_cell(delimiter), "$1")
    delimiters = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))
    # The second test is always true. It makes every query read a cell besides the corrupt text,
    # which Spark refuses to read alone.
    there = F.length(F.coalesce(col(names[0]), F.lit(""))) >= 0
    over, under = (F.coalesce(test, F.lit(False)) & there for test in (delimiters >= len(names), delimiters < len(names) - 1))
    cells = [blank_to_null(col(n)).alias(n) for n in names]
    return raw.select(*cells, over.alias(LONG), under.alias(SHORT), *[col(t) for t in tags])


def fitting(rows: DataFrame) -> DataFrame:
    """Marked rows without the over-long ones and without the marks."""
    return rows.filter(~F.col(LONG)).drop(LONG, SHORT)


def quoted_cell(delimiter: str) -> str:
    """A cell in quotes, from the start of a line or a delimiter on."""
    return f'(^|{re.escape(delimiter)})[ ]*"(?:[^"]|"")*"'


def is_code(name: str) -> bool:
    upper = name.upper()
    return upper in CODE_NAMES or upper.startswith(CODE_PREFIXES)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns to declared types; codes stay text and what does not fit becomes null."""
    return df.select(
        *[
            col(n).try_cast(types[n]).alias(n) if n in types and not is_code(n) else col(n)
            for n in df.columns
        ]
    )

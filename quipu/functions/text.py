"""Blank-padded text, missing-value words and control characters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words a CSV cell may hold instead of a value.
NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: control characters a workbook cell may not hold (tab, newline and return may stay).
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def quoted(name: str) -> str:
    """A column or table name as a quoted identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and blanks included."""
    return F.col(quoted(name))


def equals_padded(column: Column, value: str) -> Column:
    """``column = value`` ignoring trailing blanks; the prefix test still reaches the file scan."""
    return column.startswith(value) & (F.rtrim(column) == F.lit(value))


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, F.lit("SI")).otherwise(F.lit("NO"))


def non_empty(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def blank_to_null(column: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    return F.when(column.isin(*words), F.lit(None).cast("string")).otherwise(column)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def map_strings(df: DataFrame, fn) -> DataFrame:
    """Apply ``fn`` to every text column in one projection, keeping names and order."""
    text = set(string_columns(df))
    return df.select(*[fn(col(n)).alias(n) if n in text else col(n) for n in df.columns])


def scrub_control_chars(df: DataFrame) -> DataFrame:
    """Drop the control characters that a workbook or a warehouse load would reject."""
    return map_strings(df, lambda c: F.regexp_replace(c, CONTROL_CHARS, ""))

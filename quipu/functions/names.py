"""Header, file and table names: Python for metadata, Column forms for name inventories.

The Python functions work on a handful of names (a schema, a file). The ``*_of`` functions do the
same to a column of names, for example all headers of all landed files.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from itertools import filterfalse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.text import quoted

# Headers whose standard name the general rule does not give. They match exactly,
# before blanks are stripped.
HEADER_EXCEPTIONS = {"Razon": "RAZON_SOCIAL", "TC": "TIPO_CAMBIO"}

# Spanish letters and their plain forms in file names; other non-ASCII is dropped.
ACCENTED = "áéíóúÁÉÍÓÚñÑüÜçÇ"
PLAIN = "aeiouAEIOUnNuUcC"

# Fixed value: symbols that become an underscore in file names.
NAME_SYMBOLS = """ -./\\:*?"<>|()[]{},;=+&%$#@!"""
UNDERSCORES = "_" * len(NAME_SYMBOLS)

# How landed files are stamped and what a normalised file is called.
STAMP = r"_\d{8}_\d{6}"
NORMALISED = "_normalizado.csv"
MAX_NAME = 128


def fold_accents(text: str) -> str:
    return "".join(filterfalse(unicodedata.combining, unicodedata.normalize("NFKD", text)))


def _one_underscore(text: str) -> str:
    return re.sub("_{2,}", "_", text)


def normalize_header(header: str) -> str:
    """The warehouse name of a CSV header; ``%`` and other symbols survive."""
    if header in HEADER_EXCEPTIONS:
        return HEADER_EXCEPTIONS[header]
    plain = fold_accents(header.strip())
    return _one_underscore(re.sub(r"[ .\-]", "_", plain).upper()).strip("_")


def disambiguate(names: Iterable[str]) -> list[str]:
    """Give repeated names the suffixes ``_1``, ``_2``, ... without touching first occurrences.

    Names that differ only in case count as repeated, since Spark resolves them alike. A suffix
    that another column already bears is passed over.
    """
    names = list(names)
    taken = {n.lower() for n in names}
    seen: dict[str, int] = {}
    out = []
    for name in names:
        key = name.lower()
        if key not in seen:
            seen[key] = 0
            out.append(name)
            continue
        while True:
            seen[key] += 1
            candidate = f"{name}_{seen[key]}"
            if candidate.lower() not in taken:
                break
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to warehouse names; metadata only, no pass over the data."""
    return df.toDF(*disambiguate(normalize_header(n) for n in df.columns))


def snapshot_name(file_name: str, country: str) -> str:
    """``X_20260122_143025_normalizado.csv`` becomes ``X_CHILE_normalizado.csv``.

    Every ``_{country}`` in the name goes, wherever it stands, before one is put at the end.
    """
    base = re.sub(STAMP, "", file_name).replace(NORMALISED, "").replace(f"_{country}", "")
    return _one_underscore(f"{base}_{country}{NORMALISED}")


def table_name(file_name: str) -> str:
    base = fold_accents(file_name.replace(NORMALISED, ""))
    return _one_underscore(re.sub(r"\W", "_", base)).upper().strip("_")


def ascii_name(name: str) -> str:
    """A file name in upper-case ASCII letters, digits and underscores, at most 128 long."""
    plain = name.translate(str.maketrans(ACCENTED + NAME_SYMBOLS, PLAIN + UNDERSCORES))
    plain = re.sub(r"[^a-zA-Z0-9_]", "", plain)
    plain = _one_underscore(plain).strip("_").upper()
    return plain if len(plain) <= MAX_NAME else plain[:MAX_NAME].rstrip("_")


def quote_ident(name: str) -> str:
    return quoted(name)


def warehouse_type(data_type: T.DataType) -> str:
    """The column type a warehouse table gets for a Spark type, chosen by class and not by name."""
    if isinstance(data_type, T.IntegralType):
        return "INTEGER"
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    if isinstance(data_type, T.FractionalType):
        return "FLOAT"
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP_NTZ"
    if isinstance(data_type, T.DateType):
        return "DATE"
    return "VARCHAR"


def _letter_folds() -> tuple[str, str]:
    """All Latin letters (and the hard blank) that decompose into one plain character."""
    points = [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]
    pairs = [(chr(p), fold_accents(chr(p))) for p in points]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents_of(text: Column) -> Column:
    """Accent folding inside code generation; covers Latin letters and loose combining marks."""
    accented, plain = _letter_folds()
    return F.regexp_replace(F.translate(text, accented, plain), r"\p{Mn}+", "")


def _one_underscore_of(text: Column) -> Column:
    return F.regexp_replace(text, "_{2,}", "_")


def _strip_underscores_of(text: Column) -> Column:
    return F.btrim(text, F.lit("_"))


def normalize_header_of(header: Column) -> Column:
    plain = fold_accents_of(F.regexp_replace(header, r"^\s+|\s+$", ""))
    plain = F.upper(F.translate(plain, " .-", "___"))
    general = _strip_underscores_of(_one_underscore_of(plain))
    out = general
    for raw, name in HEADER_EXCEPTIONS.items():
        out = F.when(header == raw, F.lit(name)).otherwise(out)
    return out


def snapshot_name_of(file_name: Column, country: Column) -> Column:
    base = F.replace(F.regexp_replace(file_name, STAMP, ""), F.lit(NORMALISED), F.lit(""))
    base = F.replace(base, F.concat(F.lit("_"), country), F.lit(""))
    return _one_underscore_of(F.concat(base, F.lit("_"), country, F.lit(NORMALISED)))


def snapshot_stamp_of(file_name: Column) -> Column:
    """The last ``yyyyMMdd_HHmmss`` in a file name, or an empty text."""
    return F.regexp_extract(file_name, r".*_(\d{8}_\d{6})", 1)


def table_name_of(file_name: Column) -> Column:
    base = fold_accents_of(F.replace(file_name, F.lit(NORMALISED), F.lit("")))
    base = F.regexp_replace(base, r"[^\p{L}\p{N}_]", "_")
    return _strip_underscores_of(F.upper(_one_underscore_of(base)))


def ascii_name_of(name: Column) -> Column:
    plain = F.translate(name, ACCENTED + NAME_SYMBOLS, PLAIN + UNDERSCORES)
    plain = _one_underscore_of(F.regexp_replace(plain, r"[^a-zA-Z0-9_]", ""))
    plain = F.upper(_strip_underscores_of(plain))
    return F.rtrim(F.substring(plain, 1, MAX_NAME), F.lit("_"))


def header_changes(headers: DataFrame, column: str = "original") -> DataFrame:
    """The dry run: every header whose warehouse name differs, next to that name."""
    renamed = headers.withColumn("normalizado", normalize_header_of(F.col(column)))
    return renamed.filter(F.col("normalizado") != F.col(column))

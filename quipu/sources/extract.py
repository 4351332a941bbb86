"""Extraction of listed tables from all country databases."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.functions.country import COUNTRIES
from quipu.operators.consolidate import consolidate
from quipu.operators.control import control_run
from quipu.operators.ean import with_ean
from quipu.operators.runlog import extract_records
from quipu.sources.erp import BASE_TABLES, ROLLING_DAYS, rolling_scan

# The table of sales lines and the one that holds barcodes.
SALES_LINES = "movGC_VtDocumentoVtaDet"
EQUIVALENCE = "maeGC_ProductoEquiv"
EAN_COLUMNS = ("cProducto", "cProductoEquiv", "cEquivalencia", "cPais")

Read = Callable[[str, str], DataFrame | None]


@dataclass
class Extraction:
    """The tables read, and what was tried: (country, table, columns or ``None`` where absent)."""

    tables: dict[str, DataFrame | None] = field(default_factory=dict)
    attempts: list[tuple[str, str, int | None]] = field(default_factory=list)
    counted: dict[str, DataFrame | None] = field(default_factory=dict)

    def records(self) -> DataFrame:
        """Rows are counted before barcodes are looked up, which neither adds nor drops any."""
        return extract_records(self.counted, self.attempts)


def extract(
    read: Read,
    as_of: date,
    tables: Iterable[str] = BASE_TABLES,
    countries: Iterable[str] = COUNTRIES,
    days: int = ROLLING_DAYS,
    date_columns: Mapping[str, str] | None = None,
) -> Extraction:
    """Each table with all countries stacked, over the rolling window where it has a date column.

    ``read`` gives a country's table, or ``None`` where the country has none; countries may differ
    in columns. Sales lines get their barcode. Nothing is read before a result is used: the loop
    only builds plans.
    """
    declared = {t.lower(): c for t, c in (date_columns or {}).items()}
    countries = list(countries)

    def window(country: str, table: str) -> DataFrame | None:
        df = read(country, table)
        return None if df is None else rolling_scan(df, as_of, days, declared.get(table.lower()))

    out = Extraction()
    for table in tables:
        frames = {c: window(c, table) for c in countries}
        found = {c: df for c, df in frames.items() if df is not None}
        stacked = consolidate(found) if found else None
        enriched = 0
        out.counted[table] = stacked
        if stacked is not None and table.lower() == SALES_LINES.lower():
            pairs = {c: read(c, EQUIVALENCE) for c in countries}
            pairs = {c: p.select(*EAN_COLUMNS) for c, p in pairs.items() if p is not None}
            if pairs:
                equiv = consolidate(pairs)  # each row looks only into its own company's table
                stacked, enriched = with_ean(stacked, equiv, "cProductoVta"), 1
        out.tables[table] = stacked
        for country, df in frames.items():
            out.attempts.append((country, table, None if df is None else len(df.columns) + enriched))
    return out


def controlled(
    out: Extraction,
    root: str,
    at: datetime,
    as_of: date | None = None,
    days: int = ROLLING_DAYS,
    keys: Mapping[str, Iterable[str]] | None = None,
    date_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Store every extracted table, compare it with the extraction before, and return the run's records.

    (pais, tabla, registros, columnas, estado, archivo, hash_sha256, version, control): the last four are null where a
    country has no rows of a table or no such table. ``as_of`` is that of a rolling extraction, whose
    oldest months leave without being a modification.
    """
    declared = {t.lower(): c for t, c in (date_columns or {}).items()}
    since = as_of - timedelta(days=days) if as_of else None
    runs = []
    for table, df in out.tables.items():  # a table is a job of its own, as its months are compared on their own
        if df is not None:
            mine = list((keys or {}).get(table, ())) or None
            runs.append(control_run(df.sparkSession, df, root, table, at, mine, declared.get(table.lower()), since))
    control = reduce(DataFrame.unionAll, runs).select(
        "pais", "tabla", "archivo", "hash_sha256", "version", F.col("estado").alias("control")
    )
    return out.records().join(control, ["pais", "tabla"], "left")

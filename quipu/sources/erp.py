"""The ERP tables of all countries as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.text import col

# The ERP tables a full extraction covers.
BASE_TABLES = (
    "movGC_DocumentoxDistribucion",
    "movGC_VtDocumentoVtaCab",
    "movGC_VtDocumentoVtaDet",
    "maeGC_ProductoEquiv",
    "maeGC_cfEstado",
    "maeGC_cfTipoDocumento",
    "RM00101",
    "RM00201",
    "maeGC_cfConcepto",
    "maeGC_Producto",
    "maeGC_Marca",
)

#: Blank-padded text columns that tables are joined on, in upper case.
KEY_COLUMNS = frozenset(
    {"CUSTNMBR", "ITEMNMBR", "SOPNUMBE", "CSERIE", "CCLIENTE", "CPRODUCTO", "CPRODUCTOVTA"}
)

#: 36 months of 30 days, the window of a rolling extraction.
ROLLING_DAYS = 36 * 30

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


class Erp(Mapping):
    """Named ERP tables; a table may hold one country or, with a ``PAIS`` column, all of them.

    Names ignore case. The SQL server compares codes without their trailing blanks, Spark does
    not, so the join columns are trimmed here, once, in the scan.
    """

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = {name.upper(): df for name, df in frames.items()}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, tables=BASE_TABLES) -> Erp:
        return cls({t: spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in tables})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Erp:
        names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]  # views of the session are in no database
        return cls({n: spark.table(f"{database}.{n}") for n in names})

    def __getitem__(self, name: str) -> DataFrame:
        df = self._frames[name.upper()]
        return df.select(
            *[F.rtrim(col(c)).alias(c) if c.upper() in KEY_COLUMNS else col(c) for c in df.columns]
        )

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and name.upper() in self._frames

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


def bound(df: DataFrame, column: str, value: str | date | datetime) -> Column:
    """A date bound as a literal of the column's own type, so that the filter reaches the scan."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def in_period(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; on a timestamp, ``end`` means its midnight."""
    return df.filter(F.col(column).between(bound(df, column, start), bound(df, column, end)))


def date_column(df: DataFrame, declared: str | None = None) -> str | None:
    """The column a rolling extraction filters on: the declared one, else the first date column."""
    if declared is not None:
        return declared
    return next((f.name for f in df.schema if isinstance(f.dataType, DATE_TYPES)), None)


def full_scan(erp: Erp, table: str) -> DataFrame:
    return erp[table]


def rolling_scan(
    df: DataFrame, as_of: date, days: int = ROLLING_DAYS, declared: str | None = None
) -> DataFrame:
    """The last ``days`` days of a table, or all of it when it has no date column.

    Rows without a date are left out.
    """
    column = date_column(df, declared)
    if column is None:
        return df
    first = as_of - timedelta(days=days)
    return df.filter(F.col(column) >= bound(df, column, first))

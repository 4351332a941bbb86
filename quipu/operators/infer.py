"""Types of text columns, inferred from every cell by states that merge.

Each cell has a rung, the narrowest type it fits. A column's state is how many cells stand on each rung and how wide they
are. All of it is counts and maxima, so one aggregation over all columns of a table gives the states in one scan,
each task sends one line, and states of files, days or countries merge into those of the whole without reading a
cell again. A column's type is the narrowest that holds all its rungs:

* booleans alone; whole numbers alone; numbers, as decimals as wide as the widest cells; numbers some of which have an
  exponent, as doubles; dates alone; dates and times, as timestamps;
* text where that fails, where a decimal would need more than 38 digits, and where there are no cells at all.

Codes stay text whatever they look like, by their name or by a leading zero, which a number would lose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.names import warehouse_type
from quipu.functions.text import col, string_columns
from quipu.sources.landing import CODE_NAMES, CODE_PREFIXES

#: The rungs with the patterns of their whole cells, each without those before; dates and times must exist as well.
RUNGS = {
    "logicos": r"^(?i:true|false)\z",
    "enteros": r"^[+-]?(0|[1-9][0-9]{0,17})\z",
    "decimales": r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?\z",
    "reales": r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\z",
    "fechas": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "horas": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z",
}
EXISTING = {"fechas": "date", "horas": "timestamp_ntz"}
#: What every cell on a rung starts with; most text is told by that alone.
STARTS = "^[0-9.+tTfF-]"
#: Digits a decimal can have.
DIGITS = 38

COUNTS = ("celdas", *RUNGS)
WIDTHS = ("cifras", "escala", "longitud")


def rung(cell: Column) -> Column:
    """The number of a cell's rung; null for text that stands on none."""
    out = F.when(~cell.rlike(STARTS), F.lit(None).cast("int"))
    for i, (name, pattern) in enumerate(RUNGS.items()):
        test = cell.rlike(pattern)
        if name in EXISTING:
            test = test & cell.try_cast(EXISTING[name]).isNotNull()
        out = out.when(test, F.lit(i))
    return out


def cell_states(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per text column (and group ``by``): its state, from one scan and one partial aggregation."""
    names = [n for n in columns or string_columns(df) if n not in by]
    if not names:
        raise ValueError("no text columns")
    keys = [col(b) for b in by]
    cells = [F.struct(col(n).alias("x"), rung(col(n)).alias("r")).alias(f"c{i}") for i, n in enumerate(names)]
    wide = df.select(*keys, *cells).groupBy(*keys).agg(*[_state(f"c{i}").alias(f"s{i}") for i in range(len(names))])
    state = [F.col(f"s{i}").withField("posicion", F.lit(i)).withField("columna", F.lit(n)) for i, n in enumerate(names)]
    return wide.select(*keys, F.inline(F.array(*state)))


def _state(name: str) -> Column:
    cell, on = F.col(f"{name}.x"), F.col(f"{name}.r")
    number = on.between(1, 2)
    whole, part = (F.length(F.regexp_extract(cell, p, 1)) for p in ("^[+-]?([0-9]*)", r"\.([0-9]+)$"))
    return F.struct(
        F.count(cell).alias("celdas"),
        *[F.count_if(on == i).alias(r) for i, r in enumerate(RUNGS)],
        F.coalesce(F.max(F.when(number, whole)), F.lit(0)).alias("cifras"),
        F.coalesce(F.max(F.when(number, part)), F.lit(0)).alias("escala"),
        F.coalesce(F.max(F.length(cell)), F.lit(0)).alias("longitud"),
    )


def merged(states: DataFrame) -> DataFrame:
    """States of parts as those of the whole."""
    return states.groupBy("columna").agg(
        F.min("posicion").alias("posicion"),
        *[F.sum(c).alias(c) for c in COUNTS],
        *[F.max(c).alias(c) for c in WIDTHS],
    )


def _type() -> Column:
    cells, digits = F.col("celdas"), F.col("cifras") + F.col("escala")
    code = F.upper("columna").isin(*CODE_NAMES) | F.upper("columna").rlike(f"^({'|'.join(CODE_PREFIXES)})")
    all_on = lambda *rungs: sum((F.col(r) for r in rungs), F.lit(0)) == cells
    number = F.format_string("decimal(%d,%d)", F.greatest(digits, F.lit(1)), F.col("escala"))
    return (
        F.when((cells == 0) | code, "string")
        .when(all_on("logicos"), "boolean")
        .when(all_on("enteros"), "bigint")
        .when(all_on("enteros", "decimales"), F.when(digits <= DIGITS, number).otherwise("string"))
        .when(all_on("enteros", "decimales", "reales"), "double")
        .when(all_on("fechas"), "date")
        .when(all_on("fechas", "horas"), "timestamp_ntz")
        .otherwise("string")
    )


def types_of(states: DataFrame) -> DataFrame:
    """(posicion, columna, tipo, celdas, longitud) by state."""
    return states.select("posicion", "columna", _type().alias("tipo"), "celdas", "longitud")


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The narrowest type of each text column, with the number of its cells and the longest of them."""
    return types_of(cell_states(df, columns))


def inferred(states: DataFrame) -> dict[str, str]:
    """Types by column, those of text left out; one row per column reaches the driver."""
    return {r.columna: r.tipo for r in types_of(states).collect() if r.tipo != "string"}


def load_typed(df: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """``df`` with its text columns in the inferred types; every cell fits, so no cast loses one.

    With ``states`` of an earlier scan of the same rows, or of all their parts, the cells are not read for it again.
    """
    types = inferred(merged(states) if states is not None else cell_states(df))
    return df.select(*[col(n).cast(types[n]).alias(n) if n in types else col(n) for n in df.columns])


def warehouse_schema(df: DataFrame) -> DataFrame:
    """(posicion, columna, tipo): the column types a warehouse table gets for a typed table."""
    rows = [(i, f.name, warehouse_type(f.dataType)) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "posicion int, columna string, tipo string")

"""Barcode (EAN) enrichment of sales rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.country import DEFAULT_CODE, country_code_of
from quipu.functions.text import col, equals_padded, non_empty
from quipu.operators.joins import COUNTRY

# Names a product-code column may have, in order of preference.
PRODUCT_COLUMNS = (
    "Código de producto",
    "CodigoProducto",
    "cProducto",
    "cProductoVta",
    "ITEMNMBR",
    "Codigo Producto",
    "Codigo de producto",
)

# Fixed value: the equivalence kind that holds barcodes.
EAN_KIND = "EAN12"


def ean_pairs(equiv: DataFrame, strip=F.trim) -> DataFrame:
    """All (country code, product, barcode) rows of the equivalence table, trimmed.

    Companies keep such a table each; where several are stacked, ``PAIS`` says whose a row is.
    """
    return equiv.filter(equals_padded(F.col("cEquivalencia"), EAN_KIND)).select(
        *owner(equiv),
        F.rtrim("cPais").alias("_code"),
        strip("cProducto").alias("_product"),
        F.rtrim("cProductoEquiv").alias("EAN"),
    )


def owner(equiv: DataFrame) -> list[str]:
    return [COUNTRY] if COUNTRY in equiv.columns else []


def ean_lookup(
    equiv: DataFrame, fanout: bool = False, distinct: bool = True, strip=F.trim
) -> DataFrame:
    """The barcode lookup: one (the smallest) per product, or every one with ``fanout``."""
    pairs = ean_pairs(equiv, strip)
    if fanout:
        return pairs.distinct() if distinct else pairs
    return pairs.groupBy(*owner(pairs), "_code", "_product").agg(F.min("EAN").alias("EAN"))


def product_column(df: DataFrame) -> str | None:
    return next((n for n in PRODUCT_COLUMNS if n in df.columns), None)


def _country(df: DataFrame, country: str | None) -> Column:
    if country is None and COUNTRY in df.columns:
        return country_code_of(F.col(COUNTRY))
    return country_code_of(F.lit(country)) if country else F.lit(DEFAULT_CODE)


def _key(code: Column, product: Column, company: Column | None = None) -> Column:
    """Country code and product, led by the company, as one join key, null where one of them is.

    The lookup is grouped by the two columns apart. Were they also the join key, Spark would reuse
    that grouping and could no longer divide the partition of a product that fills a third of all
    lines; with a key of its own, both sides of the join are shuffled for it and AQE may split them.
    """
    parts = [code, product] if company is None else [company, F.lit("|"), code, product]
    return F.concat(*parts[:-1], F.lit("|"), parts[-1]).alias("_key")


def with_ean(
    df: DataFrame,
    equiv: DataFrame,
    product: str | None = None,
    country: str | None = None,
    fanout: bool = False,
    distinct: bool = True,
    strip=F.trim,
) -> DataFrame:
    """Add ``EAN`` to any rows that name a product; no match or no product column gives ``''``.

    Each row looks its barcode up in its own country, taken from ``PAIS`` unless ``country`` names
    one; where the table of barcodes holds several companies, only in the row's own company's. A
    product with several barcodes gets the smallest; with ``fanout`` its rows repeat, one
    per barcode. Rows without a product code never match. ``strip`` says which blanks around product
    codes do not count.
    """
    product = product or product_column(df)
    if product is None:
        return df.withColumn("EAN", F.lit(""))
    if owner(equiv) and country is not None:
        equiv = equiv.filter(F.col(COUNTRY) == country).drop(COUNTRY)
    if owner(equiv) and COUNTRY not in df.columns:
        raise ValueError("barcodes of several companies need rows that name theirs")
    company = F.col(COUNTRY) if owner(equiv) else None
    lookup = ean_lookup(equiv, fanout, distinct, strip)
    keep = [c for c in df.columns if c != "EAN"]
    keyed = df.select(
        *[col(c) for c in keep],
        _key(_country(df, country), strip(col(product).cast("string")), company),
    )
    known = lookup.select(_key(F.col("_code"), F.col("_product"), company), "EAN")
    joined = keyed.join(known, "_key", "left")
    return joined.select(*[col(c) for c in keep], F.coalesce("EAN", F.lit("")).alias("EAN"))


def ean_coverage(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How many rows have a barcode, and which share of all rows that is."""
    found = F.count_if(non_empty(F.col("EAN")))
    total = F.count(F.lit(1))
    share = F.when(total > 0, F.round(found * F.lit(100.0) / total, 6)).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(
        total.alias("filas"), found.alias("con_ean"), share.alias("porcentaje")
    )

"""Joins between tables that may or may not carry the country."""

from __future__ import annotations

from pyspark.sql import DataFrame

COUNTRY = "PAIS"


def on_keys(left: DataFrame, right: DataFrame, *keys: str) -> list[str]:
    """The join columns, led by the country when both tables hold several countries.

    Codes are only unique within a country, so leaving the country out would mix companies. A
    table without it on the right is shared by all countries; one that has it only there would
    repeat every row on the left, once a country, and is refused.
    """
    if COUNTRY not in right.columns:
        return list(keys)
    if COUNTRY not in left.columns:
        raise ValueError(f"only one of the tables joined by {', '.join(keys)} holds several countries")
    return [COUNTRY, *keys]


def attach(
    facts: DataFrame, side: DataFrame, keys: list[str], columns: list[str], how: str = "left"
) -> DataFrame:
    """Join ``columns`` of ``side`` to ``facts``.

    No broadcast hint: customers, items and barcodes grow with the business. Spark broadcasts the
    side when its measured size is below the threshold and otherwise shuffles both, splitting the
    partitions of hot keys.
    """
    on = on_keys(facts, side, *keys)
    return facts.join(side.select(*on, *columns), on, how)


def documents(headers: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Header rows joined with their lines; filter the headers by date before calling this."""
    return headers.join(lines, on_keys(headers, lines, *keys), "inner")

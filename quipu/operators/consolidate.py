"""Stacking the results of several countries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.operators.joins import COUNTRY


def consolidate(by_country: Mapping[str, DataFrame]) -> DataFrame:
    """All countries' rows by column name; absent columns become null, ``PAIS`` names the country."""
    tagged = [df.withColumn(COUNTRY, F.lit(name)) for name, df in by_country.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def country_stats(by_country: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per country and the number of columns its own table has, next to the country's name."""
    sizes = {name: len([c for c in df.columns if c != COUNTRY]) for name, df in by_country.items()}
    columns = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    rows = consolidate(by_country).groupBy(COUNTRY).agg(F.count(F.lit(1)).alias("registros"))
    return rows.withColumn("columnas", columns[F.col(COUNTRY)])

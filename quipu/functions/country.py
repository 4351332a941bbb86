"""The four countries and their two-letter codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country databases and the code each uses in the product-equivalence table.
COUNTRY_CODES = {"CHILE": "CL", "COLOMBIA": "CO", "ECUADOR": "EC", "PERU": "PE"}
COUNTRIES = tuple(COUNTRY_CODES)
DEFAULT_CODE = "CL"


def country_code(name: str | None) -> str:
    return COUNTRY_CODES.get(name or "", DEFAULT_CODE)


def country_code_of(country: Column) -> Column:
    """The code for a country column; an unknown or missing country counts as Chile."""
    return reduce(
        lambda chain, item: chain.when(country == item[0], F.lit(item[1])),
        list(COUNTRY_CODES.items())[1:],
        F.when(country == "CHILE", F.lit("CL")),
    ).otherwise(F.lit(DEFAULT_CODE))

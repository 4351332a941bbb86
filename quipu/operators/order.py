"""Ordering of report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arrange(
    df: DataFrame, keys: Sequence[str | Column], columns: Sequence[Column], ordered: bool = True
) -> DataFrame:
    """Sort by ``keys``, which need not be shown, and project ``columns``.

    A digest of the row breaks ties: the order becomes repeatable, and rows that share a sort key
    (one day, one document) spread over several range partitions instead of filling one. Columns
    that are neither shown nor sorted by do not travel. ``ordered=False`` is for callers that
    aggregate or join the rows again.
    """
    if not ordered:
        return df.select(*columns)
    tied = df.withColumn("_tie", F.xxhash64(*columns))
    return tied.orderBy(*keys, "_tie").select(*columns)

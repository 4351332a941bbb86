"""Benchmark decontamination: size-partitioned MinHash containment search, exactly verified.

A short test item inside a long document has a small Jaccard similarity to it, so one threshold for all
documents would miss it. Documents are partitioned by the number of their shingles (powers of two),
and a partition's signature grows with that size: the token space is cut into 2^b bins, the smallest
shingle hash of a bin is its value (one-permutation MinHash), and b is the partition's exponent plus the
extra bits that make an item of the smallest size that is contained to the threshold agree in at least one bin
but for a chance of ``miss``. An item has a signature for every partition. Items and documents that agree
in a bin are candidates; these are verified by counting the item's shingles in the whole document.

Only DataFrame functions run here. Signatures are made within a row, without a shuffle; items
are broadcast only where their signatures were counted to be at most ``MOST`` and joined by a shuffle beyond.

Words are runs of other characters than space and 0x09-0x0D, in lower case; an item or document with fewer words
than a shingle has its whole sequence as one. Null and empty texts contain nothing and are in nothing.
Documents are searched as texts: copies are found once and each row is returned. Rows without an id appear in
pairs with a null id. Empty tables give no pairs. Other columns are ignored by ``search`` and kept by ``clean``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import small, staged

#: Signature rows of all items that may be broadcast (12 bytes each and overhead: some 100 MB).
MOST = 2_000_000
#: Partitions: documents of up to 2^40 shingles.
PARTITIONS = range(41)


def _words(text: str) -> Column:
    blank = r"[\x20\x09-\x0D]+"
    return F.split(F.btrim(F.lower(F.col(text)), F.lit(" \t\n\x0b\f\r")), blank)


def once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """Adds a column that is computed once a row.

    A plain projection would be merged into the next one, and a function applied to every element there
    would compute the whole array anew for each; a generator of one row is left where it stands.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def shingled(df: DataFrame, text: str, k: int, *keep: str) -> DataFrame:
    """Adds ``shingles``, the sorted distinct hashes of runs of ``k`` words; rows without words go."""
    hashed = once(df.where(F.col(text).isNotNull()), F.transform(_words(text), lambda x: F.xxhash64(x)), "w", *keep)
    empty = F.xxhash64(F.lit(""))
    hashed = hashed.where((F.size("w") > 1) | (F.col("w")[0] != empty))
    run = F.transform(
        F.sequence(F.lit(1), F.size("w") - (k - 1)),
        lambda i: F.xxhash64(*[F.element_at("w", (i + j).cast("int")) for j in range(k)]),
    )
    runs = F.when(F.size("w") >= k, run).otherwise(F.array(F.xxhash64(F.lit(k), "w")))
    return once(hashed, F.sort_array(F.array_distinct(runs)), "shingles", *keep)


def _exponent(size: Column) -> Column:
    """The partition of a set size: the smallest e with size <= 2^e, exactly."""
    return F.length(F.bin(size.cast("long") - 1)).cast("int") - F.when(size == 1, 1).otherwise(0)


def _minima(bits: Column) -> Column:
    """The smallest of the sorted ``shingles`` in each of 2^bits bins."""
    shift = F.greatest(F.lit(0), F.lit(64) - bits).cast("int")

    def bin_of(x: Column) -> Column:
        return F.call_function("shiftright", x, shift)

    return F.filter(
        F.col("shingles"),
        lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.element_at("shingles", F.greatest(i, F.lit(1))))),
    )


def extra_bits(smallest: int, percent: int, miss: float) -> int:
    """Bits beyond a partition's exponent, so that a contained item of this size is found."""
    shared = max(1, math.ceil(smallest * percent / 100))
    for extra in range(24):
        load = 2.0**-extra  # shingles a bin, at most
        if (1 - (1 - math.exp(-load)) / load) ** shared <= miss:
            return extra
    return 24


def search(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """(doc_id, text_key, item_id, shared, item_size) where at least ``percent`` of an item is contained."""
    tests = staged(shingled(items.select("item_id", "text"), "text", k, "item_id"), "items")
    tests = tests.withColumn("item_size", F.size("shingles"))
    least, rows = tests.agg(F.min("item_size"), F.sum("item_size")).first()
    extra = extra_bits(least or 1, percent, miss)

    wide = tests.withColumn("part", F.explode(F.array(*[F.lit(p) for p in PARTITIONS])))
    signed = wide.select("item_id", "part", F.explode(_minima(F.col("part") + extra)).alias("x"))
    signed = signed.select("item_id", F.col("x").bitwiseXOR(F.col("part").cast("long")).alias("key"))
    if (rows or 0) * len(PARTITIONS) <= MOST:
        signed = F.broadcast(signed)
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text")
    sets = shingled(texts, "text", k, "text_key").withColumn("part", _exponent(F.size("shingles")))
    keys = sets.select("text_key", "part", F.explode(_minima(F.col("part") + extra)).alias("x"))
    keys = keys.select("text_key", F.col("x").bitwiseXOR(F.col("part").cast("long")).alias("key"))
    near = staged(keys.join(signed, "key").select("text_key", "item_id").distinct(), "near")

    again = texts.join(near.select("text_key").distinct(), "text_key", "left_semi")
    whole = shingled(again, "text", k, "text_key").select("text_key", F.explode("shingles").alias("x"))
    parts = tests.select("item_id", "item_size", F.explode("shingles").alias("x"))
    if (rows or 0) <= MOST:
        parts = F.broadcast(parts)
    # a text that several rows have is counted once: the number of a shingle's rows does not matter
    counted = (
        whole.join(parts, "x")
        .join(near, ["text_key", "item_id"], "left_semi")
        .groupBy("text_key", "item_id", "item_size")
        .agg(F.count_distinct("x").alias("shared"))
        .where(F.col("shared") * 100 >= F.col("item_size") * percent)
    )
    found = staged(counted, "contained")
    named = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_key"))
    return named.join(found, "text_key").select("doc_id", "text_key", "item_id", "shared", F.col("item_size").cast("long"))


def clean(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that contain no item; columns as before."""
    bad = small(staged(search(docs, items, k, percent).select(F.col("text_key").alias("__leak")).distinct(), "leaks"))
    return docs.join(bad, F.xxhash64(docs["text"]) == F.col("__leak"), "left_anti")

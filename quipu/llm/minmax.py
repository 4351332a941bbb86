"""Near-duplicate groups by min-max hashing.

Documents are sets of hashed word shingles. Each permutation of the hashes gives a set two signature values, its
minimum and its maximum, so half the hash evaluations give a signature; equal minima and equal maxima each have the
similarity as their chance, and since one permutation's two ends lie far apart they vary together less than two
minima of independent permutations would, so that the share of equal values is an unbiased estimate of lower variance.
Bands of ``ROWS`` values, minima and maxima in turn, are the buckets. With 32 bands of six a pair of
similarity 0.85 shares none with a chance of 3e-7. Every pair that counts is confirmed on its full sets.

How it is kept in bounds:

* Equal sets are one node from the start, however many copies there are.
* Pairs within a bucket are not written out. First every node is held against one hub, the heaviest member of all its
  buckets, which meets the most others (the original of a group of near copies); what links is contracted
  to components. A bucket with one component is done.
* Members of the other buckets, in a group of near copies mostly those edited too much for their original, are alike
  in what all of the group have. A pair across components must share a token among the rarest of both, early enough
  in their order for the rest of both sets to suffice; only such pairs are tested, all of them.
* Shingle sets are computed again for the nodes that share a bucket only.

Null and empty texts, and texts of blanks alone, have no set and link with nothing. Texts with fewer words than a
shingle are one token, their whole sequence. Rows without an id take part by their text and get the component of
the others. Repeated rows each get their row. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import components, small, staged
from quipu.llm.jaccard import set_key, shingle_sets
from quipu.llm.words import mix, seeds

BANDS, ROWS = 32, 6
#: Tokens whose permutations are worked out at once.
HELD = 65_536
_ODD, _SHIFT = seeds(BANDS * ROWS // 2, 31), mix(seeds(BANDS * ROWS // 2, 47))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Of each non-empty set, its minimum and maximum under each permutation, in turn."""
    out = np.empty((len(sets), 2 * len(_ODD)), np.uint64)
    tokens, starts = np.concatenate(sets), np.cumsum([0, *(len(x) for x in sets[:-1])])
    for i, (odd, shift) in enumerate(zip(_ODD, _SHIFT)):
        turned = (tokens ^ shift) * odd
        out[:, 2 * i] = np.minimum.reduceat(turned, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(turned, starts)
    return out


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """One hash per band of each non-empty set."""
    rows = signatures(sets).reshape(len(sets), BANDS, ROWS)
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(sets), axis=0)
    for j in range(ROWS):
        key = mix(key ^ rows[:, :, j]) + rows[:, :, j]
    return mix(key)


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_key, n, node, bands) of every row; bands are null where the task has given them for the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, nodes, found = [], [], [None] * batch.num_rows
            open_: list[tuple[int, np.ndarray]] = []

            def fill() -> None:
                if open_:
                    for (i, _), row in zip(open_, bands([x for _, x in open_])):
                        found[i] = row.view(np.int64)
                    open_.clear()

            held = 0
            for i, tokens in enumerate(shingle_sets(batch.column(2), k)):
                node = set_key(tokens)
                sizes.append(len(tokens))
                nodes.append(node)
                if len(tokens) and node not in seen:
                    open_.append((i, tokens))
                    held += len(tokens)
                if len(seen) < 200_000:
                    seen.add(node)
                if held > HELD:
                    fill()
                    held = 0
            fill()
            kinds = (pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *kinds], ["doc_id", "text_key", "n", "node", "bands"])

    schema = "doc_id long, text_key long, n long, node long, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the wanted nodes, from one text each."""
    chosen = rows.where("n > 0").groupBy("node").agg(F.min("text_key").alias("__key")).join(wanted, "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held, nodes, found = 0, [], []
            for tokens in shingle_sets(batch.column(0), k):
                node = set_key(tokens)
                if node in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(node)
                nodes.append(node)
                found.append(tokens.view(np.int64))
                held += len(tokens)
                if held > 500_000:
                    yield _given(nodes, found)
                    held, nodes, found = 0, [], []
            yield _given(nodes, found)

    texts = docs.select("text").join(small(chosen.select("__key")), F.xxhash64("text") == F.col("__key"), "left_semi")
    return texts.mapInArrow(run, "node long, tokens array<long>").dropDuplicates(["node"])


def _given(nodes: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["node", "tokens"])


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    x, y = (sets.select(F.col("node").alias(c), F.col("tokens").alias(f"{c}_tokens")) for c in "xy")
    both = pairs.join(x, "x").join(y, "y")
    n, m = F.size("x_tokens"), F.size("y_tokens")
    both = both.where(F.least(n, m) * 100 >= F.greatest(n, m) * percent)
    common = F.size(F.array_intersect("x_tokens", "y_tokens"))
    return both.where(common * (100 + percent) >= (n + m) * percent).select("x", "y")


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("x"), F.greatest(a, b).alias("y")]


def _rarest(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, root, pos): the tokens of which two linking nodes must share one, with their places.

    Tokens are ordered by the number of these nodes that have them. Those of one node alone come first and can be
    shared by none, so they only count.
    """
    own = sets.join(nodes, "node").select("node", "n", "root", F.explode("tokens").alias("token"))
    often = own.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    own = own.join(often, "token")
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "token"))
    placed = own.select("token", "node", "n", "root", (alone + place - 1).alias("pos"))
    return placed.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9))


def _across(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a token early enough for the rest to suffice."""
    index = staged(_rarest(left.select("node", "n", "root").distinct(), sets, percent), "rarest")
    a, b = (index.select("token", *[F.col(c).alias(f"{s}{c}") for c in ("node", "n", "root", "pos")]) for s in "ab")
    n, m = F.col("an"), F.col("bn")
    need = F.ceil((n + m) * percent / (100.0 + percent) - 1e-9)
    near = (F.col("aroot") < F.col("broot")) & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
    near = near & (F.col("apos") <= n - need) & (F.col("bpos") <= m - need)
    return a.join(b, "token").where(near).select(*_pair("anode", "bnode")).distinct()


def linked(index: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the nodes that link: ``index`` has (bucket, node, n, weight) of buckets of several nodes."""
    hubs = index.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    meets = index.select("bucket", "node", "n").join(hubs, "bucket").where(F.col("node") != F.col("hub.node"))
    one = meets.groupBy("node", "n").agg(F.max("hub").alias("hub")).select("node", "n", F.col("hub.node").alias("other"), F.col("hub.n").alias("m"))
    one = one.where(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    pairs = staged(one.select(*_pair("node", "other")).distinct(), "pairs")
    found = staged(_links(pairs, sets, percent), "links")
    roots = components(found)
    named = index.select("bucket", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    left = staged(named.join(mixed.select("bucket"), "bucket", "left_semi"), "open")
    if left.isEmpty():
        return roots
    more = staged(_links(staged(_across(left, sets, percent), "pairs"), sets, percent), "links")
    return roots if more.isEmpty() else components(found.union(more))


def grouped(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; links at ``percent`` or more."""
    rows = staged(sketched(docs, k), "minmax")
    each = rows.where("bands is not null").groupBy("node").agg(F.first("bands").alias("bands"), F.first("n").alias("n"))
    index = staged(each.select("node", "n", F.explode("bands").alias("bucket")), "bands")
    many = index.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    index = index.join(many, "bucket")
    weight = index.groupBy("node").agg(F.sum("members").alias("weight"))
    index = staged(index.drop("members").join(weight, "node"), "buckets")
    sets = staged(_sets(docs, rows, index.select("node").distinct(), k), "sets")
    roots = linked(index, sets, percent)
    low = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    low = low.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    named = low.join(least, "root").select("node", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = rows.select("doc_id", "n", "node").join(named, "node", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

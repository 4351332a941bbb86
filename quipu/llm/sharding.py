"""Sharding by Karmarkar-Karp differencing: near-equal bytes over shards, equal texts together.

Rows of one text are an indivisible group. A partial partition is a vector of shard sums; differencing takes
the two with the largest spread (largest minus smallest sum) and adds them in opposite order, until one
is left. Groups are dealt by hash to a number of parts that follows their count; each part is differenced
in a task of its own, and the parts' results, one vector of shard sums each, are differenced once more.
Any subset's result is a partial partition itself, so this is the same method in another legal order; the
driver holds (parts x shards) numbers, a part for every 200,000 groups.

A row's size is its text's UTF-8 bytes plus 16; a null text has none and forms a group apart from the empty
text. Rows without an id are placed too; equal rows are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import buckets_for, positions, staged

ROW_BYTES = 16


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences partial partitions: the final sums, and for each input the final shard of each of its slots.

    ``vectors`` has a row of shard sums for every partial partition. Which slot of an input ends in
    which slot of the result is kept as a tree of permutations and read off from the root.
    """
    n, shards = vectors.shape
    if n == 0:
        return np.zeros(shards, np.int64), np.zeros((0, shards), np.int64)
    sums: list[np.ndarray | None] = list(np.sort(vectors, axis=1)[:, ::-1])
    first = np.argsort(-vectors, axis=1, kind="stable")
    heap = [(int(v[-1] - v[0]), i) for i, v in enumerate(sums)]
    heapq.heapify(heap)
    nodes: list[tuple[int, int, np.ndarray]] = []  # two children, and the order of their sum
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        sums[a] = sums[b] = None
        nodes.append((a, b, order.astype(np.int16)))
        sums.append(both[order])
        heapq.heappush(heap, (int(both[order[-1]] - both[order[0]]), len(sums) - 1))
    final = np.empty((n, shards), np.int64)
    ends: dict[int, np.ndarray] = {len(sums) - 1: np.arange(shards)}
    for at in range(len(nodes) - 1, -1, -1):
        end = ends.pop(n + at)
        a, b, order = nodes[at]
        slot = np.empty(shards, np.int64)  # the shard in which each place of the unsorted sum ends
        slot[order] = end
        ends[a], ends[b] = slot, slot[::-1]
    for i, end in ends.items():
        final[i, first[i]] = end
    return sums[-1], final


def _part(shards: int):
    def run(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["bytes", "key"], ascending=False)
        vectors = np.zeros((len(groups), shards), np.int64)
        vectors[:, 0] = groups["bytes"]
        _, final = difference(vectors)
        return pd.DataFrame(
            {"part": groups["part"], "key": groups["key"], "local": final[:, 0].astype(np.int32), "bytes": groups["bytes"]}
        )

    return run


def by_bytes(docs: DataFrame, shards: int = 40, per_part: int = 200_000) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    crc = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.crc32(F.col("text").cast("binary")))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        crc.cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("key"),
    )
    rows = staged(rows, "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    parts = max(1, -(-groups.count() // per_part))
    dealt = groups.select(F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"), "key", "bytes")
    schema = "part int, key binary, local int, bytes long"
    local = staged(dealt.groupBy("part").applyInPandas(_part(shards), schema), "parts")
    found = local.groupBy("part", "local").agg(F.sum("bytes").alias("bytes")).collect()  # parts x shards
    vectors = np.zeros((parts, shards), np.int64)
    for r in found:
        vectors[r["part"], r["local"]] = r["bytes"]
    _, final = difference(vectors)
    table = [(p, s, int(final[p, s])) for p in range(parts) for s in range(shards)]
    names = docs.sparkSession.createDataFrame(table, "part int, local int, shard int")
    placed = local.join(names, ["part", "local"]).select("key", "shard")
    sharded = rows.join(placed, "key").drop("key")
    ordered = ["doc_id", "text_crc32", "size"]
    return positions(sharded, ["shard"], ordered, "slot", buckets_for(rows.count()))

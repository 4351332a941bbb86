"""Best-fit packing of tokenised documents into training sequences.

Vector best fit: a bin has residual tokens, documents and attention cost (the sum of squared piece
lengths); a piece goes to the open bin with the best score among those that hold it under all three,
and opens a bin where none does. Pieces come in decreasing length. The score is the weighted norm of
what would stay free, or the weighted dot product of demand and residual.

All three demands follow from a piece's length, so pieces of one length are interchangeable, and so are
bins of one residual. The decisions are therefore taken for whole classes at once: the driver sees
only the number of pieces of each length (at most ``max_tokens`` numbers, whatever the corpus) and
the steps it returns say which ranks of a length go into which run of bins. The packing is that of
one sequential best fit over the whole corpus, does not depend on the partitioning, and leaves
no partly filled bin per task. The number of steps is bounded by lengths and residuals too.

Empty and null texts are one piece with the closing id alone. An empty table gives no rows. Rows that
repeat are packed as often as they come. Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import buckets_for, positions, staged
from quipu.llm.tokens import encoded

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
END_ID = 0


@dataclass(frozen=True)
class Capacity:
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"  # or "dot"


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``most``."""
    first = total % most or min(total, most)
    return [(0, first)] + [(s, most) for s in range(first, total, most)]


def pieces(docs: DataFrame, vocabulary: str, most: int) -> DataFrame:
    """A row per piece of at most ``most`` ids; each document ends with id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoded(vocabulary, batch.column(1))):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), most)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc, k, start, length, crc))
            if out:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


class _Bins:
    """Open bins by residual: arrays of states with counts, and each state's runs of bin numbers."""

    def __init__(self) -> None:
        self.at: dict[tuple[int, int, int], int] = {}
        self.state = np.zeros((1024, 3), np.int64)
        self.live = np.zeros(1024, bool)
        self.runs: list[list[list[int]]] = [[] for _ in range(1024)]
        self.free = list(range(1023, -1, -1))

    def add(self, state: tuple[int, int, int], start: int, n: int) -> None:
        slot = self.at.get(state)
        if slot is None:
            if not self.free:
                size = len(self.live)
                self.state = np.concatenate([self.state, np.zeros((size, 3), np.int64)])
                self.live = np.concatenate([self.live, np.zeros(size, bool)])
                self.runs += [[] for _ in range(size)]
                self.free = list(range(2 * size - 1, size - 1, -1))
            slot = self.at[state] = self.free.pop()
            self.state[slot], self.live[slot], self.runs[slot] = state, True, []
        self.runs[slot].append([start, n])

    def take(self, slot: int, most: int) -> tuple[int, int]:
        """Up to ``most`` bins of a state, a run of numbers."""
        start, n = run = self.runs[slot][-1]
        if n > most:
            run[0], run[1] = start + most, n - most
            return start, most
        self.runs[slot].pop()
        if not self.runs[slot]:
            self.live[slot] = False
            del self.at[tuple(int(v) for v in self.state[slot])]
            self.free.append(slot)
        return start, n


def plan(counts: dict[int, int], capacity: Capacity) -> np.ndarray:
    """Steps (length, first rank, pieces a bin, bins, first bin, offset) that place all pieces."""
    cap = np.array([capacity.tokens, capacity.documents, capacity.attention], np.int64)
    weight = np.array(capacity.weights) / cap.astype(float) ** 2

    def score(states: np.ndarray, need: np.ndarray) -> np.ndarray:
        if capacity.rule == "dot":
            return -((states * need) * weight).sum(-1)
        return (((states - need).astype(float) ** 2) * weight).sum(-1)

    bins, steps, opened = _Bins(), [], 0
    least = min(counts, default=0)
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of an empty bin")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero(bins.live & (bins.state >= need).all(1))
            slot = fits[score(bins.state[fits], need).argmin()] if len(fits) else -1
            state = bins.state[slot].copy() if slot >= 0 else cap
            each, after = 1, state - need
            while each < left and (after >= need).all() and score(after, need) <= score(state, need):
                each, after = each + 1, after - need
            if slot >= 0:
                start, n = bins.take(int(slot), left // each)
            else:
                start, n = opened, left // each
                opened += n
            steps.append((length, rank, each, n, start, int(cap[0] - state[0])))
            if after[0] >= least and after[1] > 0 and after[2] > 0:
                bins.add(tuple(int(v) for v in after), start, n)
            rank += each * n
            left -= each * n
    return np.array(steps, np.int64).reshape(-1, 6)


def pack(docs: DataFrame, vocabulary: str, capacity: Capacity = Capacity()) -> DataFrame:
    """Each piece of each document with its sequence and its offset in it."""
    cut_up = staged(pieces(docs, vocabulary, capacity.tokens), "pieces")
    rows = cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per length
    steps = plan({r["length"]: r["n"] for r in rows}, capacity)
    order = np.lexsort((steps[:, 1], steps[:, 0]))
    table = docs.sparkSession.sparkContext.broadcast(steps[order])
    total = sum(r["n"] for r in rows)
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = positions(cut_up, ["length"], keys, "rank", buckets_for(total))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = table.value
        known = (steps[:, 0] << 44) + steps[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            step = steps[np.searchsorted(known, (length << 44) + rank, "right") - 1]
            nth = rank - step[:, 1]
            sequence = step[:, 4] + nth // step[:, 2]
            offset = step[:, 5] + nth % step[:, 2] * length
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:5], "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked.select(*columns).mapInArrow(place, PIECES + ", sequence_id long, offset long")

"""Training-order materialisation: token ids as fixed-stride binary shards in a keyed random order.

Documents are tokenised, each closed by id 0, and joined into sequences of ``length`` ids within a read task; the
last one of a task is filled up with 0. Sequences are numbered, and a Feistel network keyed by ``key``
permutes the numbers: it works on the smallest even number of bits that holds them, and a value beyond the last
number is put through again until it falls inside (cycle-walking), so every number gets one slot and no slot
stays free. A shard is a range of slots; sequence s starts at byte (s - first slot) * stride of its file, so a
reader can begin anywhere and go on from there.

Only blocks of compressed ids are shuffled, by shard. A writer puts each sequence at its place in a file of a
temporary name and renames it when the shard is whole: an attempt that is lost or run twice leaves nothing
half-done, and shards that are there already are skipped when a run is repeated. The folder must be mounted on all
executors. Ids take two bytes, or four for vocabularies over 65,536.

Null and empty texts give their closing id alone. Repeated rows are written as often as they come. An empty table
gives no sequences and no files. Columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.llm.common import local_path, small, staged
from quipu.llm.tokens import encoded, vocabulary
from quipu.llm.words import mix

CODEC = ("zstd", 4)
GROUP = 1000  # read tasks whose blocks are numbered by one task
BLOCK_IDS = 8 << 20  # ids held by a task before it sends them on
END_ID = 0
RESULT = "slot long, shard int, byte_offset long, first_doc_id long, ids_crc32 long"


def permuted(numbers: np.ndarray, total: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slot of each number below ``total``: a keyed bijection of [0, total)."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        return (left << np.uint64(half)) | right

    out = once(numbers.astype(np.uint64))
    while len(far := np.flatnonzero(out >= np.uint64(total))):
        out[far] = once(out[far])
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    length: int = 2048
    key: int = 20240229
    #: Sequences in a shard.
    per_shard: int = 8192
    id_bytes: int = 2

    @property
    def stride(self) -> int:
        return self.length * self.id_bytes

    @property
    def kind(self) -> str:
        return f"<u{self.id_bytes}"


def _codec() -> pa.Codec:
    return pa.Codec(*CODEC)


def sequences(docs: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Blocks of consecutive sequences: (part, block, n, docs, ids), ids compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []  # id and number of ids of each held document, in order
        held = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, held
            joined = np.concatenate(ids)
            n = -(-len(joined) // layout.length) if last else len(joined) // layout.length
            if not n:
                return
            whole = np.zeros(n * layout.length, layout.kind)
            used = min(len(joined), len(whole))
            whole[:used] = joined[:used]
            ends = np.cumsum([size for _, size in owners])
            first = np.searchsorted(ends, np.arange(n) * layout.length, "right")
            known = np.array([doc for doc, _ in owners], np.int64)[first]
            raw = _codec().compress(whole.tobytes(), asbytes=True)
            row = [[part], [block], [n], [known.tobytes()], [raw]]
            names = ["part", "block", "n", "docs", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _SEQUENCE)], names)
            block += 1
            ids[:] = [joined[used:]]
            at = int(np.searchsorted(ends, used, "right"))
            rest = owners[at:]
            if rest:
                rest[0] = (rest[0][0], int(ends[at]) - used)
            owners[:] = rest
            held = len(ids[0])

        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), encoded(path, batch.column(1))):
                ids.append(np.append(own, END_ID).astype(layout.kind))
                owners.append((-1 if doc is None else doc, len(own) + 1))
                held += len(own) + 1
                if held >= BLOCK_IDS:
                    yield from flush(False)
        if held:
            yield from flush(True)

    schema = "part int, block int, n long, docs binary, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


_SEQUENCE = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())


def block_starts(blocks: DataFrame) -> DataFrame:
    """(part, block, start): the number of each block's first sequence.

    Groups of read tasks are summed first, so that one task orders the groups and others their blocks.
    """
    sizes = blocks.select(F.floor(F.col("part") / GROUP).alias("group"), "part", "block", "n")
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.groupBy("group").agg(F.sum("n").alias("n"))
    base = base.select("group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("group").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(base, "group").select("part", "block", (F.col("base") + F.col("own")).alias("start"))


def shard_file(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.bin"


def _whole(folder: str, shard: int, size: int) -> bool:
    path = shard_file(folder, shard)
    return os.path.exists(path) and os.path.getsize(path) == size


def materialised(docs: DataFrame, vocabulary_path: str, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Writes the shards and returns (slot, shard, byte_offset, first_doc_id, ids_crc32) of every sequence."""
    folder = local_path(folder)
    if vocabulary(vocabulary_path).n_vocab > 1 << (8 * layout.id_bytes):
        raise ValueError("the vocabulary needs four bytes an id")
    blocks = staged(sequences(docs, vocabulary_path, layout), "sequences")
    total = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    numbered = blocks.join(small(staged(block_starts(blocks), "starts")), ["part", "block"])
    shards = -(-total // layout.per_shard)

    def size_of(shard: int) -> int:
        return (min((shard + 1) * layout.per_shard, total) - shard * layout.per_shard) * layout.stride

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, start = row["n"], row["start"]
                slot = permuted(np.arange(start, start + n), total, layout.key)
                raw = _codec().decompress(row["ids"], n * layout.stride, asbytes=True)
                ids = np.frombuffer(raw, np.uint8).reshape(n, layout.stride)
                docs = np.frombuffer(row["docs"], np.int64)
                to = slot // layout.per_shard
                order = np.argsort(to, kind="stable")
                for here in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                    packed = _codec().compress(ids[here].tobytes(), asbytes=True)
                    out = [[int(to[here[0]])], [slot[here].tobytes()], [docs[here].tobytes()], [packed]]
                    names = ["shard", "slots", "docs", "ids"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _DEALT)], names)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        context = TaskContext.get()
        mark = f"{context.taskAttemptId()}-{os.getpid()}"
        files: dict[int, str] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                slot, docs = np.frombuffer(row["slots"], np.int64), np.frombuffer(row["docs"], np.int64)
                raw = _codec().decompress(row["ids"], len(slot) * layout.stride, asbytes=True)
                place = (slot - shard * layout.per_shard) * layout.stride
                crcs = np.empty(len(slot), np.int64)
                done = shard not in files and _whole(folder, shard, size_of(shard))
                if not done and shard not in files:
                    files[shard] = f"{shard_file(folder, shard)}.{mark}"
                    with open(files[shard], "wb") as file:
                        file.truncate(size_of(shard))
                with open(shard_file(folder, shard) if done else files[shard], "rb" if done else "r+b") as file:
                    for i, at in enumerate(place.tolist()):
                        own = raw[i * layout.stride : (i + 1) * layout.stride]
                        crcs[i] = zlib.crc32(own)
                        if not done:
                            file.seek(at)
                            file.write(own)
                known = pa.array(docs, mask=docs < 0)
                columns = [slot, np.full(len(slot), shard, np.int32), place]
                arrays = [*(pa.array(c) for c in columns), known, pa.array(crcs)]
                yield pa.RecordBatch.from_arrays(arrays, names_out)
        for shard, trial in files.items():
            os.replace(trial, shard_file(folder, shard))

    names_out = ["slot", "shard", "byte_offset", "first_doc_id", "ids_crc32"]
    schema = "shard int, slots binary, docs binary, ids binary"
    by_shard = numbered.select("n", "start", "docs", "ids").mapInArrow(dealt, schema).repartition(max(1, shards), "shard")
    return by_shard.mapInArrow(written, RESULT)


_DEALT = (pa.int32(), pa.binary(), pa.binary(), pa.binary())


def read(folder: str, first: int, n: int, layout: Layout = Layout()) -> np.ndarray:
    """``n`` sequences from slot ``first`` on, fewer at the end; reads only their bytes."""
    folder, out = local_path(folder), []
    while n > 0:
        shard, at = divmod(first, layout.per_shard)
        path = shard_file(folder, shard)
        if not os.path.exists(path):
            break
        with open(path, "rb") as file:
            file.seek(at * layout.stride)
            raw = file.read(min(n, layout.per_shard - at) * layout.stride)
        got = len(raw) // layout.stride
        out.append(np.frombuffer(raw, layout.kind).reshape(got, layout.length))
        first, n = first + got, n - got
        if at + got < layout.per_shard:
            break
    return np.concatenate(out) if out else np.zeros((0, layout.length), layout.kind)


def resumed(spark: SparkSession, folder: str, layout: Layout, slot: int) -> DataFrame:
    """The shard files that a run interrupted at ``slot`` still has to read, with the byte to begin at."""
    shard, at = divmod(slot, layout.per_shard)
    files = sorted(f for f in os.listdir(local_path(folder)) if f.endswith(".bin"))
    rows = [(f, at * layout.stride if i == shard else 0) for i, f in enumerate(files) if i >= shard]
    return spark.createDataFrame(rows, "file string, byte_offset long")

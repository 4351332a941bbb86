"""Merkle manifest of a corpus: a SHA-256 midstate tree.

Each row is a leaf, the digest of its fields. Leaves of a group (say a language) stand in the order of their key;
every ``fanout`` consecutive nodes give a node, the digest of their digests as hex text, until one is left, the
group's subroot. Subroots in the order of their groups give the root in the same way.

A digest as hex text fills one block of SHA-256, so the state of a parent's hash before each of its children is
eight words and nothing else. Parents keep a copy of that state for every child slot. When a child changes, folding
resumes the copy of its slot with the new digest and the siblings to its right; those to its left are not read again.
States are table columns, so that they outlive a task: the tree is built in spans of at most ``SPAN`` leaves, the
spans' nodes are the leaves of the next tier, and so on, however many rows there are. A row carries 32 bytes of folded
digest and 32 bytes of the running hash of its proof from tier to tier.

Null fields are ``-``, others their length in bytes, a colon and their value. Rows without a key come first in
their group, rows without a group are the first group. Rows of one key are ordered by their digest, so repeated rows are
interchangeable. Long and empty texts are leaves like others: their texts never leave the scan. An empty
table gives no rows and no root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Most leaves of a span, and rows that a task works on at a time.
SPAN = 1024
ROWS = 16_384


def _root(n: int, k: int) -> int:
    """The integer k-th root, by bits."""
    out = 0
    for bit in reversed(range(n.bit_length() // k + 1)):
        if (out | 1 << bit) ** k <= n:
            out |= 1 << bit
    return out


def _fractions(count: int, k: int) -> np.ndarray:
    """The first 32 bits behind the point of the k-th roots of the first primes."""
    primes = [p for p in range(2, 312) if all(p % d for d in range(2, _root(p, 2) + 1))][:count]
    return np.array([_root(p << 32 * k, k) & 0xFFFFFFFF for p in primes], np.uint32)


_START, _ROUND = _fractions(8, 2), _fractions(64, 3)
_NIBBLE = np.frombuffer(b"0123456789abcdef", np.uint8).astype(np.uint32)
_N = np.arange(1 << 16)
#: Four hex characters as one word, for every 16 bits.
_HEX = sum(_NIBBLE[(_N >> (12 - 4 * i)) & 15] << np.uint32(24 - 8 * i) for i in range(4))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compress(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States (8, n) after one more block each, of words (16, n), or (16, 1) where all take the same."""
    w = list(words)
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        x = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        y = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[i - 16] + x + w[i - 7] + y)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (w[i] + _ROUND[i])
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (c & (a ^ b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h))


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States (8, n) after the hex text of one more digest (8, n) each."""
    words = np.empty((16, digests.shape[1]), np.uint32)
    words[0::2], words[1::2] = _HEX[digests >> np.uint32(16)], _HEX[digests & np.uint32(0xFFFF)]
    return compress(state, words)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of states that have taken ``blocks`` whole blocks: the same last block for all of one length."""
    out = np.empty_like(state)
    for n in np.unique(blocks):
        at, words = blocks == n, np.zeros((16, 1), np.uint32)
        words[0], words[14], words[15] = 1 << 31, int(n) * 512 >> 32, int(n) * 512 & 0xFFFFFFFF
        out[:, at] = compress(state[:, at], words)
    return out


def fresh(n: int) -> np.ndarray:
    return np.repeat(_START[:, None], n, axis=1)


@dataclass
class Level:
    """Nodes of a level, runs of which are the children of one parent."""

    digest: np.ndarray
    parent: np.ndarray
    slot: np.ndarray
    #: Children of each parent.
    many: np.ndarray
    #: Copies of the parent's state before each child; parents of inactive nodes are these nodes themselves.
    before: np.ndarray
    active: np.ndarray

    @classmethod
    def over(cls, digest: np.ndarray, parent: np.ndarray, slot: np.ndarray, active: np.ndarray) -> tuple[Level, np.ndarray]:
        """The level, and its parents' digests."""
        many = np.bincount(parent)
        states, before = fresh(len(many)), fresh(len(slot))
        for j in range(int(slot.max(initial=0)) + 1):
            at = np.flatnonzero((slot == j) & active)
            if len(at):
                before[:, at] = states[:, parent[at]]
                states[:, parent[at]] = absorb(before[:, at], digest[:, at])
        above = finish(states, many)
        above[:, parent[~active]] = digest[:, ~active]
        return cls(digest, parent, slot, many, before, active), above

    def fold(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The parents' digests where node ``at[i]`` has the digest ``values[i]``: its slot's state resumed."""
        many, out = self.many[self.parent[at]], values.copy()
        on = self.active[at]
        state = absorb(self.before[:, at[on]], values[:, on])
        left, here = (many - self.slot[at] - 1)[on], at[on]
        for r in range(1, int(left.max(initial=0)) + 1):
            has = left >= r
            state[:, has] = absorb(state[:, has], self.digest[:, here[has] + r])
        out[:, on] = finish(state, many[on])
        return out

    def prove(self, run: np.ndarray, blocks: np.ndarray, at: np.ndarray) -> None:
        """Takes the siblings of nodes ``at`` into the running hashes, in place."""
        many, slot = self.many[self.parent[at]], self.slot[at]
        for j in range(int(many.max(initial=0))):
            has = np.flatnonzero((j < many) & (slot != j) & self.active[at])
            if len(has):
                run[:, has] = absorb(run[:, has], self.digest[:, at[has] - slot[has] + j])
                blocks[has] += 1


def levels(digest: np.ndarray, group: np.ndarray, pos: np.ndarray, size: np.ndarray, fanout: int, height: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Up to ``height`` levels over whole spans in order; the top's digests, and each leaf's node at the top."""
    found, node = [], np.arange(len(pos))
    for _ in range(height):
        active, up = size > 1, pos // fanout
        new = np.ones(len(pos), bool)
        new[1:] = (group[1:] != group[:-1]) | (up[1:] != up[:-1])
        parent = np.cumsum(new) - 1
        level, digest = Level.over(digest, parent, np.where(active, pos % fanout, 0), active)
        found.append(level)
        node = parent[node]
        group, pos, size = group[new], up[new], -(-size[new] // fanout)
    return found, digest, node


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets."""
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(data: np.ndarray) -> np.ndarray:
    """Digests (8, n) of n x 32 bytes."""
    return np.ascontiguousarray(data.view(">u4").reshape(-1, 8).T.astype(np.uint32))


def _bytes(digests: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(digests.T).astype(">u4")
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _whole_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of whole spans, some ``ROWS`` rows each; rows come in the order of (grp, span, pos)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < ROWS:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        new = _new_span(whole)
        last = int(np.flatnonzero(new)[-1])
        held = [whole.slice(last)]
        if last:
            yield whole.slice(0, last)
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _new_span(batch: pa.RecordBatch) -> np.ndarray:
    group, span = (batch.column(batch.schema.get_field_index(c)) for c in ("grp", "span"))
    group, span = group.dictionary_encode().indices.to_numpy(), span.to_numpy()
    new = np.ones(batch.num_rows, bool)
    new[1:] = (group[1:] != group[:-1]) | (span[1:] != span[:-1])
    return new


def _tier(fanout: int, height: int, rows: bool):
    """One tier over spans: the spans' nodes, and of each node its row (fold and proof) or its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_spans(batches):
            col = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            new, pos, size = _new_span(batch), col["pos"].to_numpy(), col["size"].to_numpy()
            first = np.flatnonzero(new)
            digest = _words(_binary(col["digest"])[0])
            found, top, node = levels(digest, np.cumsum(new), pos, size, fanout, height)
            n, m = len(pos), len(first)
            firsts = pa.array(first)
            nodes = {"grp": col["grp"].take(firsts), "pos": col["span"].take(firsts), "digest": _bytes(top), "size": pa.array(-(-size[first] // fanout**height))}
            at = np.arange(n)
            if rows:
                value, proof, blocks = _words(_binary(col["changed"])[0]), fresh(n), np.zeros(n, np.int64)
                for level in found:
                    level.prove(proof, blocks, at)
                    value, at = level.fold(value, at), level.parent[at]
                own = {"id": col["id"], "leaf": col["digest"], "value": _bytes(value), "proof": _bytes(proof), "blocks": pa.array(blocks)}
                types = _ROW
            else:
                cells: list[tuple[np.ndarray, ...]] = []
                for level in found:
                    slot, many = level.slot[at], level.many[level.parent[at]]
                    cells.append((level.active[at], level.before[:, at], at - slot, slot, many, level.digest))
                    at = level.parent[at]
                own, types = _paths(cells, n), _PATH
            here = {"grp": col["grp"], "span": col["span"], "pos": col["pos"], "size": col["size"]} | own
            for part, count in ((here, n), (nodes | {"span": pa.nulls(m, pa.int64())}, m)):
                columns = [part.get(f.name, pa.nulls(count, f.type)).cast(f.type) for f in types]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return run


_NODE = [("grp", pa.string()), ("span", pa.int64()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())]
_ROW = pa.schema([*_NODE, ("id", pa.int64()), ("leaf", pa.binary()), ("value", pa.binary()), ("proof", pa.binary()), ("blocks", pa.int64())])
_STEPS = ("before", "lefts", "rights")
_PATH = pa.schema([*_NODE, *[(c, pa.list_(pa.binary())) for c in _STEPS]])


def _paths(cells: list[tuple[np.ndarray, ...]], n: int) -> dict[str, pa.Array]:
    """Of each node, per level: the state before it, the digests to its left and to its right."""
    out: dict[str, list[list[bytes]]] = {c: [[] for _ in range(n)] for c in _STEPS}
    for active, before, first, slot, many, digest in cells:
        states, whole = before.T.astype(">u4").tobytes(), digest.T.astype(">u4").tobytes()
        for i in np.flatnonzero(active):
            a, s, m = int(first[i]), int(slot[i]), int(many[i])
            out["before"][i].append(states[32 * i : 32 * i + 32])
            out["lefts"][i].append(whole[32 * a : 32 * (a + s)])
            out["rights"][i].append(whole[32 * (a + s + 1) : 32 * (a + m)])
    return {c: pa.array(v, pa.list_(pa.binary())) for c, v in out.items()}


def _schema(types: pa.Schema) -> str:
    names = {"int64": "long", "list<item: binary>": "array<binary>"}
    return ", ".join(f"{f.name} {names.get(str(f.type), f.type)}" for f in types)


def _ranked(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Adds pos, each row's place in its group from 0, and size, the group's rows; groups are divided by ranges."""
    parted = df.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id())
    parted = staged(parted, label)
    counts = parted.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(group).alias("size"))
    inside = Window.partitionBy("part", "grp").orderBy(*order)
    found = parted.join(base, ["part", "grp"]).withColumn("pos", F.col("base") + F.row_number().over(inside) - 1)
    return found.drop("part", "base")


def _climb(nodes: DataFrame, fanout: int, height: int, rows: bool, label: str) -> tuple[DataFrame, DataFrame]:
    """One tier: the rows or paths of its nodes, and the nodes above them."""
    spans = nodes.withColumn("span", F.floor(F.col("pos") / F.lit(fanout**height)).cast("long"))
    dealt = spans.repartition("grp", "span").sortWithinPartitions("grp", "span", "pos")
    out = staged(dealt.mapInArrow(_tier(fanout, height, rows), _schema(_ROW if rows else _PATH)), label)
    own = out.where("span is not null")
    return own, out.where("span is null").select("grp", "pos", "digest", "size")


def _tiers(nodes: DataFrame, fanout: int, height: int) -> tuple[DataFrame, DataFrame]:
    """All tiers over some nodes: (grp, pos, path) of each node, and the group's last node each."""
    tables, first = [], nodes
    while (nodes.agg(F.max("size")).first()[0] or 0) > 1:
        paths, nodes = _climb(nodes, fanout, height, False, "paths")
        tables.append(paths.select("grp", "pos", F.col("span").alias("up"), *_STEPS))
    if not tables:
        empty = [F.array().cast("array<binary>").alias(c) for c in _STEPS]
        return first.select("grp", "pos", *empty), nodes
    whole = tables[-1].drop("up")
    for below in reversed(tables[:-1]):
        above = whole.select("grp", F.col("pos").alias("up"), *[F.col(c).alias(f"_{c}") for c in _STEPS])
        joined = below.join(above, ["grp", "up"])
        whole = joined.select("grp", "pos", *[F.concat(c, f"_{c}").alias(c) for c in _STEPS])
    return whole, nodes


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows carried up the path of their span's node: the digest at the root and the digest of the proof."""
    for batch in _gathered(batches, ROWS // 2):
        col = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        value, run = (_words(_binary(col[c])[0]) for c in ("value", "proof"))
        blocks = col["blocks"].to_numpy().copy()
        offsets = col["before"].offsets.to_numpy().astype(np.int64)
        offsets, many = offsets - offsets[0], np.diff(offsets)
        states = _words(_binary(col["before"].flatten())[0])
        sides = []
        for c in ("lefts", "rights"):
            data, places = _binary(col[c].flatten())
            sides.append((_words(data), places // 32))
        (left, left_at), (right, right_at) = sides
        for i in range(int(many.max(initial=0))):
            row = np.flatnonzero(many > i)
            step = offsets[:-1][row] + i
            state = absorb(states[:, step], value[:, row])
            lefts, rights = left_at[step + 1] - left_at[step], right_at[step + 1] - right_at[step]
            for r in range(int(lefts.max(initial=0))):
                has = lefts > r
                run[:, row[has]] = absorb(run[:, row[has]], left[:, left_at[step[has]] + r])
            for r in range(int(rights.max(initial=0))):
                has = rights > r
                sibling = right[:, right_at[step[has]] + r]
                run[:, row[has]] = absorb(run[:, row[has]], sibling)
                state[:, has] = absorb(state[:, has], sibling)
            value[:, row] = finish(state, lefts + rights + 1)
            blocks[row] += lefts + rights
        kept = [col[c] for c in ("id", "leaf", "subroot", "root")]
        columns = [*kept, _bytes(finish(run, blocks)), _bytes(value)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "leaf", "subroot", "root", "proof", "folded"])


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    """The digest of some fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def manifest(docs: DataFrame, changes: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", fanout: int = 2) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``changes`` are other values of some fields, as columns of ``docs``: leaves with them are folded with the tree's
    states and siblings, and are verified where that gives the root. Digests are lowercase hex.
    """
    if fanout < 2:
        raise ValueError("a node needs two children or more")
    height = 1
    while fanout ** (height + 1) <= SPAN:
        height += 1
    named = [F.col(f"`{f}`") for f in fields]
    other = [(changes or {}).get(f, F.col(f"`{f}`")) for f in fields]
    held = F.col(f"`{group}`").cast("string")
    leaves = staged(
        docs.select(
            F.col(f"`{key}`").cast("long").alias("id"),
            F.when(held.isNull(), "0").otherwise(F.concat(F.lit("1"), held)).alias("grp"),
            leaf(named).alias("digest"),
            leaf(other).alias("changed"),
        ),
        "leaves",
    )
    rows, nodes = _climb(_ranked(leaves, ["id", "digest", "changed"], "ranked"), fanout, height, True, "spans")
    paths, subroots = _tiers(nodes, fanout, height)
    groups = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    groups = staged(_ranked(groups, ["name"], "groups"), "subroots")
    above, root = _tiers(groups.drop("name"), fanout, height)
    above = above.join(groups.select("grp", "pos", "name", F.col("digest").alias("subroot")), ["grp", "pos"])
    above = above.join(root.select("grp", F.col("digest").alias("root")), "grp")
    above = above.select(F.col("name").alias("grp"), "subroot", "root", *[F.col(c).alias(f"_{c}") for c in _STEPS])
    whole = paths.join(above, "grp")
    whole = whole.select("grp", F.col("pos").alias("span"), "subroot", "root", *[F.concat(c, f"_{c}").alias(c) for c in _STEPS])
    carried = rows.select("grp", "span", "id", "leaf", "value", "proof", "blocks").join(staged(whole, "whole"), ["grp", "span"])
    schema = "id long, leaf binary, subroot binary, root binary, proof binary, folded binary"
    done = carried.select("id", "leaf", "subroot", "root", "value", "proof", "blocks", *_STEPS).mapInArrow(_finished, schema)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return done.select(
        F.col("id").alias(key),
        text["leaf"].alias("leaf"),
        text["subroot"].alias("subroot"),
        text["root"].alias("root"),
        text["proof"].alias("proof_sha256"),
        text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def one_more(docs: DataFrame, every: int = 7) -> dict[str, Column]:
    """One more character counted where ``every`` divides the id's checksum; nulls and other types stay."""
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string")) % every == 0
    size = F.col("n_chars").cast("decimal(20,0)")
    return {"n_chars": F.when(F.coalesce(chosen, F.lit(False)), size + 1).otherwise(size).cast("decimal(20,0)")}

"""Interpolated modified Kneser-Ney bigrams, counted in Spark and read by workers through memory maps.

Words and an end mark are tokens (lower case A-Z); a begin mark is a context only. Spark counts words, bigrams by
context, and in how many contexts a word was seen (its continuations). Each range of the hash space
becomes a few sorted arrays in the shared folder; a worker maps the files and finds what a text
needs by binary search, so its memory does not grow with the model.

    p(w | v) = max(c(vw) - D(c), 0) / c(v.) + g(v) p(w)        g(v) = (D1 N1 + D2 N2 + D3 N3) / c(v.)
    p(w)     = max(k(w) - D'(k), 0) / k(.)  + g' / (V + 1)

with D from the counts of counts. An unseen context backs off to p(w); an unseen word gets the last term.

Contexts with over a thousandth of all tokens (under a thousand can exist) are dealt over several ranges by the
second word; their totals, a row for each, are the only counts the driver sees. Files are written under
a temporary name and renamed, so a task that runs twice does no harm. Words are told apart by 48 bits of
their hash.

Null and empty texts are an end mark alone. Rows without an id are training rows. Repeated rows count
as often as they come. Without training rows every token has p = 1. Other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import local_path, staged
from quipu.llm.words import Piece, mix, pieces
from quipu.session import scratch_path

END, BEGIN = np.uint64(1), np.uint64(2)
LOW48 = np.uint64((1 << 48) - 1)
PER_RANGE = 1_000_000
SALTS = 64
HELD = 1_200_000
#: Files a worker has mapped at a time; a process may have some 65,000 maps.
MAPPED = 8_192
FOLDS, HELD_OUT = 7, 2


def held_out() -> Column:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def tokens(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and end marks of some texts, each one's context, and the n + 1 bounds."""
    n = np.diff(piece.bounds)
    bounds = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(bounds[-1], END)
    last = bounds[1:] - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    words = piece.hashes() & LOW48
    out[inner] = np.where(words < 16, words + np.uint64(16), words)
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[bounds[:-1]] = BEGIN
    return out, before, bounds


def _range(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((mix(key) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _home(before: np.ndarray, word: np.ndarray, hot: np.ndarray, ranges: int) -> np.ndarray:
    """The range that counts a bigram: its context's, for a hot context one of several."""
    key = before.copy()
    if len(hot):
        common = hot[np.minimum(np.searchsorted(hot, before), len(hot) - 1)] == before
        salt = mix(word[common]) % np.uint64(SALTS) + np.uint64(1)
        key[common] ^= salt << np.uint64(48)
    return _range(key, ranges)


def _bigram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before) + word)


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(blocks: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel().astype(np.uint64)


def _numbers(blocks: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blocks), kind)


BLOCK = "part int, heads binary, sizes binary, words binary, counts binary"
_BLOCK = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("heads", "sizes", "words", "counts")]])


def _blocks(part, word, count, head=None) -> list[tuple]:
    """Rows of (part, head, word, count), sorted by part and head, as one block a part."""
    out = []
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        heads, sizes = b"", b""
        if head is not None:
            runs = np.concatenate([[0], np.flatnonzero(np.diff(head[a:b])) + 1, [b - a]])
            heads, sizes = _pack(head[a:b][runs[:-1]]), np.diff(runs).astype("<u4").tobytes()
        out.append((int(part[a]), heads, sizes, _pack(word[a:b]), count[a:b].astype("<u4").tobytes()))
    return out


def _sums(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    total = np.concatenate([[0], np.cumsum(counts[order], dtype=np.int64)])
    cuts = np.append(np.flatnonzero(new), len(order))
    return [k[new] for k in keys], total[cuts[1:]] - total[cuts[:-1]]


def _emit(blocks: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*blocks), _BLOCK)], schema=_BLOCK)


def _text_blocks(texts: DataFrame, ranges: int, hot: np.ndarray | None) -> DataFrame:
    """Blocks of words (``hot`` None) or of bigrams by context, summed over some megabytes of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word: list[np.ndarray] = []
        before: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not word:
                return
            w, v = np.concatenate(word), np.concatenate(before)
            word.clear()
            before.clear()
            ones = np.ones(len(w), np.int64)
            if hot is None:
                (w,), count = _sums([w], ones)
                part, head = _range(w, ranges), None
            else:
                (v, w), count = _sums([v, w], ones)
                part, head = _home(v, w, hot, ranges), v
            order = np.argsort(part, kind="stable")
            blocks = _blocks(part[order], w[order], count[order], None if head is None else head[order])
            yield _emit(blocks)

        held = 0
        for batch in batches:
            for piece in pieces(batch.column(0)):
                w, v, _ = tokens(piece)
                word.append(w)
                before.append(v)
                held += len(w)
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return texts.select("text").mapInArrow(run, BLOCK)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all, also when two attempts of a task run."""
    path = f"{folder}/{name}.npy"
    os.makedirs(folder, exist_ok=True)
    trial = f"{path}.{os.getpid()}.{np.random.default_rng().integers(1 << 60)}"
    with open(trial, "wb") as file:
        np.save(file, array)
    os.replace(trial, path)


def _small(count: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    kinds = (np.uint8, np.uint16, np.uint32, np.uint64)
    most = int(count.max()) if len(count) else 0
    return count.astype(next(k for k in kinds if most <= np.iinfo(k).max))


def _tail(count: np.ndarray) -> list[int]:
    return [int((count == k).sum()) for k in (1, 2, 3, 4)]


def _save_words(folder: str, name: str):
    """Sorted words and counts of a range as files; returns what the whole model needs of it."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        part = int(block["part"].iloc[0])
        (word,), count = _sums([_unpack(block["words"])], _numbers(block["counts"], "<u4").astype(np.int64))
        _save(folder, f"{name}-word-{part}", word)
        _save(folder, f"{name}-count-{part}", _small(count))
        three = int((count >= 3).sum())
        return pd.DataFrame([(len(word), int(count.sum()), *_tail(count), three)], columns=_STATS)

    return run


_STATS = ["types", "total", "n1", "n2", "n3", "n4", "over2"]
STATS = ", ".join(f"{c} long" for c in _STATS)


def _save_bigrams(folder: str, hot: np.ndarray, ranges: int):
    """Bigrams and contexts of a range as files; returns continuation blocks, hot contexts and statistics.

    The rows are blocks of part >= 0 (continuations), -1 (hot contexts) and -2 (counts of counts).
    """

    def run(block: pd.DataFrame) -> pd.DataFrame:
        part = int(block["part"].iloc[0])
        sizes = _numbers(block["sizes"], "<u4")
        before = np.repeat(_unpack(block["heads"]), sizes)
        count = _numbers(block["counts"], "<u4").astype(np.int64)
        (before, word), count = _sums([before, _unpack(block["words"])], count)
        key = _bigram(before, word)
        order = np.argsort(key)
        _save(folder, f"two-key-{part}", key[order])
        _save(folder, f"two-count-{part}", _small(count[order]))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(before)) + 1, [len(before)]])
        context = before[cuts[:-1]]
        sums = np.stack([_between(x, cuts) for x in (count, count == 1, count == 2, count >= 3)], 1)
        common = np.isin(context, hot)
        _save(folder, f"context-word-{part}", context[~common])
        _save(folder, f"context-sums-{part}", sums[~common].astype(np.uint32 if sums.max() < 1 << 32 else np.uint64))
        (once,), kinds = _sums([word], np.ones(len(word), np.int64))
        to = _range(once, ranges)
        order = np.argsort(to, kind="stable")
        out = _blocks(to[order], once[order], kinds[order])
        if common.any():
            out.append((-1, _pack(context[common]), sums[common].astype("<i8").tobytes(), b"", b""))
        out.append((-2, b"", np.array(_tail(count), "<i8").tobytes(), b"", b""))
        return pd.DataFrame(out, columns=_BLOCK.names)

    return run


def _between(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return total[cuts[1:]] - total[cuts[:-1]]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of types seen once to four times; fixed ones where these do not do."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), found))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers all texts share."""

    folder: str
    ranges: int
    word_ranges: int
    tokens: int
    types: int
    hot: np.ndarray
    hot_sums: np.ndarray
    discount: tuple[float, float, float]
    low_discount: tuple[float, float, float]
    low_total: int
    low_rest: float

    def mapped(self) -> Mapped:
        return Mapped(self)


def train(texts: DataFrame) -> Model:
    spark = texts.sparkSession
    folder = local_path(scratch_path(spark, "bigrams"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = max(8, -(-size // (8 * PER_RANGE)))
    word_ranges = max(8, ranges // 4)
    words = _text_blocks(texts, word_ranges, None).groupBy("part").applyInPandas(_save_words(folder, "one"), STATS)
    words = staged(words, "words").agg(*[F.sum(c).alias(c) for c in _STATS]).first()
    total = words["total"] or 0
    hot = np.zeros(0, np.uint64)
    if total:
        common = []
        parts = spark.range(word_ranges).select(F.col("id").cast("int").alias("part"))

        def often(block: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in block:
                for part in rows["part"]:
                    if not os.path.exists(f"{folder}/one-word-{part}.npy"):
                        continue
                    word = np.load(f"{folder}/one-word-{part}.npy", mmap_mode="r")
                    count = np.load(f"{folder}/one-count-{part}.npy", mmap_mode="r")
                    yield pd.DataFrame({"word": word[count > total / 1000].view(np.int64)})

        common = [r["word"] for r in parts.mapInPandas(often, "word long").collect()]  # under a thousand
        hot = np.sort(np.array([*common, int(BEGIN)], np.int64).view(np.uint64))
    blocks = _text_blocks(texts, ranges, hot).groupBy("part").applyInPandas(_save_bigrams(folder, hot, word_ranges), BLOCK)
    blocks = staged(blocks, "continuations")
    low = blocks.where("part >= 0").groupBy("part").applyInPandas(_save_words(folder, "low"), STATS)
    low = staged(low, "low").agg(*[F.sum(c).alias(c) for c in _STATS]).first()
    # a row for each range, and in it at most a thousand contexts
    rest = blocks.where("part < 0").select("part", "heads", "sizes").collect()
    tails = [np.frombuffer(r["sizes"], "<i8") for r in rest if r["part"] == -2]
    sums = np.zeros((len(hot), 4), np.int64)
    for r in rest:
        if r["part"] == -1:
            at = np.searchsorted(hot, _unpack(pd.Series([r["heads"]])))
            sums[at] += np.frombuffer(r["sizes"], "<i8").reshape(-1, 4)
    below = discounts([low[c] or 0 for c in ("n1", "n2", "n3", "n4")])
    left = below[0] * (low["n1"] or 0) + below[1] * (low["n2"] or 0) + below[2] * (low["over2"] or 0)
    return Model(
        folder=folder,
        ranges=ranges,
        word_ranges=word_ranges,
        tokens=total,
        types=words["types"] or 0,
        hot=hot,
        hot_sums=sums,
        discount=discounts([int(x) for x in np.sum(tails, axis=0)] if tails else [0]),
        low_discount=below,
        low_total=low["total"] or 0,
        low_rest=left / low["total"] if low["total"] else 1.0,
    )


def _cut(count: np.ndarray, discount: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts."""
    by = np.array([0.0, *discount])[np.minimum(count, 3)]
    return np.maximum(count - by, 0.0)


class Mapped:
    """The model's arrays, mapped range by range as they are needed."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.files: dict[str, np.ndarray | None] = {}

    def file(self, name: str) -> np.ndarray | None:
        if name not in self.files:
            if len(self.files) >= MAPPED:
                del self.files[next(iter(self.files))]
            path = f"{self.model.folder}/{name}.npy"
            self.files[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.files[name]

    def look(self, part: np.ndarray, key: np.ndarray, keys: str, values: str, wide: int = 0) -> np.ndarray:
        """Values of keys in the ranges they belong to, zeros for unknown ones."""
        out = np.zeros((len(key), wide) if wide else len(key), np.int64)
        order = np.lexsort((key, part))
        cuts = np.searchsorted(part[order], np.arange(int(part.max(initial=-1)) + 2))
        for p in range(len(cuts) - 1):
            here = order[cuts[p] : cuts[p + 1]]
            if not len(here) or (known := self.file(f"{keys}-{p}")) is None or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, key[here]), len(known) - 1)
            hit = known[at] == key[here]
            out[here[hit]] = self.file(f"{values}-{p}")[at[hit]]
        return out

    def scores(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training counts and log10 probabilities of tokens after their contexts."""
        m = self.model
        one, which = np.unique(word, return_inverse=True)
        part = _range(one, m.word_ranges)
        count = self.look(part, one, "one-word", "one-count")
        kinds = self.look(part, one, "low-word", "low-count")
        low = m.low_rest / (m.types + 1) + (_cut(kinds, m.low_discount) / m.low_total if m.low_total else 0.0)
        context, back = np.unique(before, return_inverse=True)
        sums = self.look(_range(context, m.ranges), context, "context-word", "context-sums", 4)
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, context), len(m.hot) - 1)
            hit = m.hot[at] == context
            sums[hit] = m.hot_sums[at[hit]]
        seen = sums[:, 0] > 0
        total = np.maximum(sums[:, 0], 1)
        free = np.where(seen, (sums[:, 1:] * np.array(m.discount)).sum(1) / total, 1.0)
        pair, again = np.unique(_bigram(before, word), return_inverse=True)
        first = np.zeros(len(pair), np.int64)
        first[again] = np.arange(len(word))
        home = _home(before[first], word[first], m.hot, m.ranges)
        both = self.look(home, pair, "two-key", "two-count")[again]
        high = _cut(both, m.discount) / total[back]
        return count[which], np.log10(high + free[back] * low[which])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    table = docs.sparkSession.sparkContext.broadcast(model)  # hot contexts: under a thousand rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = table.value
        arrays = m.mapped()
        scale = np.log10(m.tokens + m.types + 1)
        for batch in batches:
            for piece in pieces(batch.column(2)):
                word, before, bounds = tokens(piece)
                count, score = arrays.scores(word, before)
                base = np.log10(count + 1.0) - scale
                known = _between(count > 0, bounds)
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (base, score)]  # a text has an end at least
                kept = [batch.column(i).slice(piece.first, piece.n) for i in range(2)]
                train = np.full(piece.n, m.tokens, np.int64)
                columns = [*kept, *(pa.array(x) for x in (np.diff(bounds), known, train, *sums))]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """Scores all documents by a model of those that are not held out."""
    return scored(docs, train(docs.where(~held_out())))

"""Quality rules by cross-document line frequency.

Each line is normalised (words in lower case A-Z, one blank between them) and hashed. A line that stands
in too many distinct documents of its host is boilerplate and is removed; a document of which too little
remains is depleted and rejected, as is one that fails the base rules. Distinct documents are distinct
texts: copies are left to deduplication and do not make a document's own lines boilerplate. The limit
is a share of the host's distinct documents, and at least ``min_docs``. ``cleaned`` counts near copies once as well:
among the texts that hold a line over the limit, the components of the Jaccard join are one document each.

Null and empty texts have no words and fail the base rules. Rows without a host are one host. Repeated rows
each get the same verdict. An empty table gives no rows. Other columns are ignored by ``verdicts``
and kept by ``cleaned``, also those named like the verdict's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import jaccard
from quipu.llm.common import small, staged
from quipu.llm.words import Piece, lines, pieces, run_hashes, span_hashes, sums_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: A line is boilerplate in more than this share of a host's texts, and more texts than min_docs.
    max_share: float = 0.01
    min_docs: int = 10
    #: A document is depleted if fewer than so many percent of its words remain.
    min_left_percent: int = 30


def _measured(piece: Piece) -> tuple[dict[str, np.ndarray], pa.Array, pa.Array, pa.Array]:
    """Counts of each text; hash, number and words of its lines that have words."""
    n_words = np.diff(piece.bounds)
    exact, lower = piece.hashes(lower=False), piece.hashes()
    inside = np.zeros(len(piece.data) + 1, np.int8)
    inside[piece.starts] = 1
    inside[piece.ends] -= 1  # a word may begin where none ended, never where one ends
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    letters = sums_of(in_word & ((piece.data & 0xC0) != 0x80), piece.offsets)
    symbols = sums_of(_SYMBOL[piece.data], piece.offsets)

    grams, bounds = piece.grams(exact, WINDOW)
    owner = np.repeat(np.arange(piece.n), np.diff(bounds))
    order = np.lexsort((grams, owner))
    same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first = np.flatnonzero(twice)
    first = first - bounds[owner[first]] + piece.bounds[owner[first]]
    cover = np.zeros(len(exact) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + WINDOW, -1)
    repeats = sums_of(np.cumsum(cover[:-1]) > 0, piece.bounds)

    starts, ends, owner = lines(piece)
    begin, end = np.searchsorted(piece.starts, starts), np.searchsorted(piece.starts, ends)
    full = end > begin
    starts, ends, owner, begin, end = (x[full] for x in (starts, ends, owner, begin, end))
    raw = span_hashes(piece.data, starts, ends, False)
    order = np.lexsort((raw, owner))
    same = (raw[order][1:] == raw[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    doubled = np.zeros(len(raw), bool)
    doubled[order[1:][same]] = True
    bounds = np.searchsorted(owner, np.arange(piece.n + 1))
    counts = dict(zip(COUNTS, (n_words, letters, symbols, sums_of(doubled, bounds), repeats)))
    places = pa.array(bounds.astype(np.int32))
    keys = run_hashes(lower, begin, end).view(np.int64)
    lists = [pa.ListArray.from_arrays(places, pa.array(x)) for x in (keys, (end - begin).astype(np.int64))]
    feeds = np.concatenate([[0], np.cumsum(piece.data == 10)])
    numbers = feeds[starts] - feeds[piece.offsets[owner]]
    return counts, *lists, pa.ListArray.from_arrays(places, pa.array(numbers))


def measured(docs: DataFrame) -> DataFrame:
    """A row per document: counts, and the hash, number and words of each of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in pieces(batch.column(3)):
                counts, keys, sizes, numbers = _measured(piece)
                kept = [batch.column(i).slice(piece.first, piece.n) for i in range(3)]
                ids = pa.array(np.arange(row, row + piece.n))
                row += piece.n
                columns = [ids, *kept, *(pa.array(counts[c]) for c in COUNTS), keys, sizes, numbers]
                names = ["row", "doc_id", "host", "text_key", *COUNTS, "line", "line_words", "line_no"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "row long, doc_id long, host string, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", line array<long>, line_words array<long>, line_no array<long>"
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.xxhash64("text").alias("text_key"),
        "text",
    ).mapInArrow(run, schema)


def _apart(docs: DataFrame, texts: DataFrame, frequent: DataFrame, rules: Rules) -> DataFrame:
    """The frequent lines that stay so where near copies, components of the Jaccard join, count once."""
    held = texts.select("host", "text_key", F.explode(F.array_distinct("line")).alias("line"))
    held = staged(held.join(frequent, ["host", "line"]), "held")
    keys = held.select(F.col("text_key").alias("doc_id")).distinct()
    whole = docs.select(F.xxhash64("text").alias("doc_id"), "text").join(small(keys), "doc_id", "left_semi")
    classes = jaccard.join(whole).select(F.col("doc_id").alias("text_key"), "component_id").distinct()
    one = held.join(staged(classes, "classes"), "text_key").select("host", "line", "host_docs", "component_id").distinct()
    counted = one.groupBy("host", "line", "host_docs").agg(F.count(F.lit(1)).alias("docs"))
    return counted.where((F.col("docs") > rules.min_docs) & (F.col("docs") > F.col("host_docs") * rules.max_share))


def verdicts(docs: DataFrame, rules: Rules = Rules(), apart: bool = False) -> DataFrame:
    """Counts and verdict of every document, with the numbers of the lines to remove.

    With ``apart``, a line is counted once per group of near copies, else once per distinct text.
    """
    rows = staged(measured(docs), "lines")
    texts = rows.dropDuplicates(["host", "text_key"])
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    per_text = texts.select("host", F.explode(F.array_distinct("line")).alias("line"))
    frequent = (
        per_text.groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") > rules.min_docs)
        .join(hosts, "host")
        .where(F.col("docs") > F.col("host_docs") * rules.max_share)
    )
    frequent = staged(frequent.select("host", "line", "host_docs"), "frequent")
    if apart and not frequent.isEmpty():
        frequent = staged(_apart(docs, texts, frequent, rules), "frequent")
    frequent = frequent.select("host", "line")
    zipped = F.arrays_zip("line", "line_words", "line_no")
    own = rows.select("row", "host", F.explode(zipped).alias("x")).select("row", "host", "x.*")
    removed = (
        own.join(frequent, ["host", "line"])
        .groupBy("row")
        .agg(F.sum("line_words").alias("removed_words"), F.sort_array(F.collect_list("line_no")).alias("removed_lines"))
    )
    judged = rows.join(removed, "row", "left")
    gone = F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    left = 100 * (F.col("n_words") - gone) >= rules.min_left_percent * F.col("n_words")
    return judged.select(
        "doc_id",
        "text_key",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & left).alias("kept"),
        gone.alias("removed_words"),
        F.coalesce("removed_lines", F.array().cast("array<long>")).alias("removed_lines"),
    )


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, without their boilerplate lines; columns as before."""
    found = verdicts(docs, rules, apart=True).select(
        F.col("doc_id").alias("__q_id"),
        F.col("text_key").alias("__q_key"),
        F.col("kept").alias("__q_kept"),
        F.col("removed_lines").alias("__q_lines"),
    )
    changes = staged(found.where(~F.col("__q_kept") | (F.size("__q_lines") > 0)).distinct(), "changes")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__q_id")) & (F.xxhash64("text") == F.col("__q_key"))
    joined = docs.join(small(changes), same, "left").where(F.coalesce("__q_kept", F.lit(True)))
    touched = F.size("__q_lines") > 0
    rest = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("__q_lines", i.cast("long")))
    joined = joined.withColumn("text", F.when(touched, F.array_join(rest, "\n")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(touched, size).otherwise(F.col("n_chars")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])

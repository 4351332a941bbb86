"""The most frequent values of all columns of a table, exact, in two scans.

The first scan keeps a mergeable sketch of frequent values per column; each task sends sketches of bounded size,
however many values there are. The second counts the sketches' candidates exactly. That proves itself: a value
that is no candidate is at most as frequent as the rows that no candidate accounts for, and as the sketch's error
bound allows. Where the last value shown is more frequent than that, none is missing. Columns for which that
fails, such as keys where every value is rare, are counted in full, together, in one more scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.text import col

#: Candidates of a column, and values its sketch tracks.
CANDIDATES, TRACKED = 100, 10_000
#: A value the sketch does not name has at most this share of the rows: twice the sketch's error, 3.5 by its table's size.
UNNAMED = 2 * 3.5 / 16_384

FACET = "columna string, valor string, frecuencia long, orden int"


@dataclass
class _Column:
    name: str
    rows: int
    candidates: list[str]
    counts: dict[str, int] = field(default_factory=dict)

    def top(self, most: int) -> list[tuple[str, int]]:
        return sorted(self.counts.items(), key=lambda x: (-x[1], x[0].encode()))[:most]

    def proved(self, most: int) -> bool:
        rest = self.rows - sum(self.counts.values())
        unseen = min(rest, UNNAMED * self.rows + 1)
        shown = self.top(most)
        return rest == 0 or (len(shown) == most and shown[-1][1] > unseen)


def facets(df: DataFrame, columns: Sequence[str] | None = None, top: int = 10, tracked: int = TRACKED) -> DataFrame:
    """(columna, valor, frecuencia, orden): each column's ``top`` values as text; ties by value, nulls not counted."""
    names = list(columns or df.columns)
    texts = df.select(*[col(n).cast("string").alias(f"c{i}") for i, n in enumerate(names)])
    found = _sketched(texts, names, max(CANDIDATES, 2 * top), tracked)
    _recount(texts, found)
    rows = [(c.name, v, n, k) for c in found for k, (v, n) in enumerate(c.top(top), 1) if c.proved(top)]
    out = df.sparkSession.createDataFrame(rows, FACET)
    rest = [i for i, c in enumerate(found) if not c.proved(top)]
    return out.unionAll(_whole(texts, names, rest, top)) if rest else out


def _sketched(texts: DataFrame, names: list[str], candidates: int, tracked: int) -> list[_Column]:
    each = [F.count(c).alias(f"n_{c}") for c in texts.columns]
    each += [F.expr(f"approx_top_k({c}, {candidates}, {tracked})").alias(f"s_{c}") for c in texts.columns]
    row = texts.agg(*each).first()  # some candidates per column
    return [
        _Column(n, row[f"n_{c}"], [x["item"] for x in row[f"s_{c}"] or [] if x["item"] is not None])
        for n, c in zip(names, texts.columns)
    ]


def _recount(texts: DataFrame, found: list[_Column]) -> None:
    tests = {i: F.col(f"c{i}").isin(c.candidates) for i, c in enumerate(found) if c.candidates}
    if not tests:
        return
    tagged = [F.when(t, F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v"))) for i, t in tests.items()]
    rows = texts.where(reduce(or_, tests.values())).select(F.explode(F.array_compact(F.array(*tagged))).alias("t"))
    for r in rows.groupBy("t.i", "t.v").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per candidate
        found[r.i].counts[r.v] = r.n


def _whole(texts: DataFrame, names: list[str], wanted: list[int], top: int) -> DataFrame:
    cells = [F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in wanted]
    tally = texts.select(F.inline(F.array(*cells))).where("v is not null").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    # the best of each hash part first, so that no window meets all values of a key column
    part = Window.partitionBy("i", F.pmod(F.xxhash64("v"), F.lit(512))).orderBy(F.desc("n"), "v")
    best = tally.withColumn("k", F.row_number().over(part)).where(F.col("k") <= top)
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("n"), "v"))
    name = F.array(*[F.lit(n) for n in names])[F.col("i")]
    ranked = best.select(name.alias("columna"), F.col("v").alias("valor"), F.col("n").alias("frecuencia"), rank.alias("orden"))
    return ranked.where(F.col("orden") <= top)

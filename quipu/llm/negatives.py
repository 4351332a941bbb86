"""Hard negatives by a cover tree over norm-augmented vectors.

The largest inner products are the smallest distances once every vector has the same length: a candidate x gets one more
component, sqrt(M - |x|^2) with M the largest squared norm, a query gets 0. Each block of candidates has a
cover tree of those points: a node's children are a net of its points at half its radius (of at most ``FAN`` points, the
first ones of a farthest-first order), and each node keeps the exact radius that covers its points. A node's
distance and radius bound the inner products of all its points from both sides. A block of queries descends best
first, together: a step takes the node that is the best open one of the most queries, for all that still need it. Nodes
outside a query's window, or below what it has found, are skipped, and points of a leaf are verified by their exact
integer products.

How it is kept in bounds:

* Blocks of about ``BLOCK`` rows are cut from cells, the nearest of at most ``CELLS`` pivots. Pivots are chosen
  farthest first from ``SAMPLE`` rows in the order of a hash; every row is indexed, none by chance. A cell of any size
  gives as many blocks as it needs, so a third of all rows at one point are many blocks.
* Queries come in blocks of about ``QUERIES`` anchors of one cell or a few. They first meet the blocks of their own
  cell. What that finds narrows their windows, and only blocks whose root can hold a point inside a window meet them
  afterwards.
* A block returns at most k rows a query; the best of them all are taken by a window over the query.

Components become floor(256 x) as integers. Rows with a null label, a null vector, or any null or non-finite component
take no part, nor do rows without an id, or with a squared norm of 2^61 or more, whose products may not fit 64 bits.
Shorter vectors are filled with zeros, an empty one is all zeros. Repeated rows (id, label and vector alike) are one row;
different rows of one id are different rows, and only the row itself is no partner of an anchor. Ties go to the smaller
id. An empty table, or one without anchors or positives, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.llm.common import staged

BLOCK, QUERIES = 2048, 1024
CELLS, SAMPLE = 64, 2048
LEAF, FAN = 64, 16
SCALE = 256
#: Squared norms up to which products and their sums are whole numbers in a double.
EXACT = 1 << 53
_LOW, _HIGH = -(1 << 62), 1 << 62


def vectors(df: DataFrame, label: Column) -> DataFrame:
    """(id, label, v, norm, uid) of the rows that take part."""
    whole = F.col("embedding").cast("array<double>")
    scaled = F.transform(whole, lambda x: F.floor(x * F.lit(float(SCALE))))
    size = F.aggregate(whole, F.lit(0.0), lambda a, x: a + x * x * float(SCALE * SCALE))
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("embedding"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    rows = rows.where(F.col("embedding").isNotNull()).where(finite & (size < float(1 << 60)))
    rows = rows.select("id", "label", scaled.alias("v"))
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    return rows.select("*", norm.alias("norm"), F.xxhash64("id", "label", "v").alias("uid")).dropDuplicates(["id", "uid"])


@contextmanager
def few_at_once(spark: SparkSession, rows: int = 4):
    """Rows that hold whole blocks go to Python few at a time; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def matrix(column: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def augmented(x: np.ndarray, most: int) -> np.ndarray:
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0.0))])


def net(points: np.ndarray, first: int, radius: float, most: int) -> tuple[list[int], np.ndarray]:
    """Farthest-first centres until they cover at ``radius``, or are ``most``; and each point's nearest."""
    centres, gap = [first], np.sqrt(((points - points[first]) ** 2).sum(1))
    nearest = np.zeros(len(points), np.int64)
    while len(centres) < most and gap.max() > radius:
        centres.append(int(gap.argmax()))
        new = np.sqrt(((points - points[centres[-1]]) ** 2).sum(1))
        closer = new < gap
        gap[closer], nearest[closer] = new[closer], len(centres) - 1
    return centres, nearest


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """An order of the points, and the nodes: centre, radius, range of points, range of children."""
    order = np.arange(len(points))
    nodes = [[0, 0.0, 0, len(points), 0, 0]]
    at = 0
    while at < len(nodes):
        centre, _, lo, hi, _, _ = nodes[at]
        own = order[lo:hi]
        here = points[own]
        radius = float(np.sqrt(((here - points[centre]) ** 2).sum(1)).max())
        nodes[at][1] = radius
        if hi - lo > LEAF and radius > 0:
            centres, nearest = net(here, int(np.flatnonzero(own == centre)[0]), radius / 2, FAN)
            nodes[at][4:] = [len(nodes), len(nodes) + len(centres)]
            start = lo
            for j, c in enumerate(centres):
                part = own[nearest == j]
                nodes.append([int(own[c]), 0.0, start, start + len(part), 0, 0])
                start += len(part)
            order[lo:hi] = own[np.argsort(nearest, kind="stable")]
        at += 1
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    columns = list(zip(*nodes))
    names = ("centre", "radius", "lo", "hi", "child", "end")
    found = {n: np.array(c, np.float64 if n == "radius" else np.int64) for n, c in zip(names, columns)}
    found["centre"] = place[found["centre"]]
    return order, found


_NODES = ("centre", "radius", "lo", "hi", "child", "end")
_TREE = "tree long, cell int, ids binary, labels binary, uids binary, vs binary, root binary, cover double, " + ", ".join(f"{n} binary" for n in _NODES)


def _built(dim: int, most: int):
    """A block's rows as one row: vectors in the order of its tree, and the tree's nodes."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("uid")
        x = matrix(block["v"], dim)
        order, nodes = cover_tree(augmented(x, most))
        ids, labels, uids = (block[c].to_numpy()[order].tobytes() for c in ("id", "label", "uid"))
        x = np.ascontiguousarray(x[order])
        root = x[nodes["centre"][0]].tobytes()
        head = (int(block["tree"].iloc[0]), int(block["cell"].iloc[0]), ids, labels, uids, x.tobytes(), root, float(nodes["radius"][0]))
        names = ["tree", "cell", "ids", "labels", "uids", "vs", "root", "cover", *_NODES]
        return pd.DataFrame([(*head, *(nodes[n].tobytes() for n in _NODES))], columns=names)

    return run


def _bounds(norms: np.ndarray, products: np.ndarray, radius: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest products that points within ``radius`` of a centre can have."""
    both = norms[:, None].astype(np.float64) + most
    gap = np.sqrt(np.maximum(both - 2.0 * products, 0.0))
    slack = both * 1e-9 + 1.0
    return (both - (gap + radius) ** 2) / 2 - slack, (both - np.maximum(gap - radius, 0.0) ** 2) / 2 + slack


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def descend(tree: dict[str, np.ndarray], q: dict[str, np.ndarray], k: int, same: bool, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query its k best rows of the tree within its window: scores (``_LOW`` for none) and ids.

    ``q`` holds anchors (v, label, uid, norm) and queries (anchor, lo, hi); partners have the anchor's label or
    another, and are never the anchor itself.
    """
    kind = np.float64 if most < EXACT else np.int64
    v, x = q["v"].astype(kind), tree["vs"].astype(kind)
    anchor, lo, hi = q["anchor"], q["lo"], q["hi"]
    products = v.astype(np.float64) @ x[tree["centre"]].astype(np.float64).T
    low, up = _bounds(q["norm"], products, tree["radius"], most)
    bound = np.where(low[anchor] <= hi[:, None], np.minimum(up[anchor], hi[:, None].astype(np.float64) + 1.0), -np.inf)
    frontier = np.full(bound.shape, -np.inf)
    frontier[:, 0] = bound[:, 0]
    best = np.full((len(anchor), k), _LOW)
    ids = np.full((len(anchor), k), np.iinfo(np.int64).max)
    every = np.arange(len(anchor))
    while True:
        least = np.maximum(lo, best[:, -1])
        node = frontier.argmax(1)
        live = frontier[every, node] >= least
        if not live.any():
            return best, ids
        n = np.bincount(node[live]).argmax()
        rows = np.flatnonzero(frontier[:, n] >= least)
        frontier[:, n] = -np.inf  # whoever does not need it now never will
        a, b = int(tree["child"][n]), int(tree["end"][n])
        if b > a:
            frontier[rows, a:b] = bound[rows, a:b]
            continue
        a, b = int(tree["lo"][n]), int(tree["hi"][n])
        used, inverse = np.unique(anchor[rows], return_inverse=True)
        found = (v[used] @ x[a:b].T).astype(np.int64)[inverse]
        own = q["label"][anchor[rows]][:, None] == tree["labels"][a:b]
        fits = (own if same else ~own) & (found >= lo[rows, None]) & (found <= hi[rows, None])
        fits &= (tree["uids"][a:b] != q["uid"][anchor[rows]][:, None]) | (tree["ids"][a:b] != q["id"][anchor[rows]][:, None])
        fits &= found >= best[rows, -1:]
        some = fits.any(1)
        if some.any():
            rows, fits, found = rows[some], fits[some], found[some]
            scores = np.column_stack([best[rows], np.where(fits, found, _LOW)])
            names = np.where(fits, tree["ids"][a:b], np.iinfo(np.int64).max)
            best[rows], ids[rows] = _best(scores, np.column_stack([ids[rows], names]), k)


_QUERY = ("uid", "id", "label", "norm", "cell", "v", "anchor", "lo", "hi", "positive_id", "positive_score", "positive")
_BLOCK = "qb long, " + ", ".join(f"q_{c} binary" for c in _QUERY)


def _asked(dim: int):
    """A block of queries as one row; queries of one anchor share its vector."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["id", "uid", "positive_id", "positive"])
        new = ~block.duplicated(["id", "uid"]).to_numpy()
        anchors = block[new]
        cells = {c: anchors[c].to_numpy().tobytes() for c in ("uid", "id", "label", "norm")}
        cells["cell"] = anchors["cell"].to_numpy(np.int64).tobytes()
        cells |= {"v": matrix(anchors["v"], dim).tobytes(), "anchor": (np.cumsum(new) - 1).astype(np.int64).tobytes()}
        cells |= {c: block[c].to_numpy(np.int64).tobytes() for c in ("lo", "hi", "positive_id", "positive_score", "positive")}
        return pd.DataFrame([(int(block["qb"].iloc[0]), *(cells[c] for c in _QUERY))], columns=["qb", *[f"q_{c}" for c in _QUERY]])

    return run


def _query(row: dict[str, bytes], dim: int) -> dict[str, np.ndarray]:
    q = {c: np.frombuffer(row[f"q_{c}"], np.int64) for c in _QUERY}
    return q | {"v": q["v"].reshape(-1, dim)}


FOUND = "id long, uid long, positive_id long, positive_score long, positive long, other_id long, score long"


def _searched(k: int, same: bool, home: bool, dim: int, most: int):
    """A row per pair of a query block and a tree: the best rows of that tree, of queries of its cell or of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = {n: np.frombuffer(row[n], np.float64 if n == "radius" else np.int64) for n in _NODES}
                tree |= {n: np.frombuffer(row[n], np.int64) for n in ("ids", "labels", "uids")}
                tree["vs"] = np.frombuffer(row["vs"], np.int64).reshape(-1, dim)
                q = _query(row, dim)
                own = (q["cell"] == row["cell"])[q["anchor"]] == home
                q |= {c: q[c][own] for c in ("anchor", "lo", "hi", "positive_id", "positive_score", "positive")}
                scores, ids = descend(tree, q, k, same, most)
                at, _ = np.nonzero(scores > _LOW)
                taken = scores > _LOW
                columns = [q["id"][q["anchor"][at]], q["uid"][q["anchor"][at]]]
                columns += [q[c][at] for c in ("positive_id", "positive_score", "positive")]
                columns += [ids[taken], scores[taken]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in FOUND.split(", ")])

    return run


def _routed(dim: int, most: int):
    """(qb, tree) where a root's bounds reach a query's window, in blocks of other cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = _query(row, dim)
                roots = np.frombuffer(b"".join(t["root"] for t in row["trees"]), np.int64).reshape(-1, dim)
                cover = np.array([t["cover"] for t in row["trees"]])
                low, up = _bounds(q["norm"], q["v"].astype(np.float64) @ roots.astype(np.float64).T, cover, most)
                other = q["cell"][:, None] != np.array([t["cell"] for t in row["trees"]])
                meets = (low[q["anchor"]] <= q["hi"][:, None]) & (up[q["anchor"]] >= q["lo"][:, None])
                meets = (meets & other[q["anchor"]]).any(0)
                trees = [row["trees"][i]["tree"] for i in np.flatnonzero(meets)]
                columns = [pa.array([row["qb"]] * len(trees), pa.int64()), pa.array(trees, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["qb", "tree"])

    return run


class Index:
    """Cover trees over all rows, staged; ``rows`` are those of ``vectors``."""

    def __init__(self, rows: DataFrame):
        self.spark: SparkSession = rows.sparkSession
        rows = staged(rows, "vectors")
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most"), F.max(F.size("v")).alias("dim")).first()
        self.count, self.most, self.dim = total["n"], total["most"] or 0, max(total["dim"] or 0, 1)
        if not self.count:
            self.rows, self.trees = rows.withColumn("cell", F.lit(0)), None
            return
        fit = rows.orderBy("uid", "id").limit(max(CELLS, min(SAMPLE, (1 << 22) // self.dim))).select("v").toPandas()
        points = augmented(matrix(fit["v"], self.dim), self.most)
        centres, _ = net(points, 0, 0.0, min(CELLS, -(-self.count // BLOCK), len(points)))
        pivots, dim, most = points[centres], self.dim, self.most

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = augmented(matrix(batch.column("v").to_pandas(), dim), most)
                gap = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
                yield batch.append_column("cell", pa.array(gap.argmin(1).astype(np.int32)))

        schema = "id long, label long, v array<long>, norm long, uid long, cell int"
        self.rows = staged(rows.mapInArrow(assigned, schema), "cells")
        dealt = self.dealt(self.rows, BLOCK, "tree")
        self.trees = staged(dealt.groupBy("tree").applyInPandas(_built(dim, most), _TREE), "trees")

    def dealt(self, rows: DataFrame, each: int, name: str, together: bool = False) -> DataFrame:
        """Adds a block's number: cells are cut by a hash into blocks of about ``each`` rows; small ones may share one."""
        found = rows.groupBy("cell").agg(F.count_distinct("id", "uid").alias("n")).orderBy("cell").collect()
        first, parts, filled = {}, {}, 0
        last = None
        for r in found:
            if together and last is not None and filled + r["n"] <= each:
                first[r["cell"]], parts[r["cell"]], filled = last, 1, filled + r["n"]
                continue
            first[r["cell"]], parts[r["cell"]] = r["cell"], -(-r["n"] // each)
            last, filled = (r["cell"], r["n"]) if r["n"] <= each else (None, 0)
        of = lambda m: F.element_at(F.create_map(*[F.lit(int(x)) for kv in m.items() for x in kv]), F.col("cell")) if m else F.lit(1)
        salt = F.pmod(F.xxhash64("uid", F.lit(name)), of(parts).cast("long"))
        return rows.withColumn(name, F.shiftleft(of(first).cast("long"), 40) + salt)

    def _met(self, blocks: DataFrame, pairs: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
        both = pairs.join(self.trees, "tree").join(blocks, "qb")
        both = both.select(*_NODES, "cell", "ids", "labels", "uids", "vs", *[f"q_{c}" for c in _QUERY])
        with few_at_once(self.spark):
            return staged(both.mapInArrow(_searched(k, same, home, self.dim, self.most), FOUND), "found")

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """The k best rows of every query (an anchor's columns, positive_id, positive_score, positive, lo, hi)."""
        spark, key = self.spark, ["id", "uid", "positive_id", "positive_score", "positive"]
        if self.trees is None:
            return spark.createDataFrame([], FOUND + ", place int")
        queries = staged(self.dealt(queries, QUERIES, "qb", together=True), "queries")
        blocks = staged(queries.groupBy("qb").applyInPandas(_asked(self.dim), _BLOCK), "asked")
        home = queries.select("qb", "cell").distinct().join(self.trees.select("tree", "cell"), "cell")
        found = self._met(blocks, home.select("qb", "tree"), k, same, True)
        down = Window.partitionBy(*key).orderBy(F.desc("score"))
        least = found.withColumn("place", F.row_number().over(down)).where(F.col("place") == k)
        least = least.select(*key, F.col("score").alias("kth"))
        narrowed = queries.join(least, key, "left").withColumn("lo", F.greatest("lo", F.coalesce("kth", F.col("lo")))).drop("kth")
        blocks = staged(narrowed.groupBy("qb").applyInPandas(_asked(self.dim), _BLOCK), "asked")
        slices = max(1, -(-self.trees.count() // 512))
        roots = self.trees.withColumn("slice", F.pmod(F.xxhash64("tree"), F.lit(slices)).cast("int"))
        roots = roots.groupBy("slice").agg(F.collect_list(F.struct("tree", "cell", "root", "cover")).alias("trees"))
        asked = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).join(roots, "slice")
        with few_at_once(spark):
            pairs = staged(asked.drop("slice").mapInArrow(_routed(self.dim, self.most), "qb long, tree long"), "pairs")
        found = found.union(self._met(blocks, pairs, k, same, False))
        best = Window.partitionBy(*key).orderBy(F.desc("score"), "other_id")
        return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows of ``vectors``.

    Anchors are the rows where ``anchors`` holds. Of each, the best rows of its own label are its positives; for each
    of those, the best rows of other labels with at least ``least_percent`` of its score and no more than it.
    """
    index = Index(rows)
    none = F.lit(0).cast("long")
    asked = index.rows.where(F.coalesce(anchors, F.lit(False))).withColumns({"positive_id": none, "positive_score": none, "positive": none})
    asked = asked.withColumns({"lo": F.lit(_LOW + 1), "hi": F.lit(_HIGH)})
    own = index.search(asked, positives, True)
    own = own.where("score >= 0").select("id", "uid", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("place").cast("long").alias("positive"))
    score, rest = F.col("positive_score"), 100 - least_percent
    share = F.expr("positive_score div 100") * rest + F.floor(score % 100 * rest / 100)
    asked = index.rows.join(own, ["id", "uid"]).withColumns({"lo": score - share, "hi": score})
    found = index.search(asked, negatives, False)
    return found.select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def rotated(every: int = 7, labels: int = 10) -> Column:
    """Every ``every``-th id has the next label."""
    label = F.col("label").cast("long")
    return F.when(F.coalesce(F.col("vec_id").cast("long") % every == 0, F.lit(False)), (label + 1) % labels).otherwise(label)


def every(n: int) -> Column:
    """Anchors whose id is divisible by n."""
    return F.col("id") % n == 0

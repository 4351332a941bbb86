"""N-gram Jaccard join with prefix filters under several global orders.

Documents are sets of hashed word shingles. Two sets of similarity t or more must share a token in their
prefixes, the first n - ceil(t n) + 1 tokens, under every global order of the tokens. The orders
used here all put rare tokens first (by the binary logarithm of their number of documents) and break
ties by different hashes. A pair becomes a candidate where it shares a prefix token under the first
order, goes on only if it does under the others too, and is then verified by exact set sizes.

How it is kept in bounds:

* Equal sets are one node from the start, however many copies there are.
* Token frequencies are counted over ranges of the token space: every task sends blocks of tokens, and a range
  returns those found in two documents or more. All others cannot be shared: they only take places in
  the prefix. Common tokens of two documents are thus all among the returned ones, so verification
  compares those and needs no text.
* Tokens of a share ``hot`` of all documents or more are found beforehand from counts per batch (at most
  2 x mean set size / ``hot`` of them can exist, whatever the input), are not sent anywhere, and
  rank last in every order.
* Pairs within a group of documents that share a token are not written out. Each is first held against the
  group's hub, the node with the largest share of tokens that others have (the original of a
  group of near copies). What links is contracted to components, and only groups that still hold several
  components give pairs, of different components alone, where the shared token stands early enough in both
  to be the first of enough common ones. The result is that of all pairs.
* Near copies of one text have nearly all tokens in common, and those tell no pair from another. Nodes of the
  groups left that resemble a hub are told apart by their differences from it, the tokens that one has and the other
  has not: two that differ much from the hub can be alike only where they differ from it in the same tokens, and two
  that differ little both link with the node that differs least. So their pairs share a difference among their rarest.

Null and empty texts, and texts of blanks alone, have no set and link with nothing. Texts with fewer words
than a shingle are one token, their whole sequence. Rows without an id take part by their text and get
the component of the others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import components, small, staged
from quipu.llm.words import mix, pieces, run_hashes

#: Bytes of a token that are sent; with its range that is over 48 bits, and only filters lose by a clash.
SENT = 6
PER_RANGE = 1_500_000
#: Tokens a task holds before it counts or sends them.
HELD = 1_000_000
#: Rank of hot tokens; others have the logarithm of their frequency.
HOT = 255
ORDERS = (np.uint64(0x1D8E4E27C47D124F), np.uint64(0xEB44ACCAB455D165), np.uint64(0x2545F4914F6CDD1D))


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for piece in pieces(column):
        words = piece.hashes()
        grams, bounds = piece.grams(words, k)
        short = np.diff(piece.bounds) < k
        whole = run_hashes(words, piece.bounds[:-1], piece.bounds[1:]) ^ np.uint64(k)
        for i in range(piece.n):
            if short[i]:
                yield whole[i : i + 1] if piece.bounds[i + 1] > piece.bounds[i] else grams[:0]
            else:
                yield np.unique(grams[bounds[i] : bounds[i + 1]])


def set_key(tokens: np.ndarray) -> int:
    """One number for a set: equal sets have equal keys."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)) if len(tokens) else 0


def sets(docs: DataFrame, k: int, hot: float) -> DataFrame:
    """(doc_id, text_key, n, node) of every row, and (token, docs) counts of tokens that are common in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, long = ["doc_id", "text_key", "n", "node", "token", "docs"], pa.int64()
        once: list[np.ndarray] = []

        def common() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(once), return_counts=True)
            often = counts >= max(2, hot / 2 * len(once))
            once.clear()
            none = pa.nulls(int(often.sum()), long)
            columns = [none, none, none, none, pa.array(found[often].view(np.int64)), pa.array(counts[often])]
            return pa.RecordBatch.from_arrays(columns, names)

        seen: set[int] = set()
        held = 0
        for batch in batches:
            sizes, keys = [], []
            for tokens in shingle_sets(batch.column(2), k):
                sizes.append(len(tokens))
                keys.append(set_key(tokens))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    once.append(tokens)
                    held += len(tokens)
                if held > HELD:
                    yield common()
                    seen.clear()
                    held = 0
            none = pa.nulls(len(sizes), long)
            whole = [*batch.columns[:2], pa.array(sizes, long), pa.array(keys, long), none, none]
            yield pa.RecordBatch.from_arrays(whole, names)
        if once:
            yield common()

    schema = "doc_id long, text_key long, n long, node long, token long, docs long"
    columns = (F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return docs.select(*columns).mapInArrow(run, schema)


def _packed(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()


def _unpacked(block: bytes) -> np.ndarray:
    out = np.zeros((len(block) // SENT, 8), np.uint8)
    out[:, :SENT] = np.frombuffer(block, np.uint8).reshape(-1, SENT)
    return out.view("<u8").ravel()


def _blocks(part: np.ndarray, node: np.ndarray, token: np.ndarray, rank: np.ndarray | None) -> Iterator[tuple]:
    """(part, nodes, number of tokens of each, tokens, ranks, no size) of rows sorted by part and node."""
    bounds = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *bounds], [*bounds, len(part)]):
        if a == b:
            continue
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(node[a:b])) + 1, [b - a]])
        counts = np.diff(cuts).astype("<u4").tobytes()
        ranks = rank[a:b].tobytes() if rank is not None else None
        yield int(part[a]), node[a:b][cuts[:-1]].tobytes(), counts, _packed(token[a:b]), ranks, None


#: Blocks of one node carry its set size, blocks of a range of tokens do not.
BLOCK = "part int, nodes binary, counts binary, tokens binary, ranks binary, size long"
_BINARY = ("nodes", "counts", "tokens", "ranks")
_BLOCK = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in _BINARY], ("size", pa.int64())])


def _batch(blocks: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*blocks), _BLOCK)]
    return pa.RecordBatch.from_arrays(columns, schema=_BLOCK)


def _sent(docs: DataFrame, k: int, ranges: int, hot: np.ndarray) -> DataFrame:
    """Blocks of tokens by range; and, as parts from ``ranges`` on, each node's size and hot tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        nodes: list[int] = []
        found: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not nodes:
                return
            node = np.repeat(np.array(nodes, np.int64), [len(x) for x in found])
            token = np.concatenate(found)
            common = np.isin(token, hot)
            cold = np.flatnonzero(~common)
            part = ((token[cold] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            cold = cold[np.argsort(part, kind="stable")]
            part.sort()
            blocks = list(_blocks(part, node[cold], token[cold], None))
            for i, x in enumerate(nodes):
                own = found[i][np.isin(found[i], hot)] if len(hot) else found[i][:0]
                count = np.array([len(own)], "<u4").tobytes()
                ranks = np.full(len(own), HOT, np.uint8).tobytes()
                key = np.int64(x).tobytes()
                blocks.append((ranges + x % ranges, key, count, _packed(own), ranks, len(found[i])))
            yield _batch(blocks)
            nodes.clear()
            found.clear()

        held = 0
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), k):
                if not len(tokens) or (node := set_key(tokens)) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(node)
                nodes.append(node)
                found.append(tokens)
                held += len(tokens)
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.select("text").mapInArrow(run, BLOCK)


def _counted(ranges: int):
    """For one range of tokens: those of two nodes or more, by node, with the class of their frequency."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        part = int(block["part"].iloc[0])
        if part >= ranges:  # sizes and hot tokens go on as they are, once a node
            return block.drop_duplicates("nodes").assign(part=part - ranges)
        nodes = [np.frombuffer(x, "<i8") for x in block["nodes"]]
        counts = [np.frombuffer(x, "<u4") for x in block["counts"]]
        node = np.concatenate([np.repeat(a, b) for a, b in zip(nodes, counts)])
        token = np.concatenate([_unpacked(x) for x in block["tokens"]])
        order = np.lexsort((node, token))
        node, token = node[order], token[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        node, token = node[new], token[new]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1, [len(token)]]).astype(np.int64)
        each = np.repeat(np.diff(cuts), np.diff(cuts))
        shared = each > 1
        node, token = node[shared], token[shared]
        rank = np.log2(each[shared]).astype(np.uint8)
        to = node % ranges
        order = np.lexsort((node, to))
        blocks = list(_blocks(to[order], node[order], token[order], rank[order]))
        return pd.DataFrame(blocks, columns=_BLOCK.names).astype({"size": "Int64"})

    return run


CANDIDATE = "node long, n long, tokens array<long>, " + ", ".join(f"prefix{i} array<long>" for i in range(len(ORDERS)))


def _prefixed(percent: int):
    """For some nodes: those whose prefix holds a token that another node has too."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        size: dict[int, int] = {}
        nodes, tokens, ranks = [], [], []
        for row in block.rename(columns={"size": "n"}).itertuples(index=False):
            own, counts = np.frombuffer(row.nodes, "<i8"), np.frombuffer(row.counts, "<u4")
            found = _unpacked(row.tokens)
            if not pd.isna(row.n):
                size[int(own[0])] = int(row.n)
            nodes.append(np.repeat(own, counts))
            tokens.append(found)
            ranks.append(np.frombuffer(row.ranks, np.uint8))
        node, token, rank = np.concatenate(nodes), np.concatenate(tokens), np.concatenate(ranks)
        order = np.lexsort((token, node))
        node, token, rank = node[order], token[order], rank[order]
        out = []
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1, [len(node)]]).astype(np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            n = size[int(node[a])]
            prefix = n - -(-n * percent // 100) + 1 - (n - (b - a))  # what unshared tokens leave of it
            if prefix <= 0:
                continue
            own, kind = token[a:b], rank[a:b]
            firsts = [own[np.lexsort((mix(own ^ o), kind))[:prefix]].view(np.int64) for o in ORDERS]
            out.append((int(node[a]), n, own.view(np.int64), *firsts))
        names = ["node", "n", "tokens", *(f"prefix{i}" for i in range(len(ORDERS)))]
        return pd.DataFrame(out, columns=names)

    return run


def candidates(docs: DataFrame, k: int, percent: int, hot: float, found: DataFrame) -> DataFrame:
    """Nodes that may link, with their shared tokens and their prefixes under each order."""
    spark = docs.sparkSession
    whole = found.where("node is not null")
    total = whole.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")).first()
    ranges = max(16, -(-(total["tokens"] or 0) // PER_RANGE))
    common = found.where("token is not null").groupBy("token").agg(F.sum("docs").alias("docs"))
    common = common.where(F.col("docs") >= max(2.0, hot / 2 * total["docs"]))
    often = np.sort(np.array([r["token"] for r in common.select("token").collect()], np.int64).view(np.uint64))
    table = spark.sparkContext.broadcast(often)
    blocks = _sent(docs, k, ranges, table.value)
    counted = blocks.groupBy("part").applyInPandas(_counted(ranges), BLOCK)
    return counted.groupBy("part").applyInPandas(_prefixed(percent), CANDIDATE)


def _links(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the other orders' filters and have the similarity, by exact counts."""
    left = nodes.select(*[F.col(c).alias(f"x_{c}") for c in nodes.columns])
    right = nodes.select(*[F.col(c).alias(f"y_{c}") for c in nodes.columns])
    both = pairs.join(left, pairs.x == F.col("x_node")).join(right, pairs.y == F.col("y_node"))
    both = both.where(F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent)
    for i in range(1, len(ORDERS)):
        both = both.where(F.arrays_overlap(f"x_prefix{i}", f"y_prefix{i}"))
    common = F.size(F.array_intersect("x_tokens", "y_tokens"))
    return both.where(common * (100 + percent) >= (F.col("x_n") + F.col("y_n")) * percent).select("x", "y")


def _close(x: str, y: str, percent: int) -> Column:
    """Whether two entries of one token can belong to a pair that links and shares no token before.

    The first common token of such a pair stands so early in both that enough tokens follow.
    """
    xn, yn = F.col(f"{x}n"), F.col(f"{y}n")
    need = F.ceil((xn + yn) * percent / (100.0 + percent) - 1e-9)
    sizes = (xn * 100 >= yn * percent) & (yn * 100 >= xn * percent)
    return sizes & (F.col(f"{x}pos") <= xn - need) & (F.col(f"{y}pos") <= yn - need)


def _told(open_: DataFrame, hubs: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(node, n, root, hub, size, d, tokens): nodes told apart by the tokens in which they and a hub differ.

    All hubs of one component give way to the best of them. ``size`` counts all differences, ``tokens`` are those that
    others can have too; only nodes with fewer differences than tokens are told so. Two nodes differ in at most as
    many tokens as both from the hub, so they link where the sum of their ``d`` is 0 or less.
    """
    best = open_.join(hubs, "token").groupBy("node", "n", "root").agg(F.max(F.struct("hshared", "hnode")).alias("best"))
    best = best.join(roots.select(F.col("node").alias("__hub"), F.col("root").alias("of")), F.col("best.hnode") == F.col("__hub"), "left")
    best = best.select("node", "n", "root", "best", F.coalesce("of", "best.hnode").alias("of"))
    ruling = best.groupBy("of").agg(F.max("best").alias("best")).select("of", F.col("best.hnode").alias("hub"))
    own = best.drop("best").join(ruling, "of").join(nodes.select("node", "tokens"), "node")
    both = own.join(nodes.select(F.col("node").alias("hub"), F.col("tokens").alias("theirs")), "hub")
    unlike = F.concat(F.array_except("tokens", "theirs"), F.array_except("theirs", "tokens"))
    size = F.col("n") - F.size("tokens") + F.size("unlike")
    told = both.withColumn("unlike", unlike).withColumn("size", size).where("size <= n")
    d = F.col("size") * (100 + percent) - F.col("n") * (100 - percent)
    return told.select("node", "n", "root", "hub", "size", d.alias("d"), F.col("unlike").alias("tokens"))


def _apart(told: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub that may link, of different components: each with the least different node, and those that share
    one of their rarest differences, early enough in both to be the first of as many as they must share."""
    least = told.groupBy("hub").agg(F.min(F.struct("d", "node", "root")).alias("m"))
    held = told.join(least, "hub")
    near = held.where((F.col("d") + F.col("m.d") <= 0) & (F.col("root") != F.col("m.root")))
    near = near.select(F.least("node", "m.node").alias("x"), F.greatest("node", "m.node").alias("y"))

    def shared(d: Column, e: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil((d + e) / (2.0 * (100 + percent)) - 1e-9))

    each = held.select("hub", "node", "n", "root", "size", "d", F.col("m.d").alias("least"), F.explode("tokens").alias("token"))
    often = each.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    each = each.join(often, ["hub", "token"])
    alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "token"))
    each = each.withColumn("pos", alone + place - 1).where(F.col("pos") <= F.col("size") - shared(F.col("d"), F.col("least")))
    each = staged(each.select("hub", "token", "node", "n", "root", "size", "d", "pos"), "unlike")
    a, b = (each.select("hub", "token", *[F.col(c).alias(f"{s}{c}") for c in ("node", "n", "root", "size", "d", "pos")]) for s in "xy")
    must = shared(F.col("xd"), F.col("yd"))
    early = (F.col("xpos") <= F.col("xsize") - must) & (F.col("ypos") <= F.col("ysize") - must)
    sizes = (F.col("xn") * 100 >= F.col("yn") * percent) & (F.col("yn") * 100 >= F.col("xn") * percent)
    far = (F.col("xroot") < F.col("yroot")) & (F.col("xd") + F.col("yd") > 0) & sizes & early
    pairs = a.join(b, ["hub", "token"]).where(far)
    return near.union(pairs.select(F.least("xnode", "ynode").alias("x"), F.greatest("xnode", "ynode").alias("y")))


def _others(open_: DataFrame, told: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that share an early token and are not told apart from the same hub.

    Most of a token's nodes have the same hub; only the others are held against all.
    """
    named = open_.join(told.select("node", "hub"), "node", "left")
    counts = named.where("hub is not null").groupBy("token", "hub").agg(F.count(F.lit(1)).alias("times"))
    ruling = counts.groupBy("token").agg(F.max(F.struct("times", "hub")).alias("r")).select("token", F.col("r.hub").alias("ruling"))
    named = named.join(ruling, "token", "left").withColumn("other", ~F.coalesce(F.col("hub") == F.col("ruling"), F.lit(False)))
    a, b = (named.select("token", *[F.col(c).alias(f"{s}{c}") for c in ("node", "n", "pos", "root", "hub", "other")]) for s in "xy")
    once = F.when(F.col("yother"), F.col("xroot") < F.col("yroot")).otherwise(F.col("xroot") != F.col("yroot"))
    apart = ~F.coalesce(F.col("xhub") == F.col("yhub"), F.lit(False))
    across = a.where("xother").join(b, "token").where(once & apart & _close("x", "y", percent))
    return across.select(F.least("xnode", "ynode").alias("x"), F.greatest("xnode", "ynode").alias("y"))


def linked(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, root): components of the candidates' links."""
    alone = F.col("n") - F.size("tokens")  # tokens of no other node stand first in every order
    index = nodes.select("node", "n", (-alone / F.col("n")).alias("shared"), alone.alias("alone"), F.posexplode("prefix0").alias("at", "token"))
    index = staged(index.select("node", "n", "shared", "token", (F.col("at") + F.col("alone")).alias("pos")), "index")
    hubs = index.groupBy("token").agg(F.max(F.struct("shared", "node", "n", "pos")).alias("h"), F.count(F.lit(1)).alias("times"))
    hubs = hubs.where("times > 1").select("token", *[F.col(f"h.{c}").alias(f"h{c}") for c in ("shared", "node", "n", "pos")])
    near = index.select("token", *[F.col(c).alias(f"x{c}") for c in ("node", "n", "pos")]).join(hubs, "token")
    near = near.where((F.col("xnode") != F.col("hnode")) & _close("x", "h", percent))
    pairs = near.select(F.least("xnode", "hnode").alias("x"), F.greatest("xnode", "hnode").alias("y")).distinct()
    found = staged(_links(pairs, nodes, percent), "links")
    roots = components(found)
    named = index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    open_ = staged(named.join(mixed.select("token"), "token", "left_semi"), "open")
    told = staged(_told(open_, hubs, nodes, roots, percent), "told")
    across = _apart(told, percent).union(_others(open_, told, percent)).distinct()
    more = staged(_links(across, nodes, percent), "links")
    if more.isEmpty():
        return roots
    return components(found.union(more))


def grouped(docs: DataFrame, k: int, percent: int, hot: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, n, node) of every row, and (node, root) of every node with a set."""
    found = staged(sets(docs, k, hot), "sets")
    nodes = staged(candidates(docs, k, percent, hot, found), "candidates")
    roots = linked(nodes, percent)
    rows = found.where("node is not null").select("doc_id", "text_key", "n", "node")
    whole = rows.where("n > 0").select("node").distinct()
    return rows, whole.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def join(docs: DataFrame, k: int = 5, percent: int = 80, hot: float = 0.005) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; links at ``percent`` or more."""
    rows, roots = grouped(docs, k, percent, hot)
    low = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(roots, "node")
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    named = low.join(least, "root").select("node", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80, hot: float = 0.005) -> DataFrame:
    """One row of each component, that with the smallest id (then text key); columns as before.

    Rows without words link with nothing and stay. Repeated rows of one id and text are one document.
    """
    rows, roots = grouped(docs, k, percent, hot)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    low = rows.where("n > 0").groupBy("node").agg(F.min(key).alias("low")).join(roots, "node")
    least = low.groupBy("root").agg(F.min("low").alias("least"))
    chosen = low.join(least, "root").select("node", "least")
    judged = rows.where("n > 0").join(chosen, "node").select("doc_id", "text_key", (key != F.col("least")).alias("gone"))
    counted = judged.groupBy("doc_id", "text_key").agg(F.max("gone").alias("gone"), F.count(F.lit(1)).alias("times"))
    counted = staged(counted.where("gone or times > 1"), "removed")
    gone, twice = (
        counted.where(x).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        for x in ("gone or times > 1", "not gone and times > 1")
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    once = docs.join(small(gone), same, "left_anti")
    if twice.isEmpty():
        return once
    again = docs.join(twice, same).dropDuplicates(["__id", "__key"])
    return once.unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))

"""Merkle manifest, min-max groups and hard negatives against plain Python."""

import hashlib
import random
import re
import zlib
from math import floor, isfinite

import numpy as np
import pytest

from quipu.llm import merkle, minmax, negatives

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    fields = (row[c] for c in merkle.FIELDS)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes, fanout):
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def manifest(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r | {"leaf": leaf(r)})
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
    trees = {g: tree([r["leaf"] for r in groups[g]], fanout) for g in names}
    top = tree([trees[g][-1][0] for g in names], fanout)
    out = []
    for i, g in enumerate(names):
        for j, r in enumerate(groups[g]):
            tampered = dict(r)
            if r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                tampered["n_chars"] += 1
            value, siblings = leaf(tampered), []
            for levels, place in ((trees[g], j), (top, i)):
                for level in levels[:-1]:
                    start = place // fanout * fanout
                    run, slot = level[start : start + fanout], place - start
                    siblings += run[:slot] + run[slot + 1 :]
                    value = digest("".join(run[:slot] + [value] + run[slot + 1 :]))
                    place //= fanout
            root = top[-1][0]
            out.append((r["doc_id"], r["leaf"], trees[g][-1][0], root, digest("".join(siblings)), value, value == root))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, root string, value binary"


def documents(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, "é" * rng.randrange(9), rng.choice(["en", "en", "es", "", None]), None, rng.randrange(99), "x", b"y") for i in range(n)]
    odd = [(None, None, None, None, None, None, None), (3, "x" * 200_000, "en", "s", 2**63 - 1, None, None)]
    return rows + odd + odd + rows[:3]


@pytest.mark.parametrize("fanout", [2, 3, 7])
def test_manifest(spark, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "SPAN", 9)  # several tiers
    docs = spark.createDataFrame(documents(150), DOCS)
    found = merkle.manifest(docs, merkle.one_more(docs), fanout=fanout).collect()
    assert sorted((tuple(r) for r in found), key=str) == manifest([r.asDict() for r in docs.collect()], fanout)
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1])
def test_manifest_of_next_to_nothing(spark, n):
    docs = spark.createDataFrame([(5, "a", None, None, None, None, None)][:n], DOCS)
    found = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert found == manifest([r.asDict() for r in docs.collect()], 2)


def test_states_are_those_of_sha256():
    texts = [hashlib.sha256(bytes([i])).digest() for i in range(7)]
    state = merkle.fresh(1)
    for n, t in enumerate(texts, 1):
        state = merkle.absorb(state, merkle._words(np.frombuffer(t, np.uint8)))
        whole = digest("".join(x.hex() for x in texts[:n]))
        assert merkle._bytes(merkle.finish(state, np.array([n])))[0].as_py().hex() == whole


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def classes(rows, percent):
    sets = [shingles(t) for _, t in rows]
    low = {i: i for i in range(len(rows))}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low[top(i)] = top(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[top(i)] = min(doc, ids.get(top(i), doc))
    return sorted((doc, len(s), ids.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets)) if doc is not None)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = str(rng.randrange(10**9))
        yield " ".join(words)


def test_groups_by_min_max(spark):
    rng = random.Random(7)
    texts = [None, "", " \n", "a", "A", "a b", "a b c d e", "A b\tc D e", "x " * 3000]
    for size in (30, 200, 200, 400):
        base = " ".join(str(rng.randrange(5000)) for _ in range(size))
        texts += [base, base.upper(), *near_copies(rng, base, 25, 1), *near_copies(rng, base, 12, 3), *near_copies(rng, base, 6, 8)]
    rng.shuffle(texts)
    rows = [(900 - i, t) for i, t in enumerate(texts)] + [(900, texts[0]), (None, "a b c d e"), (None, None)]
    docs = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, extra string, node long")
    found = minmax.grouped(docs).where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert minmax.grouped(docs.limit(0)).count() == 0


def test_chains_lose_no_link(spark):
    """Neighbours link, ends do not, so that a bucket's hub does not settle it."""
    rng = random.Random(3)
    rows = []
    for c in range(6):
        words = [str(rng.randrange(10**6)) for _ in range(300)]
        for i in range(12):
            rows.append((len(rows), " ".join(words)))
            for j in rng.sample(range(300), 2):
                words[j] = str(rng.randrange(10**6))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minmax.grouped(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 85)


def test_copies_too_far_from_their_original(spark):
    """Copies that do not link with the original, some of which link with each other."""
    rng = random.Random(4)
    base = " ".join(str(rng.randrange(10**6)) for _ in range(150))
    texts = [base, *near_copies(rng, base, 15, 1)]
    for far in near_copies(rng, base, 25, 5):
        texts += [far, *near_copies(rng, far, rng.randrange(2), 1)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minmax.grouped(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == classes(rows, 85)


def test_estimate_is_unbiased_and_varies_less():
    rng = np.random.default_rng(5)
    errors, minima = [], []
    for _ in range(150):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
        a, b = (np.unique(x) for x in (pool[:240], pool[60:]))
        x, y = minmax.signatures([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((x == y).mean() - true)
        minima.append((x == y)[0::2].mean() - true)
    assert abs(np.mean(errors)) < 0.015
    assert np.var(errors) < 0.75 * np.var(minima)


EMBEDDINGS = "vec_id long, embedding array<float>, label int, v string, cell string"


def negatives_of(rows):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        kept[(i, label, tuple(floor(256 * float(np.float32(x))) for x in v))] = None
    kept = list(kept)

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    out = []
    for a in kept:
        if a[0] % 100:
            continue
        ranked = sorted(((score(a, b), b) for b in kept if b is not a), key=lambda x: (-x[0], x[1][0]))
        for p, b in [x for x in ranked if x[1][1] == a[1]][:5]:
            fits = [(s, c[0]) for s, c in ranked if c[1] != a[1] and 80 * p <= 100 * s <= 100 * p][:5]
            out += [(a[0], b[0], r, n, p, s) for r, (s, n) in enumerate(fits, 1)]
    return sorted(out)


def embeddings(n, seed=2):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, 6))
    rows = []
    for i in range(n):
        v = (middles[rng.integers(12)] + 0.3 * rng.normal(size=6) * (i % 3)).tolist()
        rows.append((i, v, int(rng.integers(10)), "v", "c"))
    odd = [(n, None, 1), (n + 1, [1.0, None], 1), (n + 2, [float("nan")], 1), (n + 3, [float("inf")], 2), (None, [1.0], 1)]
    odd += [(n + 4, [1.0], None), (n + 5, [], 3), (n + 6, [0.5, 0.25], 3), (100, [1.0] * 6, 2)]
    return rows + [(*r, None, None) for r in odd] + rows[:40]


@pytest.mark.parametrize("block, leaf, fan", [(40, 4, 3), (2048, 64, 16)])
def test_hard_negatives(spark, monkeypatch, block, leaf, fan):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "QUERIES", 2)
    rows = embeddings(700)
    df = spark.createDataFrame(rows, EMBEDDINGS)
    found = negatives.mine(negatives.vectors(df, negatives.rotated()), negatives.every(100)).collect()
    want = negatives_of(rows)
    assert sorted(tuple(r) for r in found) == want and len(want) > 50


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(embeddings(5), EMBEDDINGS)
    for part in (df.limit(0), df.where("label is null"), df.where("vec_id < 3")):
        assert negatives.mine(negatives.vectors(part, negatives.rotated()), negatives.every(100)).count() == 0


def test_one_point_many_times(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 30)
    rows = [(i, [0.5, 0.5], i % 4, None, None) for i in range(150)] + [(i, [0.5, 0.4], 9, None, None) for i in range(150, 301)]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    found = negatives.mine(negatives.vectors(df, negatives.rotated()), negatives.every(100)).collect()
    assert sorted(tuple(r) for r in found) == negatives_of(rows)


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    points = negatives.augmented(rng.integers(-99, 99, (900, 5)), 50_000)
    order, nodes = negatives.cover_tree(points)
    points = points[order]
    assert sorted(order.tolist()) == list(range(900))
    covered = np.zeros(900, int)
    for c, r, lo, hi, child, end in zip(*(nodes[n] for n in ("centre", "radius", "lo", "hi", "child", "end"))):
        assert np.sqrt(((points[lo:hi] - points[c]) ** 2).sum(1)).max() <= r + 1e-9 and lo <= c < hi
        if end > child:
            assert nodes["lo"][child] == lo and nodes["hi"][end - 1] == hi
        else:
            covered[lo:hi] += 1
    assert (covered == 1).all()

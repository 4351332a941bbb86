"""The pipeline over small tables, each stage against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quipu.llm import secrets
from quipu.llm.queries import byte_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, words=lower):
    own = WORD.findall(words(text or ""))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def normal(line):
    return " ".join(WORD.findall(lower(line)))


def cleaned(docs):
    """(doc_id, text) of the documents that pass the rules, without their boilerplate lines."""
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, text, source in docs:
        hosts[source or ""].add(text)
        for line in (text or "").split("\n"):
            texts[source or "", normal(line)].add(text)
    out = []
    for doc, text, source in docs:
        own = WORD.findall(text or "")
        grams = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
        cover = {p for i in range(len(own) - 7) if grams[tuple(own[i : i + 8])] > 1 for p in range(i, i + 8)}
        limit = max(10, 0.01 * len(hosts[source or ""]))
        lines = (text or "").split("\n")
        left = [x for x in lines if not normal(x) or len(texts[source or "", normal(x)]) <= limit]
        n = sum(len(WORD.findall(x)) for x in left)
        if len(own) >= 20 and 100 * len(cover) <= 30 * len(own) and 100 * n >= 30 * len(own):
            out.append((doc, "\n".join(left)))
    return out


def deduplicated(docs):
    """(doc_id, text) with the smallest id of every component of similar texts."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for g in own:
            holders[g].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        for j, n in Counter(j for g in own for j in holders[g] if j < i).items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(docs)):
        least[find(i)] = min(least.get(find(i), docs[i]), docs[i])
    return list(least.values())


def uncontaminated(docs, items):
    tests = [own for t in items if (own := shingles(t, str.lower))]
    return [(d, t) for d, t in docs if not any(100 * len(shingles(t, str.lower) & q) >= 80 * len(q) for q in tests)]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_each_stage_is_that_of_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    good = STAGES["quality_rules"](spark, docs, sf)
    assert good.columns == docs.columns and sorted(pairs(good)) == sorted(cleaned(rows))
    single = STAGES["ngram_jaccard_join"](spark, good, sf)
    assert single.columns == docs.columns and sorted(pairs(single)) == sorted(deduplicated(pairs(good)))
    clean = STAGES["benchmark_decontamination"](spark, single, sf)
    assert clean.columns == docs.columns and sorted(pairs(clean)) == sorted(uncontaminated(pairs(single), items))

    found = defaultdict(set)
    for r in secrets.findings(clean).where("secret").collect():
        found[r.doc_id].add(r.value)
    masked = STAGES["secret_scan"](spark, clean, sf)
    want = []
    for doc, text in pairs(clean):
        for value in sorted(found[doc], reverse=True):
            text = text.replace(value, secrets.MASK)
        want.append((doc, text))
    assert found and masked.columns == docs.columns and sorted(pairs(masked)) == sorted(want)

    encoder = Tokenizer.from_file(byte_vocabulary())
    ids = {doc: [*encoder.encode(t, add_special_tokens=False).ids, 0] for doc, t in want}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == set(ids)
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))


LONG = " ".join(f"word{i}" for i in range(30_000))
ODD = [
    (None, None, None, None, None),
    (1, None, "h", "e", None),
    (2, "", None, None, 0),
    (3, " \n\t", "h", "e", 3),
    (4, LONG, "h", "e", 5),
    (4, LONG, "h", "e", 5),
    (None, LONG + " and its own end", "h", "e", 5),
    (6, "x" * 200_000 + "1", "h", "e", 5),
    (7, "one two three", "h", "e", 5),
    (8, " ".join(f"other{i}" for i in range(40)) + "\npassword = 'aB3dE6gH9jK2mN5p'", "h", "e", 5),
]


@pytest.mark.parametrize("name", [n for n in STAGES])
def test_stages_take_odd_rows_and_clashing_columns(spark, sf, name):
    more = ["node", "root", "host", "row", "line", "text_key", "shingles", "part", "value", "start", "length", "key", "n"]
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string, lang string, n_chars long")
    wide = docs.select("*", *[F.lit(c).alias(c) for c in more])
    plain, out = STAGES[name](spark, docs, sf), STAGES[name](spark, wide, sf)
    none = STAGES[name](spark, wide.limit(0), sf)
    assert none.count() == 0
    if name != "best_fit_packing":
        assert out.columns == none.columns == wide.columns
        out = out.select(*docs.columns)
    key = lambda r: tuple((x is not None, x) for x in r)
    kept = sorted(map(tuple, plain.collect()), key=lambda r: str(key(r)))
    if name != "best_fit_packing":
        assert kept == sorted(map(tuple, out.collect()), key=lambda r: str(key(r)))
    ids = Counter(r[0] for r in kept)
    want = {
        "quality_rules": {4: 2, None: 1, 8: 1},
        "ngram_jaccard_join": {4: 1, None: 1, 1: 1, 2: 1, 3: 1, 6: 1, 7: 1, 8: 1},
        "benchmark_decontamination": Counter(r[0] for r in ODD),
        "secret_scan": Counter(r[0] for r in ODD),
    }
    assert name == "best_fit_packing" and set(ids) == {r[0] for r in ODD} or ids == want[name]
    if name == "secret_scan":
        text = next(r[1] for r in kept if r[0] == 8)
        assert "aB3dE6gH9jK2mN5p" not in text and secrets.MASK in text

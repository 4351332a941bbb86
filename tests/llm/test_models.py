"""Joins, searches, the language model, secrets and tool calls against plain Python."""

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.llm import contain, jaccard, language, queries, secrets, tools

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, n_chars long, node string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    own = WORD.findall(lower(text))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def copies(seed):
    random.seed(seed)
    texts = []
    for _ in range(12):
        base = [f"w{random.randrange(400)}" for _ in range(random.choice([3, 30, 90]))]
        for _ in range(random.choice([1, 4, 12])):
            own = list(base)
            for _ in range(random.choice([0, 1, 2, 3])):
                own[random.randrange(len(own))] = f"n{random.randrange(10**6)}"
            texts.append(" ".join(own).upper() if random.random() < 0.3 else " ".join(own))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{random.randrange(10**6)}" for _ in range(random.randrange(3, 9))) for _ in range(25)]
    return [*texts, None, "", " \n", texts[0], "one two", "One  two"]


def components(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        least[find(i)].append(doc)
    return {doc: (len(sets[i]), min(least[find(i)])) for i, (doc, _) in enumerate(docs)}


@pytest.mark.parametrize("seed, hot", [(1, 0.005), (2, 0.3)])
def test_components_of_similar_texts(spark, seed, hot):
    data = list(enumerate(copies(seed)))
    docs = spark.createDataFrame([(i, t, "s", 0, "x") for i, t in data], DOCS)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, hot=hot).collect()}
    want = components(data)
    assert found == want
    left = jaccard.deduplicated(docs.union(docs.limit(3)), hot=hot)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if want[r.doc_id][0]) == sorted(
        {c for i, (n, c) in want.items() if n}
    )


def test_join_of_no_rows(spark):
    assert jaccard.join(spark.createDataFrame([], DOCS)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d e f", None, None, None), (4, "a b c d e f", "s", 1, "y")], DOCS)
    assert {r.component_id for r in jaccard.join(alone).collect()} == {4}


def test_contained_items(spark):
    random.seed(4)
    items = [(i, " ".join(f"w{random.randrange(90)}" for _ in range(random.choice([6, 12, 40])))) for i in range(20)]
    items += [(90, "just three words"), (91, None), (92, "")]
    docs = []
    for i in range(60):
        own = [f"d{random.randrange(5000)}" for _ in range(random.choice([5, 100, 3000]))]
        part = WORD.findall(items[i % 20][1])
        if i % 3 == 0 and len(part) > 20:
            part[random.randrange(len(part))] = "changed"
        at = random.randrange(len(own))
        docs.append((i, " ".join(own[:at] + (part if i % 4 else part[: len(part) // 2]) + own[at:])))
    docs += [(100, "Just  THREE words"), (101, None), (102, ""), (103, docs[1][1]), (None, docs[1][1])]
    frame = spark.createDataFrame([(i, t, "s", 0, "x") for i, t in docs], DOCS)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.shared, r.item_size) for r in contain.search(frame, tests).collect()}
    want = {}
    for d, t in docs:
        for q, item in items:
            a, b = shingles(t), shingles(item)
            if b and 100 * len(a & b) >= 80 * len(b):
                want[d, q] = (len(a & b), len(b))
    assert found == want and want
    kept = contain.clean(frame, tests)
    leaks = {d for d, _ in want}
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - leaks
    assert contain.search(frame.limit(0), tests).count() == contain.search(frame, tests.limit(0)).count() == 0


def test_kneser_ney(spark):
    random.seed(6)
    vocabulary = [f"v{i}" for i in range(30)]
    texts = [" ".join(random.choice(vocabulary[: random.choice([3, 30])]) for _ in range(random.randrange(40))) for _ in range(60)]
    data = [*enumerate([*texts, None, "", "Never seen"]), (None, "v1 v2")]
    docs = spark.createDataFrame([(i, t, "s", 0, "x") for i, t in data], DOCS)
    own = lambda t: [*WORD.findall(lower(t)), None]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    train = [own(t) for d, t in data if not out(d)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([0, *t[:-1]], t))
    kinds = Counter(w for _, w in two)
    tails = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    high, low = ([0, *language.discounts(tails(c))] for c in (two, kinds))
    total, first = Counter(), defaultdict(lambda: [0, 0, 0])
    for (v, _), n in two.items():
        total[v] += n
        first[v][min(n, 3) - 1] += 1
    rest = sum(low[min(n, 3)] for n in kinds.values()) / len(two)

    def p(v, w):
        below = max(kinds[w] - low[min(kinds[w], 3)], 0) / len(two) + rest / (len(one) + 1)
        if not total[v]:
            return below
        n = two[v, w]
        free = sum(d * k for d, k in zip(high[1:], first[v])) / total[v]
        return max(n - high[min(n, 3)], 0) / total[v] + free * below

    assert abs(sum(p("v1", w) for w in one) + p("v1", "unseen") - 1) < 1e-9
    tokens = sum(one.values())
    rows = {r.doc_id: r for r in language.score(docs).collect()}
    for d, t in data:
        line, r = own(t), rows[d]
        assert math.isclose(r.score, sum(math.log10(p(v, w)) for v, w in zip([0, *line[:-1]], line)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((one[w] + 1) / (tokens + len(one) + 1)) for w in line), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(line), sum(one[w] > 0 for w in line), tokens)
        assert r.held_out == out(d)
    assert language.score(docs.limit(0)).count() == 0


def test_secrets(spark):
    random.seed(8)
    word = lambda: random.choice("the of and with house river stone table light".split())
    hexes = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    data, planted, plain = [], set(), set()
    for i in range(120):
        kind = i % 4
        value = hexes(40) if kind == 0 else "AKIA" + "".join(random.choice("ABCDEFGHIJ234567") for _ in range(16))
        value = "".join(random.choice("0123456789") for _ in range(16)) if kind > 1 else value
        shown = f'token = "{value}"' if kind == 0 else value
        data.append((i, " ".join([*(word() for _ in range(9)), shown, *(word() for _ in range(9))]), "s", 0, "x"))
        (planted if kind < 2 else plain).add((i, value))
    data += [(200, None, None, None, None), (201, "", "s", 0, ""), (None, 'password="a1b2c3d4e5f6a7b8" x', "s", 0, "")]
    docs = spark.createDataFrame(data, DOCS)
    found = secrets.findings(docs).collect()
    texts = {d[0]: d[1] for d in data}
    assert all(texts[r.doc_id][r.start : r.start + len(r.value)] == r.value for r in found)
    assert planted <= {(r.doc_id, r.value) for r in found if r.secret}
    assert not plain & {(r.doc_id, r.value) for r in found if r.secret}
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == len(data)
    after = {r.doc_id: r for r in clean.collect()}
    assert not any(v in after[d].text for d, v in planted) and all(v in after[d].text for d, v in plain)
    assert after[0].n_chars == len(after[0].text) and after[200].text is None
    assert secrets.findings(docs.limit(0)).count() == 0


def test_assigned_values_of_any_characters(spark):
    random.seed(9)
    word = lambda: random.choice("the of and with house river stone table light".split())
    some = lambda chars, n: "".join(random.choice(chars) for _ in range(n))
    secret = [
        ('password = "P@ssw0rd!2024"', "P@ssw0rd!2024"),
        ("pwd: hunt3r!", "hunt3r!"),
        ("app_password='qzxwvkjhgfpmbnty'", "qzxwvkjhgfpmbnty"),
        ("{'token': 'Zk Qv#9 pX'}", "Zk Qv#9 pX"),
        ("Authorization: Bearer zqXwVkJhGfPmBn", "zqXwVkJhGfPmBn"),
    ]
    data = []
    for i in range(200):
        shown = secret[i][0] if i < len(secret) else f'secret = "{some("abcdef0123456789", 40)}"' if i % 2 else some("0123456789", 16)
        data.append((i, " ".join([*(word() for _ in range(9)), shown, *(word() for _ in range(9))]), "s", 0, "x"))
    docs = spark.createDataFrame(data, DOCS)
    found = secrets.findings(docs).collect()
    assert all(data[r.doc_id][1][r.start : r.start + len(r.value)] == r.value for r in found)
    assert {(i, v) for i, (_, v) in enumerate(secret)} <= {(r.doc_id, r.value) for r in found if r.secret}
    after = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert not any(v in after[i] for i, (_, v) in enumerate(secret))


def test_sample_takes_distinct_findings_of_both_labels(spark):
    rows = [(f"copied{i % 3}", 0.0) for i in range(300)] + [(f"plain{i}", 0.0) for i in range(50)] + [(f"key{i}", 1.0) for i in range(30)]
    marked = spark.createDataFrame([(v, "o", "b", "a", y) for v, y in rows], "value string, own string, before string, after string, label double")
    for name in secrets.FEATURES:
        marked = marked.withColumn(name, F.length("value").cast("double"))
    assert Counter(r.label for r in secrets.sampled(marked, 40).collect()) == {0.0: 20, 1.0: 20}
    assert Counter(r.label for r in secrets.sampled(marked, 1000).collect()) == {0.0: 53, 1.0: 30}
    assert "provider" in secrets.FEATURES


SCHEMAS = {"f": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}


def test_tool_calls(spark):
    calls = [
        (1, 1, "x", "f", '{"a": 1.0}', []),
        (1, 3, "y", "f", '{"a": 2, "b": 1}', ["x"]),
        (1, 5, "z", "g", "{}", ["y", "x"]),
        (1, 7, "c1", "f", '{"a":-1}', ["c2"]),
        (1, 9, "c2", "f", "not json", ["c1"]),
        (2, 1, "x", "f", None, ["missing"]),
        (2, 2, None, "f", '{"a":1}', []),
    ]
    results = [(1, 2, "x", "r1"), (1, 4, "x", "later"), (1, 4, "y", None), (2, 9, "lone", "r"), (2, 9, None, "r")]
    calls = spark.createDataFrame(calls, tools.CALLS)
    results = spark.createDataFrame(results, tools.RESULTS)
    rows = {(r.conv_id, r.call_id): r for r in tools.linked(calls, results, SCHEMAS).collect()}
    level = {k: r.level for k, r in rows.items()}
    assert [level[1, c] for c in ("x", "y", "z", "c1", "c2")] == [0, 1, 2, None, None] and level[2, "x"] is None
    assert rows[1, "x"].content == "r1" and rows[1, "x"].linked and not rows[1, "z"].linked
    assert rows[1, "y"].errors == ["$.b: unknown"] and rows[1, "z"].errors == ["$: unknown tool"]
    assert rows[1, "c1"].errors == ["$.a: below minimum"] and rows[1, "c2"].errors == ["$: not JSON"]
    assert rows[2, "lone"].name is None and not rows[2, None].linked
    assert tools.canonical({"b": 1.0, "a": ["é", 2.5]}) == '{"a":["é",2.5],"b":1}'
    assert json.loads(rows[1, "x"].json)["call"]["id"] == "x"
    assert tools.linked(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def brute_levels(uses):
    """Levels by repeated passes over plain dictionaries: {call: [calls it needs]}."""
    level, changed = {}, True
    while changed:
        changed = False
        for call, needs in uses.items():
            if call not in level and all(x in level for x in needs):
                level[call] = max((level[x] + 1 for x in needs), default=0)
                changed = True
    return level


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_random_calls(spark, seed):
    """Trees, several needs, circles, missing and null needs, and a chain of 300 calls."""
    rng = np.random.default_rng(seed)
    uses = {(0, f"c{i}"): [] if i == 0 else [f"c{i - 1}"] for i in range(300)}
    for conv in range(1, 5):
        for i in range(60):
            n = int(rng.choice([0, 1, 1, 1, 2, 3]))
            back = [f"c{j}" for j in rng.integers(0, max(i, 1), n)] if i else []
            uses[conv, f"c{i}"] = back
        uses[conv, "c7"] = uses[conv, "c7"] + [["c30"], ["none"], [None], []][conv - 1]
    rows = [(c, 0, k, "t", "{}", v) for (c, k), v in uses.items()]
    found = tools.levels(spark.createDataFrame(rows, tools.CALLS)).collect()
    plain = {k: [(k[0], x) for x in v] for k, v in uses.items()}
    assert len(found) == len({(r.conv_id, r.call_id) for r in found})
    assert {(r.conv_id, r.call_id): r.level for r in found} == brute_levels(plain)


def test_derived_calls_hold_whole_texts_and_several_needs(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    texts = {(r.conv_id, r.turn): r.text for r in turns.where("role = 'assistant'").collect()}
    calls, results = queries.derived_calls(turns)
    rows, uses = calls.collect(), defaultdict(list)
    assert {(r.conv_id, r.turn) for r in rows} == set(texts)
    for r in rows:
        text, given = texts[r.conv_id, r.turn], json.loads(r.arguments)
        assert given.get("query") == text or given.get("words") == text.split(" ")
        uses[r.conv_id, r.call_id] = [(r.conv_id, x) for x in r.uses]
    assert {1, 2} <= {len(x) for x in uses.values()}
    found = tools.linked(calls, results, queries.SCHEMAS).where("name is not null").collect()
    assert {(r.conv_id, r.call_id): r.level for r in found if r.level is not None} == brute_levels(uses)
    assert all(json.loads(r.json)["call"]["arguments"] == json.loads(r.arguments) for r in found)


def test_candidates_stand_where_a_pattern_finds_them(spark):
    random.seed(8)

    def word():
        if random.random() < 0.1:
            parts = ("".join(random.choice("abcXYZ0189") for _ in range(random.choice([11, 12, 20]))) for _ in range(2))
            return "k='{}',q={}".format(*parts)
        return "".join(random.choice("ab\u00e9") for _ in range(random.randrange(1, 9)))

    def text(n):
        return random.choice(["", " \n"]) + "".join(word() + random.choice([" ", "\n", "  "]) for _ in range(n))

    data = list(enumerate([text(n) for n in (1, 5, 255, 256, 257, 3000)] + ["xabcdefgh1234567=abcdefgh1234567", None, ""]))
    docs = spark.createDataFrame([(i, t, "s", 0, "x") for i, t in data], DOCS)
    found = sorted((r.doc_id, r.start, r.value) for r in secrets.candidates(docs).collect())
    assert found == sorted((i, m.start(), m[0]) for i, t in data for m in re.finditer(secrets.CANDIDATE, t or ""))


def test_broken_arguments(spark):
    schema = {"type": "object", "properties": {"a": {"type": ["integer", "null"]}, "b": {"enum": [True]}}}
    texts = {
        '{"a":1e999}': False,
        '{"a":"\\ud800"}': False,
        '{"\\ud800":1}': False,
        "[" * 100_000: False,
        '{"x":' * 5000 + "1" + "}" * 5000: False,
        "NaN": False,
        "null": False,
        "9" * 5000: False,
        '{"a":2.0}': True,
        '{"a":null}': True,
        '{"a":true}': False,
        '{"b":1}': False,
        '{"b":true}': True,
        '{"z":"\\u00e9","a":1e2}': True,
    }
    calls = [(1, i, f"c{i}", "f", text, None) for i, text in enumerate(texts)]
    calls = spark.createDataFrame([*calls, (None, None, None, None, None, [None])], tools.CALLS)
    out = {r.turn: r for r in tools.linked(calls, spark.createDataFrame([], tools.RESULTS), {"f": schema}).collect()}
    assert [out[i].valid for i in range(len(texts))] == list(texts.values()) and not out[None].valid
    for r in out.values():
        json.loads(r.json)
    assert '"arguments":{"a":100,"z":"\u00e9"}' in out[len(texts) - 1].json
    assert tools.problems(2.5, {"type": ["integer", "null"]}) == ["$: not integer or null"]


def test_scores_do_not_depend_on_the_number_of_mapped_files(spark, monkeypatch):
    random.seed(5)
    data = [(i, " ".join(random.choice("abcdefgh") for _ in range(20))) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "s", 0, "x") for i, t in data], DOCS)
    model = language.train(docs)
    word = np.array([1, 20, 30], np.uint64)
    whole = language.Mapped(model).scores(word, word)
    monkeypatch.setattr(language, "MAPPED", 2)
    few = language.Mapped(model)
    assert all((a == b).all() for a, b in zip(whole, few.scores(word, word))) and len(few.files) <= 2

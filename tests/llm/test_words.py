"""Words, tokens, line rules, packing, sharding, order and extraction against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quipu.llm import extraction, jaccard, order, packing, quality, sharding, tokens, words
from quipu.llm.queries import byte_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "a", "A\tb\n\nc  d\x0b\x0ce", " x  y", "é" * 50, "a b c d e f g h " * 5, "\n\n", "x\n" * 9]
DOCS = "doc_id long, text string, source string, extra string"


def test_words_and_grams():
    for size in (5, 1 << 20):
        for piece in words.pieces(pa.array(ODD), size):
            hashes = piece.hashes()
            grams, bounds = piece.grams(hashes, 3)
            for i in range(piece.n):
                want = WORD.findall(ODD[piece.first + i] or "")
                spans = slice(piece.bounds[i], piece.bounds[i + 1])
                got = [bytes(piece.data[a:b]).decode() for a, b in zip(piece.starts[spans], piece.ends[spans])]
                assert got == want
                assert bounds[i + 1] - bounds[i] == max(len(want) - 2, 0)
                folded = [w.encode().lower() for w in want]
                assert len(set(hashes[spans].tolist())) == len(set(folded))


def test_ids_are_those_of_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    for text in [*ODD, "it's  <|endoftext|>\r\n x", "　a​ b", "1234 5,6  \n\n "]:
        assert list(tokens.encode(path, text)) == whole.encode(text or "", add_special_tokens=False).ids


def counts(text):
    own = WORD.findall(text or "")
    grams = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    cover = {p for i in range(len(own) - 7) if grams[tuple(own[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(cover)


def test_line_counts():
    texts = [*ODD, "a b\nc\na b\n", "\na", "a #$\r\na #$"]
    for piece in words.pieces(pa.array(texts), 40):
        found, *_ = quality._measured(piece)
        for i in range(piece.n):
            assert tuple(int(found[c][i]) for c in quality.COUNTS) == counts(texts[piece.first + i])


def test_boilerplate_goes_and_depleted_documents_too(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    line = "All rights reserved " * 4
    data = [(i, f"{own(i)}\n{line}", "h", "e") for i in range(40)]
    data += [(100, " ".join(["one two"] + [line] * 9).replace(line, "\n" + line), "h", "e"), (101, None, None, None), (102, "", "h", "")]
    data += [data[0]]
    docs = spark.createDataFrame(data, DOCS)
    rules = quality.Rules(max_share=0.5)
    found = {r.doc_id: r for r in quality.verdicts(docs, rules).collect()}
    assert all(found[i].kept and found[i].removed_words == 12 for i in range(40))
    assert not found[100].kept and not found[101].kept and not found[102].kept
    out = quality.cleaned(docs, rules)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([(i, own(i)) for i in range(40)] + [(0, own(0))])
    assert quality.verdicts(docs.limit(0)).count() == 0


def test_near_copies_are_not_emptied_by_line_frequency(spark):
    base = [" ".join(f"b{i}x{j}" for j in range(12)) for i in range(40)]
    edited = lambda i: "\n".join([*base[: i % 40], base[i % 40].replace("x5", f"edit{i}"), *base[i % 40 + 1 :]])
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    line = "All rights reserved here"
    data = [(i, edited(i), "h", "e") for i in range(50)] + [(100 + i, f"{own(i)}\n{line}", "h", "e") for i in range(30)]
    docs = spark.createDataFrame(data, DOCS)
    out = quality.cleaned(docs)
    want = [(i, edited(i)) for i in range(50)] + [(100 + i, own(i)) for i in range(30)]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == want
    assert sorted(r.doc_id for r in jaccard.deduplicated(out).collect()) == [0, *range(100, 130)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_respects_every_capacity(rule):
    random.seed(3)
    lengths = Counter(random.choice([1, 3, 50, 99, 100]) for _ in range(3000))
    cap = packing.Capacity(100, 20, 9900, (1.0, 0.5, 0.5), rule)
    with pytest.raises(ValueError):
        packing.plan({100: 1}, cap)
    del lengths[100]
    bins, placed = {}, Counter()
    for length, rank, each, n, first, offset in packing.plan(dict(lengths), cap).tolist():
        assert rank == placed[length]
        placed[length] += each * n
        for b in range(first, first + n):
            state = bins.setdefault(b, [0, 0, 0])
            assert state[0] == offset
            state[0] += each * length
            state[1] += each
            state[2] += each * length * length
    assert placed == lengths
    assert all(a <= 100 and b <= 20 and c <= 9900 for a, b, c in bins.values())


def test_pieces_fill_sequences_without_gaps(spark):
    docs = spark.createDataFrame([(i, "ab cd " * (i * 7 % 90), "s", "e") for i in range(60)] + [(None, None, None, None)] * 2, DOCS)
    out = packing.pack(docs, byte_vocabulary(), packing.Capacity(64, 64, 64 * 64)).toPandas()
    whole = Tokenizer.from_file(byte_vocabulary())
    for r in docs.collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        own = out[out.doc_id == r.doc_id] if r.doc_id is not None else out[out.doc_id.isna()][:1]
        assert own.length.sum() == len(ids) and (own[own.piece > 0].length == 64).all()
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        ends = rows.offset + rows.length
        assert rows.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 64
    assert out.sequence_id.nunique() <= 1.1 * out.length.sum() / 64 + 1
    assert packing.pack(docs.limit(0), byte_vocabulary()).count() == 0


def test_differencing_places_every_group(spark):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 1000, 300)
    vectors = np.zeros((300, 4), np.int64)
    vectors[:, 0] = sizes
    sums, final = sharding.difference(vectors)
    assert sorted(np.bincount(final[:, 0], sizes, 4).astype(int)) == sorted(sums) and np.ptp(sums) <= 10
    data = [(i, t, "s", "e") for i, t in enumerate(["x" * 50] * 30 + [None, None, ""] + [f"{i}" * 9 for i in range(40)])]
    docs = spark.createDataFrame([*data, (None, "x" * 50, None, None)], DOCS)
    out = sharding.by_bytes(docs, 5, per_part=7).toPandas()
    assert len(out) == len(data) + 1
    for _, rows in out.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    shard = {r.doc_id: r.shard for r in out.itertuples() if r.doc_id == r.doc_id}
    assert len({shard[i] for i in range(30)}) == 1 and shard[30] == shard[31]
    assert out[out.doc_id == 30].text_crc32.item() == 0 and out["size"].min() == 16
    assert sharding.by_bytes(docs.limit(0), 5).count() == 0


def test_permutation_and_shards(spark, tmp_path):
    for total in (1, 2, 5, 64, 1000):
        assert sorted(order.permuted(np.arange(total), total, 9)) == list(range(total))
    docs = spark.createDataFrame([(i, "ab cd " * i, "s", "e") for i in range(50)] + [(None, None, None, None)], DOCS)
    layout = order.Layout(length=16, per_shard=10)
    folder = str(tmp_path / "shards")
    first = order.materialised(docs, byte_vocabulary(), folder, layout).toPandas()
    assert sorted(first.slot) == list(range(len(first)))
    ids = order.read(folder, 0, 10**6, layout)
    assert [zlib.crc32(x.tobytes()) for x in ids] == first.sort_values("slot").ids_crc32.tolist()
    assert (order.read(folder, 13, 9, layout) == ids[13:22]).all()
    again = order.materialised(docs, byte_vocabulary(), folder, layout).toPandas()
    assert sorted(map(tuple, again.values.tolist())) == sorted(map(tuple, first.values.tolist()))
    assert order.materialised(docs.limit(0), byte_vocabulary(), str(tmp_path / "none"), layout).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>menu</a></li></ul></nav>"
    "<div class='ad'>buy this now please</div><article><h1>Head &amp; line</h1><p><b>One  two\nthree<br>four"
    "<p>Five &lt;six&gt; seven eight</p><aside>side words here</aside><div class='cookie-notice'>we use them</div>"
    "<form>your name</form><p>Last block of words.</p><section id='comments'><p>reader says so</p></section></article>"
    "<footer>&copy; site and many more words of the footer</footer><script>var t='</p>';</script></body></html>"
)


def test_main_text(spark):
    data = [(i, f"u{i}", PAGE) for i in range(5)] + [(9, None, None), (10, "u", ""), (11, "u", PAGE[:330]), (None, "u", "plain words")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    found = {r.page_id: r for r in extraction.extract(pages).collect()}
    want = "Head & line\nOne two three four\nFive <six> seven eight\nLast block of words."
    assert found[0].text == want and found[0].n_chars == len(want)
    assert found[9].text == found[10].text == "" and found[None].text == "plain words"
    assert found[11].text.startswith("Head & line\nOne two")
    assert extraction.extract(pages.limit(0)).count() == 0


def test_block_starts(spark, monkeypatch):
    monkeypatch.setattr(order, "GROUP", 3)
    blocks = [(p, b, random.randrange(9)) for p in range(10) if p != 4 for b in range(random.randrange(4))]
    starts, at = {}, 0
    for p, b, n in blocks:
        starts[p, b], at = at, at + n
    frame = spark.createDataFrame(random.sample(blocks, len(blocks)), "part int, block int, n long")
    assert {(r.part, r.block): r.start for r in order.block_starts(frame).collect()} == starts


def test_far_copies_of_an_absent_original_make_few_pairs(spark, monkeypatch):
    """Every two of them share most tokens and only some link, so neither hubs nor shared tokens tell pairs apart."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(240):
        own = list(words)
        for j, place in enumerate(draw.sample(range(4, 146, 5), draw.choice((1, 2, 3, 3, 3)))):
            own[place] = f"x{i}y{j}"
        texts.append(" ".join(own))
    texts += [" ".join(f"v{i}" for i in range(40)) + f" {tail}" for tail in ("a b", "c d", "e")]
    held = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (x.split() for x in texts)]
    low = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b]) and low[a] != low[b]:
                one, other = sorted((low[a], low[b]))
                low = [one if x == other else x for x in low]
    made = []
    links = jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda pairs, *more: made.append(pairs.count()) or links(pairs, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.join(docs).collect()} == dict(enumerate(low))
    assert sum(made) < 10 * len(texts)

"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative; the contiguous run with the largest
sum is the content region, found in one pass. Weights are log odds of standing inside the article, learned
from labelled pages: those whose publisher marks the article by an element or an attribute of its own. They
are counted on a hash sample of ``sample`` pages on average; the counts have a row per tag name known to HTML.
Elements that are never article text (menus, forms, scripts, adverts, notices, reader comments ...), by name
or by the words of their class, id and role, count as tags and give no words.

Blocks keep page order, one a line; character references are decoded; white space in a block is one space.
Null and empty pages give an empty text, as do pages without words. Unclosed and truncated markup ends with the page.
Rows without an id or url are extracted as well; repeated rows repeat. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|select|object|math|canvas|title)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>"
    r"|<[a-z/!?][^<>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-z][a-z-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOT_ARTICLE = set("nav footer aside form button dialog menu head label fieldset".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
MARKED = {"article", "main"}
KEPT = {"html", "body", *MARKED}
# Words of class, id and role that name what is not the article.
BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices alert popup modal"
    " overlay comment comments disqus replies share sharing social related recommended newsletter subscribe"
    " subscription signup login widget toolbar pagination pager skip".split()
)
HEADERS = {"header", "masthead"}
LEAST = 0.05  # of a weight's size, so that words stay positive and tags negative


def _hidden(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds nothing of the article."""
    if name in NOT_ARTICLE or (name == "header" and not in_article):
        return True
    if name in KEPT or not attributes:
        return False
    words: set[str] = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() in ("class", "id", "role"):
            words.update(re.split(r"[^a-z]+", value))
        elif key.lower() == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return bool(words & BOILERPLATE) or (not in_article and bool(words & HEADERS))


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """('tag', name, inside an article) and ('text', characters, inside) in page order.

    Text of elements that are not article text is left out, their tags are not.
    """
    open_: list[tuple[str, bool]] = []
    hidden = marked = 0
    at = 0
    for found in MARKUP.finditer(page):
        if found.start() > at and not hidden:
            yield "text", html.unescape(page[at : found.start()]), marked > 0
        at = found.end()
        name = (found["name"] or found["raw"] or "").lower()
        if not name:
            continue
        if found["raw"]:
            yield "tag", name, marked > 0
        elif not found["close"]:
            yield "tag", name, marked > 0
            if name not in VOID and not found["attributes"].endswith("/"):
                gone = _hidden(name, found["attributes"], marked > 0)
                if gone or name not in INLINE and name not in ("p", "li"):
                    open_.append((name, gone))
                    hidden += gone
                    marked += name in MARKED
        else:
            if any(n == name for n, _ in open_):
                while True:
                    n, gone = open_.pop()
                    hidden -= gone
                    marked -= n in MARKED
                    if n == name:
                        break
            yield "tag", name, marked > 0
    if at < len(page) and not hidden:
        yield "text", html.unescape(page[at:]), marked > 0


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the run with the largest score."""
    word, other = weights["#word"], weights["#other"]
    best, best_run, total, start = 0.0, (0, 0), 0.0, 0
    parts: list[str] = []
    for kind, value, _ in tokens(page or ""):
        if kind == "tag":
            total += weights.get(value, other)
            parts.append(" " if value == "br" else "" if value in INLINE else "\n")
        else:
            total += word * len(value.split())
            parts.append(" ".join(["", *value.split(), ""]) if value != value.strip() else " ".join(value.split()))
        if total <= 0:
            total, start = 0.0, len(parts)
        elif total > best:
            best, best_run = total, (start, len(parts))
    lines = "".join(parts[best_run[0] : best_run[1]]).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


def weights_from(inside: Counter, outside: Counter) -> dict[str, float]:
    """Log odds of words and tags; words at least a little positive, tags a little negative."""
    ins, outs = sum(inside.values()), sum(outside.values())
    names = {"#word", *inside, *outside}

    def odds(name: str) -> float:
        return math.log((inside[name] + 1) / (ins + len(names))) - math.log((outside[name] + 1) / (outs + len(names)))

    found = {n: min(odds(n), -LEAST) for n in names if n != "#word"}
    found["#word"] = max(odds("#word"), LEAST)
    found["#other"] = -1.0
    return found


def learned(pages: DataFrame, sample: int = 2000) -> dict[str, float]:
    """Weights from the marked pages of a hash sample of about ``sample`` pages."""
    total = pages.count()
    share = min(1.0, sample / max(total, 1))
    some = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_000)) < int(share * 1_000_000))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (Counter(), Counter())
        for batch in batches:
            for page in batch.column(0).to_pylist():
                if not re.search(r"<(article|main)\b", page or "", re.I):
                    continue
                for kind, value, within in tokens(page):
                    name, n = (value, 1) if kind == "tag" else ("#word", len(value.split()))
                    if kind == "text" or value in KNOWN:
                        sides[not within][name] += n
        rows = [(name, within, n) for within, side in ((True, sides[0]), (False, sides[1])) for name, n in side.items()]
        if rows:
            names = ["name", "within", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    counted = some.select("html").mapInArrow(count, "name string, within boolean, n long")
    rows = counted.groupBy("name", "within").agg(F.sum("n").alias("n")).collect()  # two for each tag of HTML
    sides = (Counter(), Counter())
    for r in rows:
        sides[not r["within"]][r["name"]] = r["n"]
    return weights_from(*sides)


# Further element names; others share one weight.
KNOWN = (
    VOID
    | NOT_ARTICLE
    | INLINE
    | KEPT
    | set(
        "address blockquote caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup"
        " iframe legend li noscript ol optgroup option p pre script section select style summary svg table tbody"
        " td template textarea tfoot th thead title tr ul video audio".split()
    )
)


def extract(pages: DataFrame, sample: int = 2000) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = learned(pages, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")

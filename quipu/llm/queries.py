"""One query per operator over its whole table: name -> function of (spark, folder), and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm.common import bounded_batches
from quipu.llm import contain, extraction, jaccard, language, merkle, minmax, negatives, order, packing, quality, secrets, sharding, tools
from quipu.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        # workers started from another folder must find this package as well
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        bounded_batches(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), byte_vocabulary())


@query
def op2_html_extraction(spark, sf):
    return extraction.extract(table(spark, sf, "pages"))


@query
def op3_line_frequency(spark, sf):
    found = quality.verdicts(table(spark, sf, "documents"))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept", "removed_words")


@query
def op4_karmarkar_karp(spark, sf):
    found = sharding.by_bytes(table(spark, sf, "documents"))
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", none)


@query
def op5_training_order(spark, sf):
    folder = scratch_path(spark, "shards")
    return order.materialised(table(spark, sf, "documents"), byte_vocabulary(), folder)


@query
def op6_secret_forest(spark, sf):
    found = secrets.findings(table(spark, sf, "documents"))
    return found.select("doc_id", "start", "value", "score", "secret")


@query
def op7_minhash_containment(spark, sf):
    found = contain.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_size")


@query
def op8_ngram_jaccard_join(spark, sf):
    return jaccard.join(table(spark, sf, "documents"))


@query
def op9_kneser_ney(spark, sf):
    return language.score(table(spark, sf, "documents"))


#: Tools that the derived calls name.
SCHEMAS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "maximum": 50}},
        "additionalProperties": False,
    },
    "count": {
        "type": "object",
        "required": ["words"],
        "properties": {"words": {"type": "array", "items": {"type": "string", "maxLength": 12}}},
    },
}


def derived_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the given conversations hold none: an assistant's turn is a call whose arguments
    are its whole text and which uses the call two turns before, a fifth of them by the text's length also that
    four turns before and half of these also that six turns before; the next user's turn is its result."""
    key = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    size, words = F.length("text"), F.split("text", " ")
    search = F.to_json(F.struct(F.col("text").alias("query"), (size % 97).alias("limit")))
    count = F.to_json(F.struct(words.alias("words"), size.alias("n")))

    def used(back: int, every: int) -> Column:
        there = (F.col("turn") >= back) & F.coalesce(size % every == 0, F.lit(every == 1))
        return F.when(there, F.concat(F.lit("call-"), (F.col("turn") - back).cast("string")))

    calls = chats.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        key.alias("call_id"),
        F.when(size % 3 == 0, "search").when(size % 3 == 1, "count").otherwise("look").alias("name"),
        F.when(size % 2 == 0, search).otherwise(count).alias("arguments"),
        F.array_compact(F.array(used(2, 1), used(4, 5), used(6, 10))).alias("uses"),
    )
    before = F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string"))
    results = chats.where("role = 'user' and turn > 0").select(
        "conv_id", "turn", before.alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


@query
def op10_tool_call_linking(spark, sf):
    calls, results = derived_calls(table(spark, sf, "conversations"))
    return tools.linked(calls, results, SCHEMAS)


@query
def op11_midstate_tree(spark, sf):
    docs = table(spark, sf, "documents")
    return merkle.manifest(docs, merkle.one_more(docs))


@query
def op12_cover_tree(spark, sf):
    rows = negatives.vectors(table(spark, sf, "embeddings"), negatives.rotated())
    return negatives.mine(rows, negatives.every(100))


@query
def op13_minmax_hashing(spark, sf):
    return minmax.grouped(table(spark, sf, "documents"))


# Words, 8-word windows and normalised lines of each document; a null text has none.
ORACLES["op3_line_frequency"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, text AS raw
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), grams AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), l AS (
  SELECT r, host, raw, line,
    regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT r, host, raw, unnest(string_split(text, chr(10))) AS line FROM d)
), lines AS (
  SELECT r, host, raw, line, array_to_string(ws, ' ') AS norm, len(ws) AS n FROM l WHERE len(ws) > 0
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), hosts AS (
  SELECT host, count(DISTINCT raw) + max(CASE WHEN raw IS NULL THEN 1 ELSE 0 END) AS n FROM d GROUP BY host
), frequent AS (
  SELECT f.host, f.norm FROM (SELECT host, norm, count(DISTINCT raw) AS n FROM lines GROUP BY host, norm) f
  JOIN hosts h ON h.host = f.host WHERE f.n > 10 AND f.n > h.n * 0.01
), removed AS (
  SELECT r, sum(n) AS n FROM lines JOIN frequent USING (host, norm) GROUP BY r
), s AS (
  SELECT w.r, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    coalesce(removed.n, 0) AS removed_words
  FROM w LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars,
  cast(n_symbols AS bigint) AS n_symbols, cast(n_dup_lines AS bigint) AS n_dup_lines,
  cast(n_repeat_words AS bigint) AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - removed_words) >= 30 * n_words AS kept,
  cast(removed_words AS bigint) AS removed_words
FROM s
"""

# Pairs by shared shingles, then components by repeated spreading of the smallest id.
ORACLES["op8_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT r, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w
), x AS (
  SELECT r, len(sh) AS n, unnest(sh) AS t FROM s
), often AS (
  SELECT t FROM x GROUP BY t HAVING count(*) > 1
), y AS (
  SELECT x.* FROM x JOIN often USING (t)
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM y a JOIN y b ON a.t = b.t AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(r, low) AS (
  SELECT r, doc_id FROM w
  UNION
  SELECT p.b, reach.low FROM reach JOIN pairs p ON p.a = reach.r
), comp AS (
  SELECT r, min(low) AS component_id FROM reach GROUP BY r
)
SELECT w.doc_id, cast(len(s.sh) AS bigint) AS n_shingles, comp.component_id
FROM w JOIN s USING (r) JOIN comp USING (r)
"""

# Distinct shingles of items and documents, shared ones counted.
ORACLES["op7_minhash_containment"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id AS id, true AS doc, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT row_number() OVER (), item_id, false, coalesce(text, '') FROM benchmark
), w AS (
  SELECT r, id, doc, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM t
), s AS (
  SELECT r, id, doc, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 5 THEN ['short ' || array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w
), x AS (SELECT r, id, doc, len(sh) AS n, unnest(sh) AS g FROM s)
SELECT d.id AS doc_id, q.id AS item_id, cast(count(*) AS bigint) AS shared, cast(q.n AS bigint) AS item_size
FROM (SELECT * FROM x WHERE doc) d JOIN (SELECT * FROM x WHERE NOT doc) q USING (g)
GROUP BY d.r, d.id, q.r, q.id, q.n HAVING 100 * count(*) >= 80 * q.n
"""

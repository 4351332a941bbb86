"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more key characters with a digit, or the whole value of 6 or more characters of any
kind that is assigned to a key word, in quotes or up to white space. The forest sees its length, the changes of
character class along it, its shares of digits, capitals and hexadecimal digits, how much of it the corpus's
own dictionary covers, the path (the source's bucket, signs of a path or address around it) and the words
beside it. It is trained on labelled findings: ``labelled`` may bring them; without it, findings whose form
settles the matter (provider formats, assignments to a key word; bare numbers and plain words) are the labels,
from at most ``sample`` distinct findings, half of them of each label, with the smallest hashes. The dictionary is counted over all documents and
keeps the ``dictionary`` most frequent words. Only DataFrame functions and Spark's own forest run here.

Null and empty texts have no findings. Rows without an id or source are scanned as well; repeated rows repeat
their findings. With labels of one class only, the label rule decides alone. An empty table gives no rows.
Other columns are ignored by ``findings`` and kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import small, staged
from quipu.llm.contain import once

RUN = r"[A-Za-z0-9_+/-]"
CANDIDATE = rf"(?<!{RUN})(?=[A-Za-z_+/-]*+[0-9]){RUN}{{12,}}+"
KEYWORD = r"(?i)(passw(or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
BLANK = r"[\x20\x09-\x0D]"
NAMED = KEYWORD.removeprefix("(?i)").replace("(", "(?:")
#: What assigns (group 1) and the value, with its opening quote if it has one.
ASSIGNED = (
    rf"(?i)({NAMED}[A-Za-z0-9_.-]{{0,40}}[\"']?\]?{BLANK}*+(?:=>|:=|==?|:){BLANK}*+(?:(?:bearer|basic){BLANK}++)?|bearer{BLANK}++)"
    r"(?:\"[^\"\n]{6,}+(?=\")|'[^'\n]{6,}+(?=')|[\"']?[^\x20\x09-\x0D\"']{6,}+)"
)
PROVIDER = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})$"
PART = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
MASK = "<secret>"
RUN_PARTS = 256

FEATURES = (
    "length",
    "changes",
    "digits",
    "capitals",
    "hex",
    "variety",
    "covered",
    "source_bucket",
    "path_like",
    "keyword_in",
    "keyword_before",
    "assigned",
    "quoted",
    "word_before",
    "word_after",
    "provider",
)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, source, start, value, own, before, earlier, after): a row per candidate in a text."""
    return runs_of_key_characters(docs).unionByName(assigned_values(docs))


def assigned_values(docs: DataFrame) -> DataFrame:
    """The values assigned to a key word, but for those that are a run of key characters anyway."""
    held = docs.where(F.col("text").rlike(ASSIGNED)).select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        "text",
    )
    keep = ("doc_id", "text_key", "source")
    full, lead = (F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(i)).alias(c) for i, c in enumerate(("full", "lead")))
    found = once(held, F.struct(full, lead, F.split("text", ASSIGNED, -1).alias("gaps")), "x", *keep)
    sizes = F.zip_with("x.gaps", "x.full", lambda gap, match: F.length(gap) + F.coalesce(F.length(match), F.lit(0)))
    found = once(found, sizes, "sizes", *keep, "x")
    each = found.select(*keep, "x.gaps", "x.lead", "sizes", F.posexplode("x.full").alias("nth", "own"))
    gap = [F.element_at("gaps", F.col("nth") + i) for i in (1, 2)]
    lead = F.element_at("lead", F.col("nth") + 1)
    before = F.aggregate(F.slice("sizes", 1, F.col("nth")), F.lit(0), lambda n, x: n + x)
    raw = F.substr("own", F.length(lead) + 1)
    quoted = raw.rlike("^[\"']")
    around = F.right(gap[0], F.lit(200))
    return each.select(
        *keep,
        "own",
        F.regexp_extract(around, rf"({BLANK}|^)([^\x20\x09-\x0D]+){BLANK}*$", 2).alias("before"),
        F.lit("").alias("earlier"),
        F.regexp_extract(F.left(gap[1], F.lit(200)), rf"^[^\x20\x09-\x0D]*{BLANK}+([^\x20\x09-\x0D]+)", 1).alias("after"),
        F.regexp_replace(raw, "^[\"']", "").alias("value"),
        (before + F.length(gap[0]) + F.length(lead) + quoted.cast("int")).cast("long").alias("start"),
    ).where(~F.col("value").rlike(rf"^{CANDIDATE}$"))


def runs_of_key_characters(docs: DataFrame) -> DataFrame:
    """The runs of key characters with a digit."""
    held = docs.where(F.col("text").rlike(CANDIDATE)).select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        (F.length("text") - F.length(F.ltrim(F.col("text"), F.lit(" \t\n\x0b\f\r")))).alias("lead"),
        "text",
    )
    keep = ("doc_id", "text_key", "source", "lead")
    parts = once(held, F.regexp_extract_all("text", F.lit(PART), F.lit(0)), "parts", *keep)

    def size(column: str, first: Column, n: Column) -> Column:
        of = F.length if column == "parts" else lambda x: x
        return F.aggregate(F.slice(column, first, n), F.lit(0), lambda total, x: total + of(x))

    # lengths of runs of parts, so that a candidate's place needs neither all the text before it nor a copy of it
    runs = F.sequence(F.lit(0), F.floor((F.size("parts") - 1) / RUN_PARTS).cast("int"))
    runs = F.transform(runs, lambda c: size("parts", c * RUN_PARTS + 1, F.lit(RUN_PARTS)))
    parts = once(parts, runs, "runs", *keep, "parts")
    at = F.filter(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.element_at("parts", i).rlike(CANDIDATE),
    )

    def word(i: Column) -> Column:
        inside = (i >= 1) & (i <= F.size("parts"))
        part = F.element_at("parts", F.when(inside, i).otherwise(F.lit(1)))
        return F.when(inside, F.rtrim(part, F.lit(" \t\n\x0b\f\r"))).otherwise(F.lit(""))

    def place(i: Column) -> Column:
        run = F.floor((i - 1) / RUN_PARTS).cast("int")
        before = size("runs", F.lit(1), run) + size("parts", run * RUN_PARTS + 1, i - 1 - run * RUN_PARTS)
        around = {"own": word(i), "before": word(i - 1), "earlier": word(i - 2), "after": word(i + 1)}
        return F.struct((F.col("lead") + before).alias("at"), *[c.alias(name) for name, c in around.items()])

    around = ("own", "before", "earlier", "after")
    found = parts.select(*keep, F.explode(F.transform(at, place)).alias("x"))
    named = found.select("doc_id", "text_key", "source", *[f"x.{c}" for c in ("at", *around)])
    values = F.regexp_extract_all("own", F.lit(CANDIDATE), F.lit(0))
    several = named.select("*", values.alias("values"), F.split("own", CANDIDATE, -1).alias("gaps"))
    each = several.select("doc_id", "text_key", "source", "at", *around, "values", "gaps", F.posexplode("values").alias("nth", "value"))
    start = F.col("at") + sum(
        F.aggregate(F.slice(c, 1, F.col("nth") + more), F.lit(0), lambda n, x: n + F.length(x))
        for c, more in (("gaps", 1), ("values", 0))
    )
    return each.select("doc_id", "text_key", "source", *around, "value", start.cast("long").alias("start"))


def dictionary(docs: DataFrame, most: int) -> DataFrame:
    """The most frequent words of letters over all documents, in lower case."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(2, 24))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    # a word that stands once may be a secret itself
    return counted.where("times > 1").orderBy(F.desc("times"), "word").limit(most).select("word")


def featured(found: DataFrame, known: DataFrame) -> DataFrame:
    """Adds the features; ``known`` is the dictionary."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / size

    def flag(x: Column) -> Column:
        return F.coalesce(x, F.lit(False)).cast("double")

    numbered = found.withColumn("finding", F.monotonically_increasing_id())
    numbered = staged(numbered, "findings")
    runs = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{2,}"), F.lit(0))
    letters = numbered.select("finding", F.explode(runs).alias("word"))
    edges = numbered.select("finding", F.explode(F.array(F.lit("before"), F.lit("after"))).alias("side"), "before", "after")
    edges = edges.select(
        "finding",
        "side",
        F.regexp_replace(F.lower(F.when(F.col("side") == "before", F.col("before")).otherwise(F.col("after"))), r"[^\p{L}]+", "").alias("word"),
    )
    covered = letters.join(F.broadcast(known), "word").groupBy("finding").agg(F.sum(F.length("word")).alias("in_words"))
    beside = (
        edges.join(F.broadcast(known), "word")
        .groupBy("finding")
        .agg(F.max((F.col("side") == "before").cast("double")).alias("word_before"), F.max((F.col("side") == "after").cast("double")).alias("word_after"))
    )
    joined = numbered.join(covered, "finding", "left").join(beside, "finding", "left")
    changes = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
    around = F.concat_ws(" ", "before", "own", "after")
    return joined.select(
        *found.columns,
        "finding",
        size.cast("double").alias("length"),
        share(changes).alias("changes"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        share("[0-9a-fA-F]").alias("hex"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("variety"),
        (F.coalesce("in_words", F.lit(0)) / size).alias("covered"),
        F.pmod(F.xxhash64("source"), F.lit(8)).cast("double").alias("source_bucket"),
        flag(around.rlike(r"://|[\\/][A-Za-z0-9_.-]+[\\/]|\.[a-z]{2,4}$")).alias("path_like"),
        flag(F.col("own").rlike(KEYWORD)).alias("keyword_in"),
        flag(F.concat_ws(" ", "earlier", "before").rlike(KEYWORD)).alias("keyword_before"),
        flag(F.col("own").rlike("[=:]") | F.col("before").rlike("[=:]$")).alias("assigned"),
        flag(F.col("own").rlike("[\"']")).alias("quoted"),
        F.coalesce("word_before", F.lit(0.0)).alias("word_before"),
        F.coalesce("word_after", F.lit(0.0)).alias("word_after"),
        flag(value.rlike(PROVIDER)).alias("provider"),
    )


def label_rule() -> Column:
    """1 or 0 where a finding's form settles it, else null."""
    named = (F.col("keyword_in") + F.col("keyword_before") > 0) & (F.col("assigned") > 0)
    secret = F.col("value").rlike(PROVIDER) | (named & (F.col("covered") < 0.7))
    plain = F.col("value").rlike("^[0-9_+/-]+$") | (F.col("covered") >= 0.7)
    words = F.col("value").rlike("^[a-z \\p{Punct}]+$") & (F.col("covered") >= 0.7)
    return F.when(secret, 1.0).when((plain & ~named) | words, 0.0)


def sampled(marked: DataFrame, most: int) -> DataFrame:
    """Labels and features of distinct findings, at most half of ``most`` of each label, by their hashes."""
    one = marked.groupBy(F.xxhash64("value", "own", "before", "after").alias("hash"))
    one = staged(one.agg(F.min(F.struct("label", *FEATURES)).alias("x")), "distinct")
    no, yes = (one.where(F.col("x.label") == label).orderBy("hash").limit(most // 2) for label in (0.0, 1.0))
    return no.union(yes).select("x.*")


def findings(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    sample: int = 20_000,
    words: int = 20_000,
    trees: int = 20,
    depth: int = 6,
) -> DataFrame:
    """(doc_id, text_key, start, value, score, secret) of every candidate.

    ``labelled`` has (doc_id, start, label) of findings in ``docs``.
    """
    known = staged(dictionary(docs, words), "dictionary")
    found = staged(featured(candidates(docs), known), "featured")
    if labelled is None:
        marked = found.withColumn("label", label_rule()).where("label is not null")
    else:
        marked = found.join(labelled.select("doc_id", "start", F.col("label").cast("double")), ["doc_id", "start"])
    taken = staged(sampled(marked, sample), "labelled")
    out = ["doc_id", "text_key", "start", "value"]
    if taken.select("label").distinct().count() < 2:
        score = F.coalesce(label_rule(), F.lit(0.0))
        return found.select(*out, score.alias("score"), (score > 0.5).alias("secret"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt")
    model = forest.fit(assembler.transform(taken))
    scored = model.transform(assembler.transform(found))
    score = vector_to_array("probability")[1]
    return scored.select(*out, score.alias("score"), (score > 0.5).alias("secret"))


def redacted(docs: DataFrame) -> DataFrame:
    """All documents, with every confirmed secret replaced by a mask; columns as before."""
    hits = findings(docs).where("secret").groupBy("text_key").agg(F.collect_set(F.struct(F.length("value"), "value")).alias("__values"))
    # the longest first, so that no part of it is masked before
    hits = hits.withColumn("__values", F.transform(F.sort_array("__values", asc=False), lambda x: x["value"]))
    hits = small(staged(hits.withColumnRenamed("text_key", "__key"), "secrets"))
    joined = docs.join(hits, F.xxhash64(docs["text"]) == F.col("__key"), "left")
    hit = F.col("__key").isNotNull()
    clean = F.aggregate("__values", F.col("text"), lambda text, value: F.replace(text, value, F.lit(MASK)))
    joined = joined.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(hit, size).otherwise(F.col("n_chars")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])

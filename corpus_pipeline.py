"""Documents to packed training sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import contain, jaccard, packing, quality, secrets
from quipu.llm.common import bounded_batches
from quipu.llm.queries import byte_vocabulary
from quipu.session import scratch_path


#: Python workers live through all stages. With fixed limits their allocator gives large arrays back to the system when
#: they are freed, and keeps no more than a little at its top, so that one stage's peak is not the next one's floor.
WORKERS = {
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def lean(spark: SparkSession) -> None:
    """Few texts at once for Python workers, and workers that give memory back."""
    bounded_batches(spark, 500)
    for name, value in WORKERS.items():
        spark.sparkContext.environment.setdefault(name, value)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines go from the others."""
    lean(spark)
    return quality.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays, the one with the smallest id."""
    lean(spark)
    return jaccard.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return contain.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the sequences."""
    lean(spark)
    return packing.pack(docs, byte_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: The forest of the secret scan and the hashed signatures have no counterpart in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

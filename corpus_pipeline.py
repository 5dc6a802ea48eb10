"""A training corpus from `documents`: good texts, without repeated lines, near copies and benchmark items, packed.

Each stage gets what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.llm import quality
from weftline.llm.decontaminate import decontaminate
from weftline.llm.line_dedup import line_dedup
from weftline.llm.ngram_join import one_of_each
from weftline.llm.packing import best_fit_packing
from weftline.llm.queries import held_out, tokenizer
from weftline.session import frozen, release, scratch_path, tune

# Packing and learning have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None

_done: list[str] = []  # what the stages so far have frozen; the next stage does not need it


def _stage(spark: SparkSession, make) -> DataFrame:
    """Runs one stage; the stage before has been written by now, so its intermediate files go."""
    release(tune(spark), [p for p in _done if p in frozen()])
    before = set(frozen())
    try:
        return make()
    finally:
        _done[:] = [p for p in frozen() if p not in before]


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""

    def make():
        labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
        model = quality.learn(quality.measured(docs), labels.where(~held_out(3, 1)))
        return quality.keep_good(docs, model)

    return _stage(spark, make)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that stand earlier, too, and drops documents of which no line with words is left."""

    def make():
        kept = line_dedup(docs)
        return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept

    return _stage(spark, make)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return _stage(spark, lambda: one_of_each(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return _stage(spark, lambda: decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return _stage(spark, lambda: best_fit_packing(docs, tokenizer()))


STAGES = [
    ("quality", good_texts),
    ("line_dedup", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline over documents: language ID, line dedup, n-gram Jaccard join,
benchmark decontamination, best-fit packing.

Each stage works on all that the one before kept and is written as Parquet
before the next reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import drop_tables, read_table, recording, small_batches
from demandspark.llm.decontaminate import decontaminate
from demandspark.llm.language_id import UNKNOWN, fit, held_out, identify
from demandspark.llm.line_dedup import dedup_lines
from demandspark.llm.ngram_join import keep_first
from demandspark.llm.packing import pack_documents
from demandspark.llm.tokens import tokenizer_text
from demandspark.session import materialize

_EARLIER: dict[str, list[str]] = {}   # cut points of the stage before, by application


def stage(fn):
    """A stage of the pipeline. Its input, the result of the stage before, is written, so what that stage
    wrote on its way can go; cut points of other results stay."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        app = spark.sparkContext.applicationId
        drop_tables(spark, _EARLIER.pop(app, []))
        _EARLIER[app] = []
        with recording(_EARLIER[app]):
            return fn(spark, docs, sf_dir)
    return run_stage


MIN_LANGUAGE = 0.5       # share of a text's letters in its main language, at least


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a main language go: no letters, or none with half of them."""
    columns = docs.columns
    model = fit(docs.where(~held_out()).select("text", "lang"))
    found = identify(docs, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)).select(*columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of three lines or fifty words go, and documents of which nothing is left."""
    columns = docs.columns
    out = dedup_lines(docs, min_lines=3, min_words=50)
    left = (F.col("n_removed") < F.col("n_lines")) | F.col("text").isNull()
    return out.where(left).withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_first(docs, words=5, percent=75)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"), min_match=5, coverage=0.5)


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces packed into sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_text(), capacity=2048, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Viterbi labels and packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

"""Preparing a training corpus: each stage works on all that its predecessor kept.

A stage's result is to be written before the next stage is called, which drops the tables the result
was read from. Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty
tables and further columns of any name: a null text is empty and clean, equals other empty texts (the row
of the smallest id stays, of null ids only if there is no other), links with nothing, has size 0 and so is
not taken by the mix; rows that repeat are one text for the exact copies. All columns are handed on,
``tokens`` adds ``ids`` and ``n_tokens``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from moodline.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from moodline.llm.common import table
from moodline.session import configure, drop_stages, stage, stages_made


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: dict[str, list[str]] = {}  # application id -> tables that the result of its last stage reads


def after_the_last(apply: Stage) -> Stage:
    """A stage that first drops the tables of the one before it: its result has been written since."""

    @wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_stages(spark, _left.pop(app, []))
        with stages_made() as made:
            out = apply(spark, docs, sf_dir)
        _left[app] = made
        return out

    return run_stage


@after_the_last
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier chain, fitted on the labelled ones, calls toxic."""
    labels = table(configure(spark), sf_dir, "labels")
    chain = toxicity.fit(docs, labels, toxicity.label_categories(labels), "toxic")
    return toxicity.keep_clean(docs, chain)


@after_the_last
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but the first of equal texts."""
    configure(spark)
    return exact_dedup.drop_copies(docs)


@after_the_last
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies."""
    configure(spark)
    return ngram_join.drop_near_copies(docs)


@after_the_last
def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    configure(spark)
    return mixing.take(docs)


@after_the_last
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids and the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    keep = [c for c in docs.columns if c != "text"]
    return bpe.tokenize(docs, path, keep=keep).withColumnRenamed("decoded", "text")


STAGES = [
    ("toxicity", clean),
    ("exact dedup", exact_copies),
    ("n-gram jaccard join", near_copies),
    ("mixing", weighted_mix),
    ("bpe", tokens),
]

#: SQL can't express the toxicity model or the draws of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for k, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            with stages_made() as made:
                docs = stage(docs, f"pipeline-{k}")
            drop_stages(spark, before)
            before = made
    return docs

"""A corpus from documents to packed token sequences, in stages that each read the one before."""

from __future__ import annotations

import os
import sys
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from epidw.llm import exact, jaccard, mixing, packing, quality  # noqa: E402
from epidw.llm.common import small_batches, table, written  # noqa: E402
from epidw.llm.queries import labelled_domains  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five-word shingles, Jaccard similarity of 0.8."""
    return jaccard.one_of_each(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of scarce languages more often, towards tempered shares."""
    return mixing.mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TOKENIZER)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 token ids."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_domains),
    ("best-fit packing", pack),
]

#: the classifiers and the tokenizer have no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage returns is written and read again by the next one."""
    small_batches(spark)
    *middle, (_, last) = STAGES
    docs = reduce(lambda d, stage: written(stage[1](spark, d, sf_dir), "stage"), middle, table(spark, sf_dir, "documents"))
    return last(spark, docs, sf_dir)

"""From raw documents to token ids: rules, classifier, near duplicates, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faretide.llm import ngram_jaccard, quality_classifier, quality_rules
from faretide.llm.bpe import token_lists
from faretide.llm.mixing import repeat_taken
from faretide.llm.queries import TOKENIZER
from faretide.session import stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these, takes for good."""
    return quality_classifier.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by similarity."""
    return ngram_jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; each source's last cut at its target."""
    return repeat_taken(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    return token_lists(docs, TOKENIZER, max_words=60_000)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

#: Hashes of shingles, fitted models and a tokenizer's file are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

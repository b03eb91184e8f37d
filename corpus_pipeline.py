"""Corpus pipeline: toxicity, exact dedup, near-duplicate join, mixing, BPE encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import bpe, exact_dedup, jaccard, mixing, toxicity
from rillflow.llm.common import cut, table


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones among them, scores below its threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="_toxic").where(F.col("_toxic") < toxicity.REJECT_AT).drop("_toxic")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (blanks aside) the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked at 0.8 over 5-word shingles the smallest doc_id stays."""
    return jaccard.drop_near_duplicates(docs, k=5, num=4, den=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weighed 5, 2, 1, 150% of all words, at most twice each."""
    return mixing.emit(mixing.mix(docs))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left: doc_id, source, n_tokens, ids."""
    encoded = bpe.encode(docs, keep=["source"])
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", clean_language), ("exact dedup", exact_copies), ("near duplicates", near_copies),
          ("mixing", mix_sources), ("bpe", encode_tokens)]
#: SQL has no classifier training, union-find or merge-rule tokenizer: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs

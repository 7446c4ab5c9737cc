"""Corpus pipeline: quality filter, line dedup, near-duplicate groups, source mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of docs and returns a
DataFrame; all but the last return the columns of documents. Each result is
written as Parquet under the shared folder and read back as the next docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstats.llm import line_dedup, mixing, ngram_join, packing, quality_classifier
from reelstats.llm.tables import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PACK_END_ID = 0


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in an earlier document go; n_chars follows."""
    return line_dedup.drop_repeated_lines(docs.select(COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return ngram_join.one_per_group(docs.select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights."""
    return mixing.mix(docs.select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, copies included, with their token ids, placed in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), PACK_END_ID, with_ids=True, added_tokens=True)


STAGES = [
    ("quality_filter", quality_filter),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The classifier can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries op1_ to op13_ (spark, sf_dir) -> DataFrame, and their DuckDB SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstats.llm import (
    conversation_trie,
    decontaminate,
    fm_dedup,
    html_extract,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    simhash,
    sql,
    token_files,
)
from reelstats.llm.tables import table
from reelstats.session import scratch_path

END_ID_FILES = 2
END_ID_PACK = 0


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, _tokenizer("byte_bpe_50k.json"), END_ID_FILES, added_tokens=True)
    return token_files.read_index(spark, path)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.drop_repeats(table(spark, sf_dir, "documents"), digest=True)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), END_ID_PACK, added_tokens=True)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), digest=True)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"), openings=True)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_token_files, op3_quality_classifier, op4_substring_dedup, op5_ngram_jaccard, op6_simhash,
    op7_best_fit_packing, op8_quality_rules, op9_line_dedup, op10_source_mixing,
    op11_conversation_trie, op12_periodic_runs, op13_decontamination,
)}

ORACLES = {
    "op4_substring_dedup": sql.SUBSTRING_DEDUP,
    "op5_ngram_jaccard": sql.NGRAM_JACCARD,
    "op9_line_dedup": sql.LINE_DEDUP,
    "op10_source_mixing": sql.SOURCE_MIXING,
    "op11_conversation_trie": sql.CONVERSATION_TRIE,
    "op13_decontamination": sql.DECONTAMINATION,
}

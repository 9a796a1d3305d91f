"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontam import contamination
from .exact_dedup import exact_groups
from .line_dedup import SHORT, dedup_lines
from .lm_scoring import score_documents
from .packing import pack
from .prefix_trie import prefix_trie, rebuilt, trie_report, turn_sequences
from .quality import score_quality
from .quality_rules import quality_rules
from .secret_scan import scan_secrets
from .sharding import shard_rows
from .simhash import near_duplicates
from .structure_repair import damaged, repair_conversations, repair_report
from .toxicity import score_toxicity

#: The public vocabulary file that documents are packed with.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), short=SHORT)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), shards=16)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file(TOKENIZER))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_report(prefix_trie(rebuilt(turn_sequences(table(spark, sf_dir, "conversations")))))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, repair_conversations(damaged(conversations)))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sharding": op6_sharding,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_structure_repair": op12_structure_repair,
    "op13_quality_rules": op13_quality_rules,
}

"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, decontaminate, fim, fm_index, gam, html_text, licences, ngrams, oracles, rules, secrets, suffix_array, toxicity
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Vocabulary files are installed with the public_tokenizers package; they are never copied into this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.joined(table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.kept_words(table(spark, sf_dir, "documents")).drop("kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.kept_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transformed(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality": op2_quality,
    "op3_substrings": op3_substrings,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_suffix_array": op6_suffix_array,
    "op7_decontamination": op7_decontamination,
    "op8_licences": op8_licences,
    "op9_rules": op9_rules,
    "op10_bpe": op10_bpe,
    "op11_collocations": op11_collocations,
    "op12_html_text": op12_html_text,
    "op13_fim": op13_fim,
}
ORACLES: dict[str, str] = oracles.ORACLES

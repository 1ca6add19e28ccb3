"""Queries of the training-data operators, one for each, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .common import table
from .conversation_trie import conversation_trie
from .embedding_dedup import near_vectors
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .license_scan import FULL_TEMPLATES, license_report
from .mixing import mix_plan
from .packing import pack_documents
from .piece_codec import piece_report
from .quality import classify_quality
from .secret_scan import secret_report
from .sql import SQL
from .suffix_dedup import remove_repeats
from .toxicity import classify_toxicity


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"), runs=True, templates=FULL_TEMPLATES)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_piece_codec": op2_piece_codec,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_conversation_trie": op13_conversation_trie,
}

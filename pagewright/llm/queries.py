"""Queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import canonical, language, mixing, mojibake, ocr, oracle, quality, residue, tokens
from .common import cut, once, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.equal_looking_pairs(table(spark, d, "page_results"))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    return canonical.reading_classes(table(spark, d, "page_results"))


def p1_texts(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_texts(table(spark, d, "page_results"))


def _language_weights(spark: SparkSession, d: str) -> dict:
    return language.fit(spark, table(spark, d, "page_results"), table(spark, d, "common_words"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrongly_labelled(table(spark, d, "page_results"), _language_weights(spark, d))


def p2_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = language.labelled(once(table(spark, d, "page_results"), "result_id"), _language_weights(spark, d))
    return rows.drop("named")


def _page_texts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "page_results").select(F.lit("page_results").alias("tab"), F.col("result_id").alias("row_id"), "text")
    b = table(spark, d, "page_analysis").select(F.lit("page_analysis").alias("tab"), F.col("analysis_id").alias("row_id"), "text")
    return a.unionAll(b)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.affected_words(_page_texts(spark, d)).select("tab", "row_id").distinct()


def p3_texts(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restored_texts(_page_texts(spark, d))


def p4_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.document_stats(quality.page_stats(table(spark, d, "page_analysis"), table(spark, d, "common_words")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_stats(spark, d).where("kind in ('list', 'table', 'junk') and item_id is not null").select("item_id", "kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.noise(table(spark, d, "page_results"))


def p5_texts(spark: SparkSession, d: str) -> DataFrame:
    return ocr.repaired(table(spark, d, "page_results"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(table(spark, d, "documents"))


def p7_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    mix, part = mixing.planned(table(spark, d, "documents"), targets)
    return mixing.shares(cut(mix.drop("ids"), "mixed"), targets, part)


def p7_targets(spark: SparkSession, d: str) -> DataFrame:
    """What each source should contribute, of all targets and of those whose source has any text."""
    sources = table(spark, d, "documents").where("source is not null and text <> ''").select("source").distinct()
    shares = mixing.wanted_shares(table(spark, d, "mix_targets"), sources)
    return shares.select("mix_name", "source", *[F.round(c, 12).alias(c) for c in ("target_share", "reachable_share")])  # sums of doubles differ by their order


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.judged(table(spark, d, "documents")).where("is_case").select("doc_id").distinct()


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    rows = residue.judged(table(spark, d, "documents"), keep=("text", "source"))
    return rows.where("not is_case").select("doc_id", "text", "source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("p") and k[1].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()

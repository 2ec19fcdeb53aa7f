"""The page tables as operators want them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.tables import read_table as table


def items(spark: SparkSession, d: str) -> DataFrame:
    """Received documents, the latest delivery of each."""
    t = table(spark, d, "pdf_items")
    rest = F.struct(*[c for c in t.columns if c != "item_id"])
    return t.groupBy("item_id").agg(F.max_by(rest, "ingested_at").alias("r")).select("item_id", "r.*")


def analysis(spark: SparkSession, d: str) -> DataFrame:
    """item_id, page, word_count, image_coverage and recommended_mode as this engine finds them from the
    stored text and coverage; deliveries counted once.  The text is dropped before anything is shuffled."""
    from pagewright.functions import text

    t = table(spark, d, "page_analysis")
    words = F.coalesce("text", F.lit(""))
    share = F.coalesce("image_coverage", F.lit(0.0))
    found = t.select("analysis_id", "item_id", "page", text.word_count(words).alias("word_count"), share.alias("image_coverage"), text.recommended_mode(words, share).alias("recommended_mode"))
    return found.dropDuplicates(["analysis_id"])

"""Preflight: which pages have usable native text, per page and rolled up per document.

Pages of a document share one exchange: the window of the early stop and the roll-up are both partitioned by
the document's key.  Nothing is collected; a document's pages are bounded by its page count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.functions import geometry, rounding, text

PAGE = ("page", "text", "word_count", "image_coverage", "recommended_mode")


def analyze_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Analysis of pages with columns page, items or text, and width, height, ops or image_coverage."""
    words = text.assemble(F.col("items")) if "items" in pages.columns else F.coalesce(F.col("text"), F.lit(""))
    share = F.col("image_coverage") if "image_coverage" in pages.columns else geometry.image_coverage(F.col("width"), F.col("height"), F.col("ops"))
    base = pages.select(*keys, "page", words.alias("text"), F.coalesce(share, F.lit(0.0)).alias("image_coverage"))
    return base.select(*keys, "page", "text", text.word_count(F.col("text")).alias("word_count"), "image_coverage", text.recommended_mode(F.col("text"), F.col("image_coverage")).alias("recommended_mode"))


def stop_limit(k: Column) -> Column:
    """Number of OCR pages after which a scan stops: whole, not below 0, 0 for never."""
    return F.coalesce(F.greatest(F.lit(0), F.floor(F.nanvl(k, F.lit(0.0)))), F.lit(0))


def scanned_pages(analysis: DataFrame, key: str, stop_after: Column) -> DataFrame:
    """The pages a scan in page order looks at: it stops behind the page with which the OCR pages reach the
    limit.  stop_after is a column of analysis or a literal."""
    before = W.partitionBy(key).orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    ocr = (F.col("recommended_mode") == "ocr").cast("int")
    seen = analysis.withColumn("_limit", stop_limit(stop_after)).withColumn("_ocr_before", F.coalesce(F.sum(ocr).over(before), F.lit(0)))
    return seen.where((F.col("_limit") == 0) | (F.col("_ocr_before") < F.col("_limit"))).drop("_ocr_before")


def document_summary(scanned: DataFrame, key: str, page_count: Column) -> DataFrame:
    """One row per document from scanned_pages; page_count is a column constant within a document.
    A document stopped early is 'auto' whatever its pages say; else its pages' one mode, or 'auto'."""
    ocr = F.sum((F.col("recommended_mode") == "ocr").cast("int"))
    page = F.struct("page", F.col("recommended_mode").alias("recommendedMode"), F.col("word_count").alias("wordCount"), rounding.fixed4(F.col("image_coverage")).alias("imageCoverage"))
    agg = scanned.groupBy(key).agg(
        F.first(page_count, ignorenulls=True).cast("int").alias("pageCount"),
        ocr.cast("int").alias("ocrPageCount"),
        F.count(F.lit(1)).cast("int").alias("analyzedPageCount"),
        F.max("page").alias("_last"),
        F.max("_limit").alias("_limit"),
        F.min("recommended_mode").alias("_lo"),
        F.max("recommended_mode").alias("_hi"),
        F.array_sort(F.collect_list(page)).alias("pages"),
    )
    stopped = F.coalesce((F.col("_limit") > 0) & (F.col("ocrPageCount") >= F.col("_limit")) & (F.col("_last") < F.col("pageCount")), F.lit(False))
    agg = agg.withColumn("_stopped", stopped)
    mode = F.when(F.col("_stopped"), "auto").when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise("auto")
    return agg.select(
        key,
        "pageCount",
        mode.alias("recommendedMode"),
        (F.col("analyzedPageCount") - F.col("ocrPageCount")).alias("nativePageCount"),
        "ocrPageCount",
        "analyzedPageCount",
        (~F.col("_stopped")).alias("analysisComplete"),
        F.col("_stopped").alias("ocrThresholdExceeded"),
        "pages",
    )


def preflight(documents: DataFrame, pages: DataFrame, key: str = "item_id", stop_after: str | None = None, page_count: str = "page_count") -> DataFrame:
    """Documents with their context columns and the summary; computed columns replace those of that name.
    A document without pages keeps its row: counts 0, mode 'auto', complete."""
    params = documents.select(key, F.col(page_count).cast("int").alias("_count"), (F.col(stop_after) if stop_after else F.lit(0.0)).cast("double").alias("_stop"))
    analysis = analyze_pages(pages, [key]).join(params, key)
    summary = document_summary(scanned_pages(analysis, key, F.col("_stop")), key, F.col("_count"))
    out = [c for c in summary.columns if c != key]
    context = documents.drop(*[c for c in documents.columns if c.lower() in {x.lower() for x in out} and c != page_count])
    joined = context.join(summary, key, "left").withColumn("pageCount", F.coalesce("pageCount", F.col(page_count).cast("int")))
    empty = {"nativePageCount": 0, "ocrPageCount": 0, "analyzedPageCount": 0, "recommendedMode": "auto", "analysisComplete": True, "ocrThresholdExceeded": False}
    return joined.fillna(empty).withColumn("pages", F.coalesce("pages", F.array().cast(summary.schema["pages"].dataType)))

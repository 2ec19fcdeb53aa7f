"""One query per operator family over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry, pages, rounding, text
from pagewright.operators import concurrency, preflight, recognition, slicing
from pagewright.plans.tables import analysis, items, table
from pagewright.shipping import ship
from pagewright.sources import pdf, samples

Query = Callable[[SparkSession, str], DataFrame]


def word_count(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_results")
    return t.select("result_id", text.word_count(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_words")).dropDuplicates(["result_id"])


def char_classes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_results").withColumn("t", F.coalesce("text", F.lit("")))
    c = F.col("t")
    return t.select(
        "result_id",
        text.utf16_length(c).cast("bigint").alias("n_units"),
        text.meaningful_chars(c).cast("bigint").alias("n_meaningful"),
        text.valid_chars(c).cast("bigint").alias("n_valid"),
        text.invalid_chars(c).cast("bigint").alias("n_invalid"),
        text.invalid_ratio(c).alias("invalid_ratio"),
    ).dropDuplicates(["result_id"])


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_results").where("text is not null").select("result_id", text.normalize(F.col("text")).alias("t"))
    return t.select("result_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.length("t").cast("bigint").alias("n_chars")).dropDuplicates(["result_id"])


def assemble_page_text(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_results").where("text is not null").withColumn("lines", F.split("text", "\n"))
    parts = F.transform("lines", lambda x, i: F.struct(F.when(x != "", x).alias("str"), (i < F.size("lines") - 1).alias("has_eol")))
    out = t.select("result_id", text.assemble(parts).alias("t"))
    return out.select("result_id", F.md5(F.col("t").cast("binary")).alias("digest")).dropDuplicates(["result_id"])


def recommend_mode(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_analysis")
    return t.select("analysis_id", text.recommended_mode(F.col("text"), F.col("image_coverage")).alias("mode")).dropDuplicates(["analysis_id"])


def rule_breakdown(spark: SparkSession, d: str) -> DataFrame:
    c, s = F.coalesce("text", F.lit("")), F.coalesce("image_coverage", F.lit(0.0))
    rules = text.reasons_for_ocr(c, s)
    t = table(spark, d, "page_analysis").select("analysis_id", "recommended_mode", *[v.cast("bigint").alias(k) for k, v in rules.items()]).dropDuplicates(["analysis_id"])
    return t.groupBy(F.coalesce("recommended_mode", F.lit("none")).alias("stored_mode")).agg(F.count(F.lit(1)).alias("pages"), *[F.sum(k).alias(k) for k in rules])


def _rects(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("l_linenumber").cast("double") * 7, F.col("l_quantity")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.array(x, y, x + F.col("l_quantity") % 13 + 4, y + F.col("l_linenumber") * 3).alias("rect"))


def rect_clip(spark: SparkSession, d: str) -> DataFrame:
    m = F.array(F.col("l_quantity"), F.lit(0.0), F.lit(0.0), -F.col("l_quantity"), F.col("l_linenumber").cast("double") * 5, F.lit(30.0))
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", geometry.clip(geometry.box(m), F.lit(40.0), F.lit(25.0)).alias("r"))
    return t.groupBy("l_orderkey").agg(F.count("r").alias("n_kept"), *[F.sum(F.get("r", F.lit(i))).alias(f"c{i}") for i in range(4)])


def union_area(spark: SparkSession, d: str) -> DataFrame:
    t = _rects(spark, d).groupBy("l_orderkey").agg(F.collect_list("rect").alias("rects"))
    return t.select("l_orderkey", geometry.union_area(F.col("rects")).alias("area"))


def matrix_fold(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_operators").select("item_id", "page", geometry.fold(F.col("ops")).alias("f"))
    return t.select("item_id", "page", *[F.get("f.m", F.lit(i)).alias(f"m{i}") for i in range(6)], F.size("f.stack").cast("bigint").alias("depth"), F.size("f.drawn").cast("bigint").alias("n_drawn"))


def image_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_operators").select("item_id", "page", geometry.image_coverage(F.col("width"), F.col("height"), F.col("ops")).alias("c"))
    return t.select("item_id", "page", rounding.fixed4(F.col("c")).alias("coverage"))


def _spans(d: str, spark: SparkSession, error, chosen) -> DataFrame:
    t = items(spark, d)
    count, first, last, listed = F.col("page_count"), F.col("page_from"), F.col("page_to"), F.col("specific_pages")
    p = chosen(count, first, last, listed)
    return t.select("item_id", error(count, first, last, listed).alias("error"), F.when(p.isNotNull(), F.size(p)).cast("bigint").alias("n_pages"), F.array_min(p).cast("bigint").alias("first_page"), F.array_max(p).cast("bigint").alias("last_page"))


def page_range(spark: SparkSession, d: str) -> DataFrame:
    return _spans(d, spark, lambda n, a, b, _: pages.range_error(n, a, b), lambda n, a, b, _: pages.range_pages(n, a, b))


def specific_pages(spark: SparkSession, d: str) -> DataFrame:
    return _spans(d, spark, lambda n, a, b, s: pages.list_error(n, s), lambda n, a, b, s: pages.list_pages(n, s))


def selected_pages(spark: SparkSession, d: str) -> DataFrame:
    p = pages.selected_pages(F.col("page_selection"), F.col("page_count"), F.col("page_from"), F.col("page_to"), F.col("specific_pages"))
    return items(spark, d).select("item_id", F.explode(F.transform(p, lambda x: x.cast("bigint"))).alias("page"))


def slice_validate(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "slice_requests").dropDuplicates(["slice_id"])
    t = r.join(items(spark, d).select("item_id", "page_count", "file_name"), "item_id", "left")
    first, last, n, size = (F.col(c) for c in ("page_from", "page_to", "page_count", "slice_size_bytes"))
    error = slicing.request_error(n, first, last, size, F.col("max_output_bytes"))
    ok = error.isNull()
    return t.select("slice_id", error.alias("error"), F.when(ok, slicing.output_name(F.col("file_name"), first, last)).alias("output_name"), F.when(ok, last - first + 1).cast("bigint").alias("n_pages"))


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    docs = items(spark, d).select("item_id", "page_count", "stop_after_ocr_pages")
    return preflight.scanned_pages(analysis(spark, d).join(docs, "item_id"), "item_id", F.col("stop_after_ocr_pages"))


def preflight_pages(spark: SparkSession, d: str) -> DataFrame:
    return _scanned(spark, d).select("item_id", F.col("page").cast("bigint").alias("page"), "recommended_mode", F.col("word_count").cast("bigint").alias("word_count"), rounding.fixed4(F.col("image_coverage")).alias("image_coverage"))


def preflight_document(spark: SparkSession, d: str) -> DataFrame:
    s = preflight.document_summary(_scanned(spark, d), "item_id", F.col("page_count"))
    return s.select("item_id", *[F.col(a).cast("bigint").alias(b) for a, b in (("pageCount", "page_count"), ("nativePageCount", "native_pages"), ("ocrPageCount", "ocr_pages"), ("analyzedPageCount", "analyzed_pages"))], F.col("recommendedMode").alias("recommended_mode"), F.col("analysisComplete").alias("analysis_complete"), F.col("ocrThresholdExceeded").alias("threshold_exceeded"))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "page_analysis").dropDuplicates(["analysis_id"])
    t = a.join(items(spark, d).select("item_id", "recognition_mode", "page_count", "page_selection"), "item_id")
    mode = recognition.routed_mode(F.coalesce("recognition_mode", F.lit("auto")), F.col("text"), F.col("image_coverage"))
    stub = F.coalesce("text", F.lit(""))
    routed = t.select("item_id", "page", "page_count", "page_selection", "text", mode.alias("mode"), F.concat(F.lit("read: "), stub).alias("ocr_text"), (F.length(stub) % 100).cast("double").alias("ocr_confidence"))
    return recognition.page_results(routed)


def route_auto(spark: SparkSession, d: str) -> DataFrame:
    t = _routed(spark, d)
    return t.select("item_id", F.col("page").cast("bigint").alias("page"), "source", F.md5(F.col("text").cast("binary")).alias("digest"), "confidence")


def recognition_result(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    t = _routed(spark, d).withColumn("asked", F.array_sort(F.collect_set("page").over(W.partitionBy("item_id"))))
    r = recognition.document_results(t, "item_id", "page_count", "page_selection", "asked").select("item_id", "recognition_result.*")
    return r.select("item_id", "source", F.col("pageCount").cast("bigint").alias("page_count"), F.col("range.from").cast("bigint").alias("range_from"), F.col("range.to").cast("bigint").alias("range_to"), F.array_join("selectedPages", ",").alias("selected"), F.size("pages").cast("bigint").alias("n_pages"), F.get("pages", F.lit(0))["page"].cast("bigint").alias("first_page"))


def context_projection(spark: SparkSession, d: str) -> DataFrame:
    t = items(spark, d).select("item_id", "file_name", F.lit(1).alias("pages"), F.lit(2).alias("pageCount"), F.lit("x").alias("downloaded_base64"), F.lit(3).cast("bigint").alias("analyzedPageCount"), F.lit("auto").alias("recommendedMode"))
    return recognition.context(t)


def render_dimensions(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "page_operators").join(items(spark, d).select("item_id", "dpi"), "item_id")
    dpi = F.coalesce("dpi", F.lit(300)).cast("double")
    return t.select("item_id", "page", *[recognition.render_size(F.col(c), dpi).cast("bigint").alias(f"{c}_px") for c in ("width", "height")])


def _documents(spark: SparkSession, d: str, *params: str) -> DataFrame:
    """A PDF of every item that has a page count, with one image on each page and one line of text on two pages
    out of three, so that every document of some length has pages to recognise."""
    ship(spark)

    @F.pandas_udf("binary")
    def made(item: pd.Series, n: pd.Series) -> pd.Series:
        line = lambda k, i: b"" if (k + i) % 3 == 0 else b"BT /F1 12 Tf 10 100 Td (Item %d page %d) Tj ET " % (k, i)
        image = b"q 100 0 0 150 0 0 cm /Im1 Do Q"
        return pd.Series([samples.make_pdf([(199 + i, 299 + i, line(k, i) + image) for i in range(1, count + 1)], compressed=True) for k, count in zip(item, n, strict=True)])

    # few bytes a row but much work: over all cores before the documents exist
    rows = items(spark, d).where("page_count > 0").select("item_id", "file_name", "page_count", *params).repartition(spark.sparkContext.defaultParallelism)
    return rows.select("*", made("item_id", "page_count").alias("content"))


def pdf_pages(spark: SparkSession, d: str) -> DataFrame:
    p = pdf.pages(_documents(spark, d), keep=("item_id",))
    return p.select("item_id", F.col("page").cast("bigint").alias("page"), F.col("page_count").cast("bigint").alias("page_count"), "width", "height", text.assemble(F.col("items")).alias("text"), rounding.fixed4(geometry.image_coverage(F.col("width"), F.col("height"), F.col("ops"))).alias("coverage"))


def pdf_slice(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).where("page_count >= 2").select("item_id", "file_name", F.col("content").alias("data"), F.lit(2.0).alias("page_from"), F.col("page_count").cast("double").alias("page_to"))
    out = slicing.slice_documents(docs)
    again = pdf.pages(out.select("item_id", "pdf_slice_page_count", "pdf_source_page_count", F.col("data.data").alias("content")), keep=("item_id", "pdf_slice_page_count", "pdf_source_page_count"), want_ops=False)
    shown = F.concat_ws(" ", F.col("page").cast("string"), F.col("width").cast("int").cast("string"), text.assemble(F.col("items")))
    pages_ = F.transform(F.array_sort(F.collect_list(F.struct("page", shown.alias("s")))), lambda x: x["s"])
    return again.groupBy("item_id").agg(F.max("pdf_slice_page_count").cast("bigint").alias("slice_pages"), F.max("pdf_source_page_count").cast("bigint").alias("source_pages"), F.count(F.lit(1)).alias("n_pages"), F.md5(F.array_join(pages_, "|").cast("binary")).alias("pages"))


def slice_binaries(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a row with several binary columns, some of them missing."""
    docs = _documents(spark, d).select("item_id", "file_name", F.when(F.col("item_id") % 5 > 0, F.col("content")).alias("data"), F.col("content").alias("other"), F.lit(1.0).alias("page_from"), F.least(F.col("item_id") % 4, F.col("page_count")).cast("double").alias("page_to"))
    out = slicing.slice_documents(docs, output_field="slice", on_error="collect")
    binary = [f.name for f in out.schema if f.dataType.typeName() == "binary"]
    return out.select("item_id", "error", F.col("slice.file_name").alias("output_name"), F.col("slice.mime_type").alias("mime_type"), F.col("pdf_slice_page_count").cast("bigint").alias("n_pages"), F.lit(len(binary)).cast("bigint").alias("binaries_left"), F.col("slice").isNotNull().alias("has_slice"))


def preflight_context(spark: SparkSession, d: str) -> DataFrame:
    """Preflight keeps the columns of a document; computed ones replace those of that name."""
    docs = items(spark, d).select("item_id", "file_name", "page_count", "stop_after_ocr_pages", F.lit(-1).alias("ocrPageCount"), F.lit("x").alias("recommendedMode"))
    pages_ = table(spark, d, "page_analysis").dropDuplicates(["analysis_id"]).where("item_id is not null").select("item_id", "page", "text", "image_coverage")
    r = preflight.preflight(docs, pages_, stop_after="stop_after_ocr_pages")
    return r.select("item_id", "file_name", F.col("pageCount").cast("bigint").alias("page_count"), F.col("ocrPageCount").cast("bigint").alias("ocr_pages"), F.col("recommendedMode").alias("recommended_mode"), F.size("pages").cast("bigint").alias("n_pages"))


def fail_fast(spark: SparkSession, d: str) -> DataFrame:
    """What a strict run ends with when the first of all requests is wrong and the others are right."""
    docs = _documents(spark, d)
    first = items(spark, d).where("page_count > 0").agg(F.min("item_id")).first()[0]
    beyond = (F.col("item_id") == first).cast("int")
    wanted = docs.select("item_id", "file_name", F.col("content").alias("data"), F.lit(1.0).alias("page_from"), (F.col("page_count") + beyond).cast("double").alias("page_to"))
    try:
        slicing.slice_documents(wanted).write.format("noop").mode("overwrite").save()
        said = None
    except Exception as e:  # the run ends with the first error
        said = re.search(r"Failed to slice PDF pages [^\n]*?\(\d+\)", str(e))[0]
    return spark.createDataFrame([(said is not None, said)], "failed boolean, message string")


def map_limit(spark: SparkSession, d: str) -> DataFrame:
    """The bounded map over the names of the mixes, a list of fixed length."""
    names = [r["mix_name"] for r in table(spark, d, "mix_targets").where("mix_name is not null").select("mix_name").distinct().orderBy("mix_name").collect()]
    made = concurrency.map_limit(list(enumerate(names)), 3, lambda x: (x[0], x[1].upper()))
    return spark.createDataFrame(made, "place bigint, name string")


def recognize_documents(spark: SparkSession, d: str) -> DataFrame:
    params = ("recognition_mode", "page_selection", "page_from", "page_to", "specific_pages", "ocr_language", "dpi")
    docs = _documents(spark, d, *params).select("item_id", F.col("content").alias("data"), *params)
    r = recognition.recognize(docs, samples.EchoOcr, on_error="collect")
    pages_ = F.col("recognition_result.pages")
    said = F.transform(pages_, lambda x: F.concat_ws(" ", x["page"].cast("string"), x["source"], x["text"], x["confidence"].cast("int").cast("string")))
    return r.select("item_id", "error", F.col("recognition_result.source").alias("source"), F.col("recognition_result.pageCount").cast("bigint").alias("page_count"), F.when(pages_.isNotNull(), F.size(pages_)).cast("bigint").alias("n_pages"), F.md5(F.array_join(said, "|").cast("binary")).alias("pages"))


def queries() -> dict[str, Query]:
    names = (word_count, char_classes, normalize_text, assemble_page_text, recommend_mode, rule_breakdown, rect_clip, union_area, matrix_fold, image_coverage, page_range, specific_pages, selected_pages, slice_validate, preflight_pages, preflight_document, route_auto, recognition_result, context_projection, render_dimensions, pdf_pages, pdf_slice, slice_binaries, fail_fast, preflight_context, map_limit, recognize_documents)
    return {f.__name__: f for f in names}

"""Cutting page ranges out of documents: validation, names, size guard, metadata and the cut itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import errors, pages


def output_name(file_name: Column, first: Column, last: Column) -> Column:
    """Name of a slice; a missing or empty name counts as document.pdf."""
    base = F.regexp_replace(F.coalesce(F.when(file_name != "", file_name), F.lit("document.pdf")), r"(?i)\.pdf\z", "")
    return F.concat(base, F.lit("-pages-"), first.cast("bigint").cast("string"), F.lit("-"), last.cast("bigint").cast("string"), F.lit(".pdf"))


def size_error(size: Column, most: Column) -> Column:
    """Text where a slice is larger than allowed; 0 and null allow any size."""
    return F.when((most > 0) & (size > most), F.format_string(errors.SLICE_TOO_LARGE, size.cast("bigint"), most.cast("bigint")))


def request_error(count: Column, first: Column, last: Column, size: Column, most: Column) -> Column:
    """First error of a request: its pages, then the size of what was made."""
    return F.coalesce(pages.slice_error(count, first, last), size_error(size, most))


def metadata(first: Column, last: Column, count: Column, size: Column) -> list[Column]:
    return [
        first.cast("int").alias("pdf_slice_page_from"),
        last.cast("int").alias("pdf_slice_page_to"),
        (last - first + 1).cast("int").alias("pdf_slice_page_count"),
        count.cast("int").alias("pdf_source_page_count"),
        size.cast("bigint").alias("pdf_slice_size_bytes"),
    ]


def slice_documents(df: DataFrame, input_field: str = "data", output_field: str = "data", on_error: str = "fail") -> DataFrame:
    """Each row's PDF (binary column input_field) cut to page_from..page_to.

    Adds the metadata columns and output_field as struct(data, file_name, mime_type); other binary columns
    are dropped.  max_output_bytes and file_name are used where present.  The cut is one narrow Python pass;
    nothing is shuffled."""
    from pagewright.sources.pdf import cut_udf

    content = errors.binary_field(df, input_field)
    first, last = F.col("page_from"), F.col("page_to")
    most = F.col("max_output_bytes") if "max_output_bytes" in df.columns else F.lit(0)
    name = F.col("file_name") if "file_name" in df.columns else F.lit(None).cast("string")
    made = df.withColumn("_cut", cut_udf(content, first, last))
    n, size = F.col("_cut.page_count"), F.octet_length(F.col("_cut.bytes"))
    shown = [F.when(pages.whole_number(x.cast("double"), 0), x).otherwise(0).cast("bigint") for x in (first, last)]
    wrong = F.coalesce(F.col("_cut.error"), pages.slice_error(n, first.cast("double"), last.cast("double")))
    missing = F.when(content.isNull(), errors.BINARY_MISSING % input_field)
    error = F.coalesce(missing, F.when(wrong.isNotNull(), F.format_string(errors.SLICE_FAILED, *shown, wrong)), size_error(size, most))
    binary = [f.name for f in df.schema if f.dataType.typeName() == "binary"]
    out = made.select(
        *[c for c in df.columns if c not in (*binary, output_field)],
        *metadata(first, last, n, size),
        F.when(error.isNull(), F.struct(F.col("_cut.bytes").alias("data"), output_name(name, first, last).alias("file_name"), F.lit("application/pdf").alias("mime_type"))).alias(output_field),
        error.alias("_error"),
    )
    return errors.handle(out, F.col("_error"), on_error, output_field).drop("_error")

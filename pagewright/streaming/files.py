"""Preflight of PDF files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators import preflight
from pagewright.sources import pdf

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def preflight_files(documents: DataFrame, stop_after: float = 0.0) -> DataFrame:
    """Preflight summary of rows of path and content."""
    pages = pdf.pages(documents, keep=("path",), on_error="collect").where("error is null")
    analysis = preflight.analyze_pages(pages.withColumnRenamed("page_count", "n"), ["path", "n"])
    scanned = preflight.scanned_pages(analysis, "path", F.lit(stop_after))
    return preflight.document_summary(scanned, "path", F.col("n"))


def preflight_stream(spark: SparkSession, source: str, target: str, checkpoint: str, stop_after: float = 0.0, once: bool = False) -> StreamingQuery:
    """Files under source, each once, to parquet under target.  A batch written again after a failure goes
    to the same folder, so nothing doubles."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.pdf").load(source)

    def batch(df: DataFrame, number: int) -> None:
        preflight_files(df.select("path", "content"), stop_after).write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

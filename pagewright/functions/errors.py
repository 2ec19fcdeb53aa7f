"""Errors as columns: computed first, then raised or kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The messages are part of the contract.
BINARY_MISSING = 'Binary field "%s" is missing'
OCR_TIMEOUT = "OCR timed out after %s ms"
OCR_FAILED = "Failed to OCR PDF page %d: %s"
RENDER_FAILED = "Failed to render PDF page %d in isolated renderer: %s"
SLICE_FAILED = "Failed to slice PDF pages %d-%d: %s"
SLICE_TOO_LARGE = "Generated PDF slice is %d bytes and exceeds Max Output Bytes (%d)"
WORKERS_POSITIVE = "PDF renderer worker count must be a positive integer"
RENDERER_CLOSED = "PDF renderer is closed"


def handle(df: DataFrame, error: Column, on_error: str, consume: str) -> DataFrame:
    """on_error 'collect' keeps the rows with an `error` column; 'fail' raises the first error from column
    `consume`, which the result contains, so that the optimizer cannot drop the check."""
    if on_error == "collect":
        return df.withColumn("error", error)
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'collect', not {on_error!r}")
    return df.withColumn(consume, F.when(error.isNotNull(), F.raise_error(error)).otherwise(F.col(consume)))


def binary_field(df: DataFrame, field: str) -> Column:
    """The binary column of that name; a missing one is reported before anything runs."""
    if field not in df.columns:
        raise ValueError(BINARY_MISSING % field)
    return F.col(field)

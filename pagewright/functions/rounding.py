"""Rounding of shares to four places: the exact binary value decides, ties go up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed4(x: Column) -> Column:
    """x in [0, 1] to four places.  Only odd multiples of 1/32 are exact ties at the fifth place; 0.00005 lies
    just above its tie but the decimal formatter reads it as one."""
    return F.when(x == 5e-5, F.lit(1e-4)).when((x * 32) % 2 == 1, F.round(x, 4)).otherwise(F.call_function("format_number", x, F.lit("0.0000")).cast("double"))

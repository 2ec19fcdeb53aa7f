"""The page functions for SQL: temporary functions with SQL bodies, so they stay inside the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .text import BLANKS, LARGE_COVERAGE, LEAST_TEXT_FOR_RATIO, LEAST_WORDS_ON_IMAGE, MOST_INVALID_RATIO, RELEVANT_COVERAGE, WORD

_T, _C = "coalesce(t, '')", "coalesce(c, 0D)"  # as in text.recommended_mode
_WORDS = f"regexp_count({_T}, r\"{WORD}\")"
FUNCTIONS = {
    "count_words(t STRING) RETURNS INT": f"regexp_count(t, r\"{WORD}\")",
    "recommend_page_mode(t STRING, c DOUBLE) RETURNS STRING": (
        f"CASE WHEN regexp_count({_T}, r'[^{BLANKS}\\x00-\\x1F\\x7F\\x{{FFFD}}]') = 0 OR ({_C} > {RELEVANT_COVERAGE} AND {_WORDS} = 0) OR ({_C} >= {LARGE_COVERAGE} AND {_WORDS} < {LEAST_WORDS_ON_IMAGE})"
        f" OR (regexp_count({_T}, r'[\\p{{L}}\\p{{N}}]') >= {LEAST_TEXT_FOR_RATIO} AND regexp_count({_T}, r'[\\x{{FFFD}}\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]') / greatest(octet_length(encode({_T}, 'UTF-16BE')) / 2, 1) > {MOST_INVALID_RATIO})"
        " THEN 'ocr' ELSE 'native' END"
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to a session; gives their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in FUNCTIONS]

"""Page text: assembly from text items, normalisation, character classes, words, and the decision whether a
page's native text is usable or the page needs OCR.  All are Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that count as white space, and the thresholds of the decision.
BLANKS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
WORD = r"[\p{L}\p{N}]+(?:[.'’/-][\p{L}\p{N}]+)*"
LARGE_COVERAGE = 0.8
RELEVANT_COVERAGE = 0.2
LEAST_WORDS_ON_IMAGE = 20
MOST_INVALID_RATIO = 0.01
LEAST_TEXT_FOR_RATIO = 20


def normalize(text: Column) -> Column:
    """Blanks before line ends dropped, other runs of blanks and tabs made one blank, ends trimmed."""
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    return F.regexp_replace(text, rf"\A[{BLANKS}]+|[{BLANKS}]+\z", "")


def assemble(items: Column) -> Column:
    """Text of a page from its ordered items (str, has_eol); an item without a string adds nothing."""
    part = lambda i: F.when(i["str"].isNull(), "").otherwise(F.concat(i["str"], F.when(i["has_eol"], "\n").otherwise(" ")))
    return normalize(F.array_join(F.transform(items, part), ""))


def utf16_length(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def _count(text: Column, kind: str) -> Column:
    """Number of characters of a class, taken run by run, which needs far fewer matches than one by one."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{kind}+", ""))


def meaningful_chars(text: Column) -> Column:
    """Letters and digits."""
    return _count(text, r"[\p{L}\p{N}]")


def valid_chars(text: Column) -> Column:
    """Characters that are neither white space, control nor replacement characters."""
    return _count(text, rf"[^{BLANKS}\x00-\x1F\x7F\x{{FFFD}}]")


def invalid_chars(text: Column) -> Column:
    return _count(text, r"[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")


def invalid_ratio(text: Column) -> Column:
    return invalid_chars(text) / F.greatest(utf16_length(text), F.lit(1))


def reasons_for_ocr(text: Column, coverage: Column) -> dict[str, Column]:
    """Why the native text of a page is of no use: the page shows none, its words are missing where an image lies,
    or what is there can't be read.  Any one is enough."""
    words, letters, shown = word_count(text), meaningful_chars(text), valid_chars(text)
    large, relevant = coverage >= LARGE_COVERAGE, coverage > RELEVANT_COVERAGE
    return {
        "no_valid": shown == 0,
        "no_words": relevant & (words == 0),
        "scanned": large & (words < LEAST_WORDS_ON_IMAGE),
        "broken": (invalid_ratio(text) > MOST_INVALID_RATIO) & (letters >= LEAST_TEXT_FOR_RATIO),
    }


def recommended_mode(text: Column, coverage: Column) -> Column:
    """'ocr' or 'native'.  A null text counts as empty, a null coverage as 0."""
    reasons = reasons_for_ocr(F.coalesce(text, F.lit("")), F.coalesce(coverage, F.lit(0.0)))
    return F.when(reduce(or_, reasons.values()), "ocr").otherwise("native")

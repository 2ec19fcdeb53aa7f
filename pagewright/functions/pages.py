"""Page selection: by range or by list, each with the first rule it breaks as an error text.

A selection is computed as an error column first, so that callers can fail or keep the row; pages are null
where there is an error.  Nulls: a null bound breaks the rule on that bound; a null page count makes the
pages null without an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANKS

# The messages are part of the contract.
FROM_POSITIVE = "Page From must be an integer greater than 0"
TO_ZERO_OR_POSITIVE = "Page To must be 0 or a positive integer"
TO_POSITIVE = "Page To must be an integer greater than 0"
TO_NOT_BEFORE = "Page To must be greater than or equal to Page From"
TO_BEYOND = "Page To cannot exceed the document page count ("
FROM_BEYOND = "Page From cannot exceed the document page count ("
LIST_EMPTY = "Pages must contain at least one page number"
LIST_FORMAT = "Pages must be comma-separated positive integers, for example 1,5,6"
LIST_ZERO = "Pages must contain only integers greater than 0"
LIST_DUPLICATES = "Pages must not contain duplicates"


def whole_number(x: Column, least: int) -> Column:
    """x is an integer of at least `least`; false for null, NaN and infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < 9e15) & (F.floor(x) == x) & (x >= least), F.lit(False))


def _beyond(text: str, count: Column) -> Column:
    return F.concat(F.lit(text), count.cast("int").cast("string"), F.lit(")"))


def range_error(count: Column, first: Column, last: Column) -> Column:
    end = F.when(last == 0, count).otherwise(last)
    return (
        F.when(~whole_number(first, 1), FROM_POSITIVE)
        .when(~whole_number(last, 0), TO_ZERO_OR_POSITIVE)
        .when(end < first, TO_NOT_BEFORE)
        .when(end > count, _beyond(TO_BEYOND, count))
    )


def range_pages(count: Column, first: Column, last: Column) -> Column:
    """Pages first..last of a document, last 0 meaning its end; null where range_error has a text."""
    end = F.when(last == 0, count).otherwise(last)
    ok = range_error(count, first, last).isNull() & count.isNotNull()
    return F.when(ok, F.sequence(F.when(ok, first).cast("int"), F.when(ok, end).cast("int")))


def slice_error(count: Column, first: Column, last: Column) -> Column:
    """Like range_error for slices, where 0 is no page and a start beyond the end is named as such."""
    return (
        F.when(~whole_number(first, 1), FROM_POSITIVE)
        .when(~whole_number(last, 1), TO_POSITIVE)
        .when(last < first, TO_NOT_BEFORE)
        .when(first > count, _beyond(FROM_BEYOND, count))
        .when(last > count, _beyond(TO_BEYOND, count))
    )


def _parts(text: Column) -> Column:
    trim = rf"\A[{BLANKS}]+|[{BLANKS}]+\z"
    return F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.regexp_replace(p, trim, ""))


def _digits(text: Column) -> Column:
    """Parts without leading zeros, so that equal numbers are equal strings however long."""
    return F.transform(_parts(text), lambda p: F.regexp_replace(p, r"\A0+(?=[0-9])", ""))


def _exceeds(digits: Column, count: Column) -> Column:
    return (F.length(digits) > 9) | (F.when(F.length(digits) <= 9, digits).cast("int") > count)


def list_error(count: Column, text: Column) -> Column:
    parts, digits = _parts(text), _digits(text)
    outside = F.filter(digits, lambda d: _exceeds(d, count))
    return (
        F.when(F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{BLANKS}]+", "") == "", LIST_EMPTY)
        .when(F.exists(parts, lambda p: ~p.rlike(r"\A[0-9]+\z")), LIST_FORMAT)
        .when(F.exists(digits, lambda d: d == "0"), LIST_ZERO)
        .when(F.size(F.array_distinct(digits)) != F.size(digits), LIST_DUPLICATES)
        .when(F.size(outside) > 0, F.concat(F.lit("Page "), F.get(outside, F.lit(0)), F.lit(" cannot exceed the document page count ("), count.cast("int").cast("string"), F.lit(")")))
    )


def list_pages(count: Column, text: Column) -> Column:
    """The pages of a list, ascending; null where list_error has a text."""
    ok = list_error(count, text).isNull() & count.isNotNull()
    return F.when(ok, F.array_sort(F.transform(_digits(text), lambda d: F.when(ok, d).cast("int"))))


def selection_error(kind: Column, count: Column, first: Column, last: Column, text: Column) -> Column:
    return F.when(kind == "specific", list_error(count, text)).otherwise(range_error(count, first, last))


def selected_pages(kind: Column, count: Column, first: Column, last: Column, text: Column) -> Column:
    return F.when(kind == "specific", list_pages(count, text)).otherwise(range_pages(count, first, last))

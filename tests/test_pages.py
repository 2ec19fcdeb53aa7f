import math

import pytest
from pyspark.sql import functions as F

from pagewright.functions import pages


def one(spark, schema, row, *columns):
    return list(spark.createDataFrame([row], schema).select(*columns).first())


N, A, B, T = "n", "a", "b", "t"


def on(fn, *names):
    return fn(*map(F.col, names))


@pytest.mark.parametrize(
    ("n", "a", "b", "expected"),
    [
        (4, 1.0, 0.0, [1, 2, 3, 4]), (30, 10.0, 13.0, [10, 11, 12, 13]), (5, 5.0, 5.0, [5]),
        (5, 1.0, 6.0, "page count (5)"), (5, 4.0, 3.0, "greater than or equal"), (5, 6.0, 0.0, "greater than or equal"),
        (5, 0.0, 2.0, "Page From"), (5, 1.5, 2.0, "Page From"), (5, None, 2.0, "Page From"), (5, 1.0, -1.0, "Page To must be 0"), (5, 1.0, math.nan, "Page To must be 0"),
    ],
)
def test_range(spark, n, a, b, expected):
    error, got = one(spark, "n int, a double, b double", (n, a, b), on(pages.range_error, N, A, B), on(pages.range_pages, N, A, B))
    assert (got == expected and error is None) if isinstance(expected, list) else (got is None and expected in error)


@pytest.mark.parametrize(
    ("n", "t", "expected"),
    [
        (10, "6, 1,5", [1, 5, 6]), (10, "", "at least one"), (10, None, "at least one"), (10, "  ", "at least one"), (10, "1,,5", "comma-separated"), (10, "1.5,2", "comma-separated"), (10, "-1", "comma-separated"), (10, "1\x85", "comma-separated"),
        (10, "0,2", "greater than 0"), (10, "2,2", "duplicates"), (10, "01,1", "duplicates"), (5, "1,6", "Page 6 cannot exceed"), (5, "9,8", "Page 9"), (5, "9" * 60, "cannot exceed"), (10, "010", [10]),
    ],
)
def test_list(spark, n, t, expected):
    error, got = one(spark, "n int, t string", (n, t), on(pages.list_error, N, T), on(pages.list_pages, N, T))
    assert (got == expected and error is None) if isinstance(expected, list) else (got is None and expected in error)


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [(1.0, 3.0, None), (0.0, 3.0, "Page From"), (1.0, 0.0, "Page To must be an integer"), (4.0, 3.0, "greater than or equal"), (1.0, 11.0, "Page To cannot exceed the document page count (10)"), (11.0, 11.0, "Page From cannot exceed the document page count (10)")],
)
def test_slice(spark, a, b, expected):
    (error,) = one(spark, "n int, a double, b double", (10, a, b), on(pages.slice_error, N, A, B))
    assert error is None if expected is None else expected in error


def test_unknown_page_count(spark):
    got = one(spark, "n int, a double, b double, t string", (None, 1.0, 2.0, "1"), on(pages.range_pages, N, A, B), on(pages.list_pages, N, T))
    assert got == [None, None]

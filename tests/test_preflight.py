import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import preflight


def run(spark, docs):
    """docs: key -> (modes, k, page_count)"""
    rows = [(k, p + 1, m, 1, 0.5, float(n), c) for k, (modes, n, c) in docs.items() for p, m in enumerate(modes)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "d int, page int, recommended_mode string, word_count int, image_coverage double, k double, n int")
    got = preflight.document_summary(preflight.scanned_pages(df, "d", F.col("k")), "d", F.col("n"))
    return {r["d"]: r.asDict(True) for r in got.collect()}


O, V = "ocr", "native"


@pytest.mark.parametrize(
    ("modes", "k", "count", "mode", "looked", "stopped"),
    [
        ([O, V, O, V], 2, 4, "auto", 3, True), ([O, O], 2, 2, "ocr", 2, False), ([O, O, O], 2, 3, "auto", 2, True), ([V, V], 0, 2, "native", 2, False),
        ([O, V], 0, 2, "auto", 2, False), ([O, O, O], 0.5, 3, "ocr", 3, False), ([O], -3, 1, "ocr", 1, False), ([V, V, V], 1, 3, "native", 3, False),
    ],
)
def test_documents(spark, modes, k, count, mode, looked, stopped):
    r = run(spark, {1: (modes, k, count)})[1]
    assert (r["recommendedMode"], r["analyzedPageCount"], r["ocrThresholdExceeded"], r["analysisComplete"], r["pageCount"]) == (mode, looked, stopped, not stopped, count)
    assert [p["page"] for p in r["pages"]] == list(range(1, looked + 1))
    assert r["ocrPageCount"] + r["nativePageCount"] == looked


def sequential(modes, k):
    k, ocr, looked = max(0, int(k)), 0, 0
    for p, m in enumerate(modes, 1):
        looked, ocr = p, ocr + (m == O)
        if k and ocr >= k and p < len(modes):
            return looked, ocr, True
    return looked, ocr, False


def test_against_a_sequential_scan(spark):
    rng = random.Random(7)
    docs = {i: ([rng.choice([O, V]) for _ in range(rng.randint(1, 15))], rng.randint(0, 4), None) for i in range(150)}
    docs = {i: (m, k, len(m)) for i, (m, k, _) in docs.items()}
    got = run(spark, docs)
    assert {i: (r["analyzedPageCount"], r["ocrPageCount"], r["ocrThresholdExceeded"]) for i, r in got.items()} == {i: sequential(m, k) for i, (m, k, _) in docs.items()}


def test_context_survives_and_computed_keys_win(spark):
    docs = spark.createDataFrame([(1, 2, "a.pdf", "old", 0.0), (2, 3, "b.pdf", "old", None)], "item_id int, page_count int, file_name string, recommendedMode string, k double")
    pages = spark.createDataFrame([(1, 1, "Text genug", 0.0), (1, 2, None, None)], "item_id int, page int, text string, image_coverage double")
    got = {r["item_id"]: r.asDict(True) for r in preflight.preflight(docs, pages, stop_after="k").collect()}
    assert got[1]["recommendedMode"] == "auto" and got[1]["file_name"] == "a.pdf" and got[1]["nativePageCount"] == 1
    assert got[2]["recommendedMode"] == "auto" and got[2]["pages"] == [] and got[2]["pageCount"] == 3 and got[2]["analysisComplete"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "item_id int, page_count int")
    pages = spark.createDataFrame([], "item_id int, page int, text string, image_coverage double")
    assert preflight.preflight(docs, pages).collect() == []

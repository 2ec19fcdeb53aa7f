import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagewright.operators import recognition
from pagewright.operators.concurrency import map_limit


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't see the tests


class Fake:
    """Deterministic stand-in for an OCR engine; images as wide as 13 fail, as wide as 14 take long."""

    def __init__(self):
        self.calls = 0

    def recognize(self, image, language, settings):
        width = int.from_bytes(image[16:20], "big")
        self.calls += 1
        if width == 13:
            raise ValueError("smudged")
        if width == 14:
            time.sleep(30)
        return f"{language} {width} at {settings['user_defined_dpi']} {settings['psm']}", float(self.calls)

    def close(self):
        pass


def png(width):
    return b"\x89PNG" + b"\0" * 12 + width.to_bytes(4, "big") + (1).to_bytes(4, "big")


def test_settings_reach_the_engine():
    assert recognition.engine_settings(300) == {"oem": "lstm_only", "psm": "auto", "preserve_interword_spaces": "1", "user_defined_dpi": "300"}
    e = recognition.EngineProcess(Fake)
    assert e.recognize(png(7), "deu", recognition.engine_settings(150), 5000) == ("deu 7 at 150 auto", 1.0)
    e.close()


def test_a_late_engine_ends_with_its_process():
    e = recognition.EngineProcess(Fake)
    assert e.recognize(png(1), "deu", recognition.engine_settings(72), 0)[1] == 1.0
    late = e.process
    began = time.time()
    with pytest.raises(TimeoutError, match="OCR timed out after 200 ms"):
        e.recognize(png(14), "deu", recognition.engine_settings(72), 200)
    assert time.time() - began < 5 and not late.is_alive()
    assert e.recognize(png(2), "deu", recognition.engine_settings(72), None) == ("deu 2 at 72 auto", 1.0)  # a new engine
    with pytest.raises(RuntimeError, match="smudged"):
        e.recognize(png(13), "deu", recognition.engine_settings(72), 200)
    e.close()
    e.close()


def test_results(spark):
    rows = [(1, 2, "ocr"), (1, 1, "native"), (2, 1, "ocr"), (2, 4, "ocr")]
    df = spark.createDataFrame([(d, p, s, "t", None, 9, "specific" if d == 2 else "range", [1, 2] if d == 1 else [1, 4]) for d, p, s in rows], "d int, page int, source string, text string, confidence double, n int, kind string, asked array<int>")
    got = {r["d"]: r["recognition_result"].asDict(True) for r in recognition.document_results(df, "d", "n", "kind", "asked").collect()}
    assert got[1]["source"] == "mixed" and got[1]["range"] == {"from": 1, "to": 2} and got[1]["selectedPages"] is None
    assert got[2]["source"] == "ocr" and got[2]["range"] is None and got[2]["selectedPages"] == [1, 4]
    assert [p["page"] for p in got[1]["pages"]] == [1, 2]


def test_context_drops_old_results(spark):
    df = spark.createDataFrame([(1,) * 10], ["id", *recognition.DROPPED, "analyzedPageCount"])
    assert recognition.context(df).columns == ["id", "analyzedPageCount"]


def test_render_size(spark):
    df = spark.createDataFrame([(200.0, 144.0), (595.276, 300.0)], "p double, d double")
    assert [r[0] for r in df.select(recognition.render_size(F.col("p"), F.col("d"))).collect()] == [400, 2481]


def test_bounded_map():
    active, most = 0, 0

    def fn(x):
        nonlocal active, most
        active += 1
        most = max(most, active)
        active -= 1
        return 2 * x

    assert map_limit([1, 2, 3, 4, 5, 6], 1, fn) == [2, 4, 6, 8, 10, 12] and most == 1


def test_documents_end_to_end(spark):
    from pagewright.sources import samples

    words = b"BT " + b" ".join(b"(word%d) Tj" % i for i in range(25)) + b" ET"
    scan = b"q 100 0 0 100 0 0 cm /Im1 Do Q"
    doc = samples.make_pdf([(100, 100, words), (100, 100, scan), (100, 100, words)])
    rows = [
        (1, doc, "auto", "range", 1.0, 0.0, None, "a", 72, None), (2, doc, "native", "specific", None, None, "3,1", "b", 72, None), (3, doc, "ocr", "range", 2.0, 3.0, None, "c", None, None),
        (4, doc, "auto", "range", 1.0, 9.0, None, "d", 72, None), (5, b"junk", "auto", "range", 1.0, 0.0, None, "e", 72, None), (6, None, "auto", "range", 1.0, 0.0, None, "f", 72, None),
        (7, samples.make_pdf([(10, 10, b""), (13, 10, b"")]), "ocr", "range", 1.0, 0.0, None, "g", 72, None), (8, samples.make_pdf([(14, 10, b""), (10, 10, b"")]), "ocr", "range", 1.0, 0.0, None, "h", 72, 300.0),
        (None, doc, None, None, None, None, None, None, 72, None), (1, doc, "auto", "range", 3.0, 3.0, None, "again", 72, None),
    ]
    schema = "item_id int, data binary, recognition_mode string, page_selection string, page_from double, page_to double, specific_pages string, pageCount string, dpi int, timeout_ms double"
    df = spark.createDataFrame(rows, schema).withColumn("_content_", F.lit(1))
    all_ = recognition.recognize(df, Fake, on_error="collect").collect()
    got = {r["item_id"]: r for r in all_[::-1]}
    one = got[1]["recognition_result"].asDict(True)
    assert one["source"] == "mixed" and one["pageCount"] == 3 and one["range"] == {"from": 1, "to": 3} and [p["source"] for p in one["pages"]] == ["native", "ocr", "native"]
    assert one["pages"][1]["text"] == "deu 100 at 72 auto" and one["pages"][0]["text"].startswith("word0 word1") and "pageCount" not in got[1].asDict()
    two = got[2]["recognition_result"].asDict(True)
    assert two["selectedPages"] == [1, 3] and two["source"] == "native" and two["range"] is None
    assert [p["page"] for p in got[3]["recognition_result"]["pages"]] == [2, 3] and got[3]["recognition_result"]["source"] == "ocr"
    assert got[3]["recognition_result"]["pages"][0]["text"] == "deu 417 at 300 auto"
    assert got[4]["error"] == "Page To cannot exceed the document page count (3)" and got[4]["recognition_result"] is None
    assert "Invalid PDF" in got[5]["error"] and got[6]["error"] == 'Binary field "data" is missing'
    assert got[7]["error"] == "Failed to OCR PDF page 2: smudged" and got[8]["error"] == "Failed to OCR PDF page 1: OCR timed out after 300 ms"
    assert got[None]["recognition_result"]["source"] == "mixed" and len(all_) == len(rows)  # keys may be null or stand twice
    strict = recognition.recognize(df.where("item_id < 4"), Fake)
    assert sorted(r["item_id"] for r in strict.collect()) == [1, 1, 2, 3]
    plan = strict._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no document is shuffled
    assert recognition.recognize(df.limit(0), Fake).collect() == []
    with pytest.raises(Exception, match="cannot exceed the document page count"):
        recognition.recognize(df.where("item_id = 4"), Fake).collect()
    with pytest.raises(Exception, match="Failed to OCR PDF page 2: smudged"):
        recognition.recognize(df.where("item_id = 7"), Fake).collect()


def broken_renderer(doc, page, dpi):
    raise ValueError("no fonts")


def test_render_errors_are_named(spark):
    from pagewright.functions import errors
    from pagewright.sources import render, samples

    doc = samples.make_pdf([(10, 10, b"")])
    for n in (0, -1, 1.5, True):
        with pytest.raises(ValueError, match=errors.WORKERS_POSITIVE):
            render.PageRenderer(doc, n)
    images = render.PageRenderer(doc, 2)
    assert images.render(1, 72).startswith(b"\x89PNG")
    with pytest.raises(RuntimeError, match="Failed to render PDF page 2 in isolated renderer: Page 2 does not exist"):
        images.render(2, 72)
    images.close()
    images.close()
    with pytest.raises(RuntimeError, match=errors.RENDERER_CLOSED):
        images.render(1, 72)
    df = spark.createDataFrame([(1, doc, "ocr")], "item_id int, data binary, recognition_mode string")
    r = recognition.recognize(df, Fake, on_error="collect", renderer=broken_renderer).first()
    assert r["error"] == "Failed to render PDF page 1 in isolated renderer: no fonts"
    rows = spark.createDataFrame([(1, 1, 72.0, doc), (1, 5, 72.0, doc), (2, 1, 72.0, b"junk")], "item_id int, page int, dpi double, content binary")
    kept = render.render_pages(rows, lambda k, page, image: (len(image),), "size int", on_error="collect").collect()
    assert [(x["item_id"], x["page"], (x["size"] or 0) > 50) for x in kept] == [(1, 1, True), (1, 5, False), (2, 1, False)]
    assert "Page 5 does not exist" in kept[1]["error"] and "isolated renderer" in kept[2]["error"] and kept[0]["error"] is None
    with pytest.raises(Exception, match="isolated renderer"):
        render.render_pages(rows, lambda k, page, image: (len(image),), "size int").collect()

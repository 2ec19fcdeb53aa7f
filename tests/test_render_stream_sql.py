import struct
import zlib

import numpy as np

from pyspark.sql import functions as F

from pagewright.functions import sql, text
from pagewright.sources import pdf, render, samples
from pagewright.streaming import files

CONTENT = samples.make_pdf([(200, 200, b"1 0 0 rg 50 50 100 25 re f")])


def pixels(png):
    w, h = struct.unpack(">II", png[16:24])
    data = zlib.decompress(png[png.index(b"IDAT") + 4 : png.index(b"IEND") - 8])
    return np.frombuffer(data, np.uint8).reshape(h, 1 + 3 * w)[:, 1:].reshape(h, w, 3)


def test_drawing():
    png = render.draw(pdf.Document(CONTENT), 1, 144)
    assert png.startswith(b"\x89PNG") and len(png) > 100
    p = pixels(png)
    assert p.shape == (400, 400, 3)
    red = np.argwhere((p == (255, 0, 0)).all(-1))
    assert red.min(0).tolist() == [250, 100] and red.max(0).tolist() == [299, 299]


def test_rendering_rows(spark):
    df = spark.createDataFrame([(1, 1, 72.0, CONTENT)], "item_id int, page int, dpi double, content binary")
    out = render.render_pages(df, lambda k, page, png: (k, page, len(png)), "item_id int, page int, size int").first()
    assert out["size"] > 100


def test_sql_functions(spark):
    assert sql.register(spark) == ["count_words", "recommend_page_mode"]
    rows = spark.sql("select count_words(\"a-b c’d e\"), recommend_page_mode('---', 0.2D), recommend_page_mode('---', 0.201D), recommend_page_mode('', 0D)").first()
    assert list(rows) == [3, "native", "ocr", "ocr"]
    texts = [(None, None), (None, 0.9), ("word " * 25, None), ("word", 0.9), ("a" * 30 + "\ufffd" * 3, 0.0), ("", 0.1)]
    df = spark.createDataFrame(texts, "t string, c double")
    assert [a == b for a, b in df.select(F.expr("recommend_page_mode(t, c)"), text.recommended_mode(F.col("t"), F.col("c"))).collect()] == [True] * len(texts)


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.pdf").write_bytes(samples.make_pdf([(100, 100, b"BT (Hello there) Tj ET"), (100, 100, b"q 100 0 0 100 0 0 cm /Im1 Do Q")]))
    (source / "bad.pdf").write_bytes(b"junk")
    for _ in range(2):  # a file is taken once
        files.preflight_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"), once=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 1 and (rows[0]["pageCount"], rows[0]["ocrPageCount"], rows[0]["recommendedMode"]) == (2, 1, "auto")

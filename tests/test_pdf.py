import pytest
from pyspark.sql import functions as F

from pagewright.functions import geometry, text
from pagewright.operators import slicing
from pagewright.sources import pdf, samples


def sized(n, compressed=False):
    return samples.make_pdf([(200 + i, 300 + i, b"BT /F1 12 Tf 10 100 Td (Page %d \\(x\\)) Tj 0 -14 Td [(sec) -300 (ond)] TJ ET" % (i + 1)) for i in range(n)], compressed)


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize(("n", "a", "b"), [(10, 4, 10), (10, 1, 3), (5, 3, 3), (6, 2, 4)])
def test_cut_keeps_the_pages(n, a, b, compressed):
    made = pdf.cut(pdf.Document(sized(n, compressed)), a, b)
    assert made.startswith(b"%PDF-")
    got = list(pdf.read_pages(made))
    assert [(p["width"], p["height"]) for p in got] == [(199 + k, 299 + k) for k in range(a, b + 1)]
    assert [p["items"][0]["str"] for p in got] == [f"Page {k} (x)" for k in range(a, b + 1)]


def test_cut_of_a_cut_reads_object_and_xref_streams():
    once = pdf.cut(pdf.Document(sized(8)), 2, 7)
    again = pdf.cut(pdf.Document(once), 3, 4)
    assert pdf.page_count(once) == 6 and [p["width"] for p in pdf.read_pages(again)] == [203, 204]


def test_broken_cross_reference_is_scanned():
    assert pdf.page_count(sized(4).replace(b"startxref", b"startxxxx")) == 4


def test_no_pdf():
    with pytest.raises(pdf.PdfError):
        pdf.page_count(b"hello")


def test_pages_to_text_and_coverage(spark):
    content = samples.make_pdf([(100, 100, b"BT /F1 9 Tf 1 0 0 1 5 90 Tm (Hello) Tj (world) Tj 0 -10 Td (next) Tj ET q 50 0 0 100 0 0 cm /Im1 Do Q q 50 0 0 100 50 0 cm BI /W 1 /H 1 /BPC 8 /CS /G ID \xff EI Q")])
    df = spark.createDataFrame([(1, content)], "id int, content binary")
    r = pdf.pages(df, keep=("id",)).select("page", "page_count", text.assemble(F.col("items")).alias("t"), geometry.image_coverage(F.col("width"), F.col("height"), F.col("ops")).alias("c")).first()
    assert (r["page"], r["page_count"], r["t"], r["c"]) == (1, 1, "Hello world\nnext", 1.0)


def test_wanted_pages_and_errors(spark):
    df = spark.createDataFrame([(1, sized(5), [4, 2]), (2, b"junk", None), (3, None, None)], "id int, content binary, want array<int>")
    got = pdf.pages(df, keep=("id",), wanted="want", on_error="collect").collect()
    assert [(r["id"], r["page"]) for r in got] == [(1, 4), (1, 2), (2, None), (3, None)]
    assert got[2]["error"] and 'Binary field "content" is missing' in got[3]["error"]


def test_slices(spark):
    rows = [(1, sized(10), "A.PDF", 1.0, 2.0, 0), (2, sized(10), None, 4.0, 3.0, 0), (3, sized(10), "", 11.0, 11.0, 0), (4, sized(10), "b.pdf", 1.0, 10.0, 5), (5, None, "c.pdf", 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "id int, data binary, file_name string, page_from double, page_to double, max_output_bytes long")
    got = {r["id"]: r for r in slicing.slice_documents(df, on_error="collect").collect()}
    assert got[1]["error"] is None and got[1]["data"]["file_name"] == "A-pages-1-2.pdf" and got[1]["pdf_slice_page_count"] == 2 and got[1]["pdf_source_page_count"] == 10
    assert got[1]["pdf_slice_size_bytes"] == len(got[1]["data"]["data"])
    assert got[2]["error"] == "Failed to slice PDF pages 4-3: Page To must be greater than or equal to Page From"
    assert "Page From cannot exceed the document page count (10)" in got[3]["error"]
    assert "exceeds Max Output Bytes (5)" in got[4]["error"] and got[4]["data"] is None
    assert got[5]["error"] == 'Binary field "data" is missing'
    with pytest.raises(Exception, match="greater than or equal"):
        slicing.slice_documents(df.where("id = 2")).collect()
    with pytest.raises(ValueError, match='Binary field "x" is missing'):
        slicing.slice_documents(df, input_field="x")


def test_names(spark):
    df = spark.createDataFrame([("A.PDF",), ("",), (None,), ("a.pdf.pdf",)], "n string")
    got = [r[0] for r in df.select(slicing.output_name(F.col("n"), F.lit(1.0), F.lit(2.0))).collect()]
    assert got == ["A-pages-1-2.pdf", "document-pages-1-2.pdf", "document-pages-1-2.pdf", "a.pdf-pages-1-2.pdf"]

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text

CASES = [  # text, coverage, mode
    ("", 0.0, "ocr"),
    (" \n\t\x00", 0.02, "ocr"),
    ("---", 0.2, "native"),
    ("---", 0.201, "ocr"),
    ("Seite 4 von 4", 1.0, "ocr"),
    ("Vertrag " * 25, 1.0, "native"),
    ("Hinweis", 0.5, "native"),
    ("Vertragstext " * 2 + "�" * 30, 0.0, "ocr"),
    ("wort " * 19, 0.8, "ocr"),
    ("wort " * 20, 0.8, "native"),
    ("wort", 0.7999, "native"),
    ("a" * 19 + "�" * 5, 0.0, "native"),
    ("a" * 99 + "�", 0.0, "native"),
    ("a" * 98 + "��", 0.0, "ocr"),
    (" ﻿", 0.0, "ocr"),
    (None, None, "ocr"),
    ("Text", None, "native"),
]


def test_modes_and_their_boundaries(spark):
    df = spark.createDataFrame([(i, t, c) for i, (t, c, _) in enumerate(CASES)], "i int, t string, c double")
    got = {r["i"]: r["m"] for r in df.select("i", text.recommended_mode(F.col("t"), F.col("c")).alias("m")).collect()}
    assert [got[i] for i in range(len(CASES))] == [m for *_, m in CASES]


@pytest.mark.parametrize(
    ("t", "n"),
    [("Zahlungsanforderung 26 BA22-01151 9.478.505,84", 5), ("", 0), ("a-b c/d e.f g’h i'j", 5), ("a--b", 2), ("é", 1), ("é x", 2), ("привет мир", 2)],
)
def test_words(spark, t, n):
    assert spark.createDataFrame([(t,)], "t string").select(text.word_count(F.col("t"))).first()[0] == n


def test_units_count_as_utf16(spark):
    row = spark.createDataFrame([("aé🤦x",)], "t string").select(text.utf16_length(F.col("t"))).first()
    assert row[0] == 5


def test_assembly(spark):
    item = "array<struct<str:string,has_eol:boolean>>"
    rows = [([("a", False), ("b", True), ("c", False)],), ([("a", False), (None, True), ("  \t", True), ("b ", None)],), ([],)]
    got = [r[0] for r in spark.createDataFrame(rows, f"i {item}").select(text.assemble(F.col("i"))).collect()]
    assert got == ["a b\nc", "a\nb", ""]


def test_single_tab_stays_and_trimming_knows_all_blanks(spark):
    got = spark.createDataFrame([("﻿ a\tb  c \t\n d　",)], "t string").select(text.normalize(F.col("t"))).first()[0]
    assert got == "a\tb c\n d"

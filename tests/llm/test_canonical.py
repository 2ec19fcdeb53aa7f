import unicodedata as ud

from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import canonical as C

SAME = [
    ("Kündigung", "Kündigung"), ("ABC 12", "ＡＢＣ　１２"), ("offiziell", "oﬃziell"), ("Vor-Ort", "Vor‑Ort"), ("E-Mail", "E‐Ma​il"), ("a b c", "a b c"),
    ("Prüfer", "Рrüfеr"), ("Kelvin", "Kelvin"), ("Ångström", "Ångström"), ("Rechen", "Re­chen"), ("Ёлка", "Ёлка"), ("éx", "é﻿x"), ("nо", "no"), ("a\nb", "a\r\nb"),
]
DIFFERENT = [("m²", "m2"), ("a", "A"), ("resume", "résumé"), ("a – b", "a - b"), ("a\nb", "a b"), ("a  b", "a b"), ("“a”", "\"a\""), ("й", "и"), ("№ 5", "No 5")]


def test_what_reads_the_same():
    for a, b in SAME:
        assert C.skeleton(a) == C.skeleton(b) and C.canonical(a) == C.canonical(b), (a, b)


def test_what_a_reader_tells_apart():
    for a, b in DIFFERENT:
        assert C.skeleton(a) != C.skeleton(b), (a, b)


def test_words_keep_one_script():
    assert C.canonical("Прuвет, мир; Оперaтор") == "Прuвет, мир; Оператор"
    assert C.canonical("Сoffee") == "Coffee"


def folded_whole(s):
    folds, *_ = C.tables()
    return ud.normalize("NFC", s.replace("\r\n", "\n").translate(folds).replace("\r", "\n"))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abeioüé \ņ̣́̈​ﬁＡKÅ각가각 x")))
def test_splicing_equals_normalising_the_whole(s):
    assert C.stabilise(s) == folded_whole(s)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_canonical_form_is_stable(s):
    once = C.canonical(s)
    assert C.canonical(once) == once


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("аеоруАВСЁёйщЯ их12-.\nabceoüë́Αο")))
def test_short_and_long_way_agree(s):
    assert C.canonical(s) == C._by_word(C.skeleton(s))


def pairs_by_force(rows):
    ids = {i: t for i, t in rows if t and C.skeleton(t).strip()}
    return {(a, b) for a in ids for b in ids if a < b and ids[a] != ids[b] and C.skeleton(ids[a]) == C.skeleton(ids[b])}


def test_pairs(spark):
    rows = [(1, "Prüfer"), (2, "Prüfer"), (3, "Prüfer"), (4, "Рrüfer"), (5, None), (6, ""), (7, " "), (8, " "), (9, "x" * 50_000 + "ﬁ"), (10, "x" * 50_000 + "fi"), (2, "Prüfer"), (11, "​")]
    df = spark.createDataFrame([(i, t, 1, "k", b"h", 3) for i, t in rows], "result_id long, text string, id int, key string, text_hash binary, salts int")
    for size in (2000, 1):  # one row a cell: every pair of texts is split
        got = [tuple(r) for r in C.equal_looking_pairs(df, rows_per_cell=size).collect()]
        assert set(got) == pairs_by_force(rows)
    assert C.equal_looking_pairs(df.limit(0)).collect() == []


def test_classes(spark):
    rows = [(1, "Prüfer"), (2, "Prüfer"), (3, "Pru\u0308fer"), (4, "\u0420rüfer"), (5, None), (6, ""), (9, "alone"), (2, "Prüfer")]
    df = spark.createDataFrame([(i, t, 1, "k", b"h", 3) for i, t in rows], "result_id long, text string, class_id int, key string, text_hash binary, links int")
    got = {tuple(r) for r in C.reading_classes(df).collect()}
    assert got == {(1, 1, 3, 2), (2, 1, 3, 2), (3, 1, 3, 3), (4, 1, 3, 3), (9, 9, 1, 0)}
    assert C.reading_classes(df.limit(0)).collect() == []


def test_many_copies_and_one_variant(spark):
    """Linear: 100,000 copies of one text and one text that reads the same."""
    df = spark.range(100_001).selectExpr("id as result_id", "if(id = 77, 'Stock\u00a0page', 'Stock page') as text")
    pairs = C.equal_looking_pairs(df)
    r = pairs.selectExpr("count(*) n", "count(distinct result_id_a, result_id_b) d", "count_if(result_id_a = 77 or result_id_b = 77) v", "count_if(result_id_a >= result_id_b) w").first()
    assert tuple(r) == (100_000, 100_000, 100_000, 0)
    c = C.reading_classes(df).selectExpr("sum(links) l", "max(class_id) c", "count(*) n").first()
    assert tuple(c) == (200_000, 0, 100_001)


def test_letters_of_further_alphabets():
    assert C.canonical("\U0001d407ello \U0001d7d9") == "Hello 1" and C.skeleton("\u13aapple") == "Apple" and C.skeleton("h\u0585w") == "how"
    assert C.skeleton("\u0391\u0301") == C.skeleton("Á") and C.skeleton("с\u0327a") == C.skeleton("ça")


def test_joiners_that_show_are_kept():
    for kept in ("\u0645\u06cc\u200c\u062e\u0648\u0627\u0647\u0645", "\U0001f468\u200d\U0001f469\u200d\U0001f467", "\u0915\u094d\u200d\u0937"):
        assert C.canonical(kept) == kept and C.skeleton(kept) != C.skeleton(kept.replace("\u200c", "").replace("\u200d", ""))
    assert C.canonical("E\u200d-M\u200cail") == "E-Mail"


def test_only_touched_segments_are_normalised(monkeypatch):
    C.tables(), C._accented()
    seen = []
    whole = ud.normalize
    monkeypatch.setattr(C.ud, "normalize", lambda form, s: seen.append(len(s)) or whole(form, s))
    assert C.skeleton("Бухгалтерия и оборудование. " * 500 + "а\u0301") .endswith("á") and max(seen) < 10


def test_deliveries_are_found_by_their_ids(spark):
    from pagewright.llm.common import once

    df = spark.createDataFrame([(i % 900 if i % 10 else None, "t") for i in range(1000)], "result_id long, text string")
    got = [r["result_id"] for r in once(df, "result_id").collect()]
    assert len(got) == len(set(got)) == df.select("result_id").distinct().count()


def test_texts(spark):
    df = spark.createDataFrame([(1, "ﬁn"), (2, None), (3, ""), (1, "ﬁn")], "result_id long, text string")
    got = {r["result_id"]: (r["canonical_text"], r["changed"]) for r in C.canonical_texts(df).collect()}
    assert got == {1: ("fin", True), 2: (None, None), 3: ("", False)}

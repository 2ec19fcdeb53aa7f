import random

import pytest

from pagewright.llm import quality as Q

PROSE = "Der Gutachter prüft die Unterlagen ohne weitere Rücksprache. Das Labor erstellt einen ausführlichen Bericht nach Abschluss der Arbeiten."
KINDS = [
    (PROSE, "prose"), (PROSE.replace(" ", "\n"), "prose"), ("3. Haftung\n\n" + PROSE + "\n- 3 -", "prose"), (PROSE.encode().decode("cp1252"), "prose"),
    ("Эксперт проверяет присланные документы без согласований. Отчёт готовит лаборатория.".encode().decode("latin-1"), "prose"),
    ("Anlagen KD 1\n- Haftung\n- Vergütung\n- Der Lieferant (Quildano GmbH)\n- Prüfverfahren, nach Abschluss", "list"),
    ("Inhalt\nDer Lieferant ........ 12\nHaftung ............. 14\nVergütung ......... 20\nAnlagen ....... 31", "list"),
    ("Datum  Preis  Artikel\n27.04.19  1871,36  A41-405\n98  264,11  B14-300\n12  7,50  C20-111\n-  55  D33-409", "table"),
    ("Datum;Preis;Artikel\n27.04.19;1871,36;A41-405\n98;264,11;B14-300\n12;7,50;C20-111", "table"),
    ("kcgyx wsb bbbxxz dnxjgsb hhgsg thbm\njklswk gnwwhnhqk vmmgy wnczdjk qws", "junk"), ("����� ��� Tx����� ����4 ������N ��� ������� �������� ��", "junk"),
    ("(cid:185)(cid:136)(cid:71)(cid:68) (cid:53)(cid:11)(cid:105)", "junk"), ("lllll lll lllllll xxxx xxx rnrnrn rnrn ooo oooooo lllll lllll", "junk"), ("   " * 5, "junk"),
    ("c866560d 84aeb799 73436445 88381e61 325c652e 41da3440", "junk"), ("zu kurz", None), ("", None),
]


@pytest.mark.parametrize(("text", "kind"), KINDS)
def test_kinds(text, kind):
    assert Q.PageStats(frozenset({"der", "die", "das"}))(text)[0] == kind


def test_repetition():
    _, s = Q.PageStats(frozenset())("a b c d e f\n" * 10 + "\nx y\n\nx y")
    assert s["duplicate_line_share"] > 0.8 and s["duplicate_paragraph_share"] == pytest.approx(1 / 3)
    assert s["repeated_5gram_coverage"] > 0.5 and 0 < s["top_bigram_coverage"] < 1


@pytest.mark.parametrize("text", ["n/a " * 30, "no data " * 30, "see next page " * 20])
def test_few_words_in_a_cycle(text):
    assert Q.PageStats(frozenset())(text)[1]["repeated_5gram_coverage"] > 0.85


@pytest.mark.parametrize("text", ["test " * 40, "foo bar " * 40, "lorem ipsum dolor " * 40, "Please sign here and return this form. " * 20, (PROSE + "\n\n") * 6])
def test_what_says_the_same_again_is_boilerplate(text):
    assert Q.PageStats(frozenset())(text)[0] == "boilerplate"


def test_repetition_tells_lists():
    """Long entries are a list by the marks that recur, not by their length."""
    long_ = "the supplier of the northern plant and all of its present and former branches without exception"
    page = "\n".join(f"{m} {long_.replace('northern', w)}" for m, w in zip("*" * 5, ("northern", "old", "new", "large", "small"), strict=True))
    kind, s = Q.PageStats(frozenset())(page)
    assert kind in ("list", "boilerplate") and s["repeated_mark_share"] == 1.0
    _, plain = Q.PageStats(frozenset())(page.replace("* ", ""))
    assert plain["repeated_mark_share"] == 0.0


def test_long_text():
    rng = random.Random(1)
    varied = " ".join(" ".join(rng.choice(PROSE.replace(".", "").split()).lower() for _ in range(12)).capitalize() + "." for _ in range(3000))
    assert Q.PageStats(frozenset())(varied)[0] == "prose"


def test_documents(spark):
    texts = dict(KINDS[i] for i in ())
    rows = [(1, 1, PROSE, 10, 0.5), (2, 1, KINDS[5][0], None, None), (3, 1, KINDS[6][0], 3, 1.0), (3, 1, KINDS[6][0], 3, 1.0), (4, 2, KINDS[7][0], 1, 0.0), (5, 2, PROSE, 1, 0.0), (6, 3, None, None, None), (7, None, KINDS[9][0], 1, 0.1), (8, 4, "", 0, 0.0)]
    assert texts == {}
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "analysis_id long, item_id long, text string, word_count int, image_coverage double, kind string, n_words int")
    common = spark.createDataFrame([("deu", 1, "der")], "lang string, freq_rank int, word string")
    got = {r["item_id"]: r for r in Q.document_stats(Q.page_stats(df, common)).collect()}
    assert got[1]["kind"] == "list" and got[1]["list_pages"] == 2 and got[1]["pages"] == 3 and got[1]["countable_pages"] == 3
    assert got[2]["kind"] is None  # half and half
    assert got[3]["kind"] is None and got[3]["countable_pages"] == 0 and got[4]["kind"] is None
    assert Q.document_stats(Q.page_stats(df.limit(0), common.limit(0))).collect() == []

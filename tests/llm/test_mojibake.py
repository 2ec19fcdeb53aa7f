from pagewright.llm import mojibake as M

CLEAN = "Der Gutachter prüft die größeren Räume für die Übergabe – „wie besichtigt“ über 25,00 €"
RUS = "Бухгалтерия подтверждает получение ответа и хранит оборудование"


def spoiled(s, write, read):
    return M._read(s.encode(write), read)


def rows():
    out = [("page_results", i, CLEAN) for i in range(1, 30)] + [("page_results", i, RUS) for i in range(30, 60)]
    bad = {
        100: spoiled(CLEAN, "utf-8", "cp1252"), 101: spoiled(CLEAN, "utf-8", "latin-1"), 102: spoiled(CLEAN, "utf-8", "mac_roman"), 103: spoiled(spoiled(CLEAN, "utf-8", "cp1252"), "utf-8", "cp1252"),
        104: spoiled(CLEAN, "cp1252", "mac_roman"), 105: spoiled(CLEAN, "cp1252", "cp850"), 106: CLEAN.encode("cp1252").decode("utf-8", "replace"), 107: CLEAN.replace("prüft", "pr�ft"),
        108: spoiled(RUS, "utf-8", "cp1252"), 109: spoiled(RUS, "cp1251", "koi8-r"), 110: spoiled(RUS, "utf-8", "cp1251"), 111: spoiled(RUS, "cp1251", "latin-1"),
    }
    out += [("page_analysis", i, t) for i, t in bad.items()]
    out += [("page_analysis", 200, "Tx����� ���� ����4 für"), ("page_analysis", 201, "Ñandú Óptica, (Ãlvera) Â. Perrault-Dômez ¼-Zoll Ðorvik"), ("page_analysis", 202, None), ("page_analysis", 203, ""), ("page_analysis", 204, "plain ascii"), ("page_analysis", 205, "ü" * 5000)]
    return out + out[-12:], bad


def frame(spark, r):
    return spark.createDataFrame([(*x, "w", 1) for x in r], "tab string, row_id long, text string, word string, n int")


def test_affected_rows(spark):
    r, bad = rows()
    got = {(x["tab"], x["row_id"]) for x in M.affected_words(frame(spark, r)).collect()}
    assert got == {("page_analysis", i) for i in bad}


def test_restored(spark):
    r, bad = rows()
    got = {x["row_id"]: x["restored_text"] for x in M.restored_texts(frame(spark, r)).collect()}
    # what was replaced for good can't be told apart where it stood alone
    assert {i for i in bad if got[i] != (RUS if i >= 108 else CLEAN)} <= {106}
    assert "prüft" in got[106] and "größeren" in got[106]


def test_empty(spark):
    assert M.affected_words(frame(spark, rows()[0]).limit(0)).collect() == []


def test_forms_can_be_decoded_back():
    for form, chain, _ in M.garbled_forms("größere"):
        if chain == "utf-8>cp1252":
            assert form.encode("cp1252").decode("utf-8") == "größere"

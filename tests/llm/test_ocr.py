import pytest

from pagewright.llm import ocr as O

BODY = ["Der Gutachter verschiebt die nächste Begehung und lagert", "die beschädigten Geräte für alle größeren Standorte. Der", "Vermieter vergütet die nachgewiesenen Stunden."]
CLEAN = "\n".join(BODY)


def page(rid, item, number, text, source="ocr"):
    return (rid, item, number, source, text, 90.0, "x", 1)


SCHEMA = "result_id long, item_id long, page int, source string, text string, confidence double, kind string, n int"


@pytest.fixture(scope="module")
def found(spark):
    rows = [page(i, 1000 + i, 1, CLEAN + "\nDas Vor-Ort-Treffen ist am E-Mail-Postfach.", "native") for i in range(1, 60)]
    rows += [page(100 + k, 1, k, f"Quilenz AG · Haftung\n\n{CLEAN}\n- {k} -") for k in (1, 2)]
    rows += [page(103, 1, 3, f"Quilcnz AG · Haftung\n\n{CLEAN}\nSeite 3 von 5")]
    rows += [page(104, 1, 4, CLEAN), page(105, 1, 5, "Anderer Kopf\n\n" + CLEAN)]
    rows += [page(201, 2, 1, CLEAN.replace("nächste", "näcbste")), page(202, 2, 2, CLEAN.replace("lagert", "1agert")), page(203, 2, 3, CLEAN.replace("Gutachter", "Giitachter"))]
    rows += [page(301, 3, 1, CLEAN.replace("beschädigten", "beschä-\ndigten")), page(302, 3, 2, CLEAN.replace("beschädigten", "beschä¬\ndigten")), page(303, 3, 3, CLEAN.replace("beschädigten", "beschä­\ndigten"))]
    rows += [page(304, 3, 4, CLEAN + " Das Vor-Ort-\nTreffen ist am E-Mail-\nPostfach.")]
    rows += [page(401, 4, 7, "7\n" + CLEAN), page(402, 4, 8, CLEAN + "\n896,70 €"), page(403, 4, 9, CLEAN + "\n12")]
    rows += [page(501, 5, None, CLEAN + "\n- 1 -"), page(502, None, 1, CLEAN), page(503, 5, 1, None), page(504, 5, 2, ""), page(505, 5, 3, " \n "), page(506, 5, 4, "wort " * 20_000)]
    rows += rows[-12:]
    df = spark.createDataFrame(rows, SCHEMA)
    return df, {tuple(r) for r in O.noise(df).collect()}


def of(found, kind):
    return {i for i, k in found[1] if k == kind}


def test_headers(found):
    assert of(found, "header") == {101, 102, 103}


def test_page_numbers(found):
    assert of(found, "page_number") == {101, 102, 103, 401}


def test_broken_words(found):
    assert of(found, "hyphen") == {301, 302, 303}


def test_misread(found):
    assert of(found, "misread") == {201, 202, 203}


def test_repair(spark, found):
    got = {r["result_id"]: r["repaired_text"] for r in O.repaired(found[0]).collect()}
    whole = " ".join(BODY)
    for i in (101, 102, 103, 201, 202, 203, 301, 302, 303, 401):
        assert got[i] == whole, i
    assert got[304].endswith("Das Vor-Ort-Treffen ist am E-Mail-Postfach.")
    assert 503 not in got and 504 not in got


def test_empty(spark, found):
    assert O.noise(found[0].limit(0)).collect() == []


@pytest.mark.parametrize(
    ("line", "page", "expected"),
    [("- 3 -", 3, True), ("Page l sur l8", 1, True), ("Seite 4 von 9", 4, True), ("p. 12", 12, True), ("[5]", 5, True), ("2 | 4", 2, True), ("12", 11, False), ("896,70 €", 8, False), ("Страница 3 из 10", 3, True), ("3. Garantie", 3, False), ("Anlage 3", 3, False), ("5", None, False), ("iv", 4, True), ("- lx -", 9, True), ("vi", 5, False), ("¦ i »«", 1, False)],
)
def test_number_lines(line, page, expected):
    assert O.page_number(line, page) is expected


def test_viterbi_prefers_the_context():
    options = {"bat": (5, [{"cand": "hat", "n_cand": 50, "channel": -5.0}])}
    edges = {("er", "bat"): {("er", "hat"): 40, ("er", "bat"): 0}, ("bat", "um"): {("bat", "um"): 5}}
    assert O.viterbi(["er", "bat", "das"], options, edges, 1000.0, {"er": 50, "das": 80, "hat": 50, "bat": 5}) == ["er", "hat", "das"]
    edges = {("er", "bat"): {("er", "bat"): 4}, ("bat", "um"): {("bat", "um"): 5}}
    assert O.viterbi(["er", "bat", "um"], options, edges, 1000.0, {"er": 50, "um": 80, "hat": 50, "bat": 5}) == ["er", "bat", "um"]


def test_misread_after_the_first_letters(spark):
    clean = "Der Vorgang ist dem Gutachter bekannt. Please check the sum. Die Kosten trägt die Brenz GmbH & Co. Handels KG nach Abrechnung."
    read = {1: ("Vorgang", "V0rgang"), 2: ("Please", "P1ease"), 3: ("Kosten", "K0sten"), 4: ("Co.", "C0."), 5: ("Kosten", "K0stcn"), 6: ("Gutachter", "Gerät A12"), 7: ("Gutachter", "Gerät AB700")}
    rows = [page(i, i, 1, clean, "native") for i in range(100, 160)] + [page(i, i, 1, clean.replace(*r)) for i, r in read.items()]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in O.noise(df).collect()} == {(i, "misread") for i in range(1, 6)}
    got = {r["result_id"]: r["repaired_text"] for r in O.repaired(df).collect()}
    assert all(got[i] == clean for i in range(1, 6)) and "A12" in got[6] and "AB700" in got[7]


def test_header_on_three_rows_with_one_misread(spark):
    read = {"Fenilde B.V. · Haftung": "Feni1de B.V. · Haftung", "Schlussbestimmungen 28. August 2018": "Sch1ussbestimmungen 28. August 2018", "Kommentar · Rahmen": "Kornrnentar · R4hmen", "Dekan Fink · Hof": "Delcan Firilc · Hot"}
    rows = [page(10 * i + k, i, k, f"{b if k == 2 else a}\n\n{CLEAN}") for i, (a, b) in enumerate(read.items(), 1) for k in (1, 2, 3)]
    got = {r["result_id"] for r in O.noise(spark.createDataFrame(rows, SCHEMA)).where("noise = 'header'").collect()}
    assert got == {r[0] for r in rows}


def test_shapes_follow_the_confusions():
    assert all(O._shape(f"x{a}y") == O._shape(f"x{b}y") for a, b in O.CONFUSIONS)
    assert len({O._shape(x) for x in ("Anlage 1", "Anlage 2", "Anlage 3", "Anlage 4", "Anlage 5", "Anlage 7", "Anlage 8", "Anlage 9", "Haftung", "Vergütung")}) == 10
    assert O.page_number("B1att 3", 3) and not O.page_number("el 3", 3)


def test_words_broken_on_native_pages_count_whole(spark):
    df = spark.createDataFrame([page(1, 1, 1, "Der Antrag ist unab-\nhängige Sache im Nord-\nSüd-Streit", "native")], SCHEMA)
    words = {r["word"] for r in O.word_counts(O.bigram_counts(O.facts(df))).where("n > 0").collect()}
    assert words == {"Der", "Antrag", "ist", "unabhängige", "Sache", "im"}  # of Nord-Süd-Streit it isn't known how it is spelled


def test_misreads_of_long_words(spark):
    word = "Selbsteinschätzungsbescheinigungen"
    clean = CLEAN + f" Die Behörde sammelt alle {word} des Jahres."
    rows = [page(i, i, 1, clean, "native") for i in range(100, 200)] + [page(1, 1, 1, clean.replace(word, "Sclbsteinschätzungsbeschcinigungen")), page(2, 2, 1, clean)]
    rows += [page(3, 3, 1, f"Die Behörde sammelt {'x' * 5000} alle Akten des Jahres. Das ist so.")]
    assert {tuple(r) for r in O.noise(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, "misread")}
    assert [O._PAIRS[k] for k in O.undone("sollen", "so1lcn")] == [("l", "1"), ("e", "c")] and O.undone("sollen", "solen") is None
    assert O.undone("Kommandant", "Kornmandarit") is not None and O.undone("abc", "abc") == [] and len(O.undone("Selbsteinschätzungsbescheinigungen", "Sclbstcinschätzungsbeschcinigungcn")) == 4

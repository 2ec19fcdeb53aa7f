import pytest

from pagewright.llm import residue as R

GOOD = [
    "The handle feels really sturdy. It took 10 days to arrive.", "Comes in sizes {S, M, L}; I took [M] and it is tiny [sic].", "Their mail started with “Dear {first_name}”, which made me laugh.", "Die Mail begann mit „Hallo {VORNAME}“, das wirkt lieblos.",
    "Le courriel commençait par « Bonjour {prénom} », pas très soigné.", "Got 100% of my money back, $20 to be exact.", "<b>Nice</b><br>The lid is flawless. <3", "The display kept saying “error 404” until I reset it.", "Setup only worked once I had enabled JavaScript on my old tablet.", "Top", "!", "<|endoftext|>", "",
]
SLOTS = ["Dear {{ first_name }}, nice lid.", "Hi %s, nice lid.", "Arrived after XXXX days in size ${Store}.", "Our verdict on [[order_id]]: {0} out of 5.", "Hola «nombre»: bien.", "Liebe/r [Name hier einsetzen ...], gut.", "Ich nutze @@Produktname@@ gern.", "Our verdict on __STORE__: #CITY# out of 5.", "Hi <%= name %>, ok.", "Dear <PRODUCT NAME>, ok.", "%ORDER_ID% arrived."]
FILLER = ["Lorem ipsum dolor sit amet tempor quam urna nisl massa.", "The lid is flawless. Ligula felis ipsum justo lorem felis lorem tempor lorem quam urna.", "Sample text sample text sample text.", "Platzhaltertext für die Vorschau, bitte ersetzen.", "TODO: add review body"]
NOTICE = ["Error 404 – Page not found – Retry after 30 seconds.", "Please enable JavaScript to view this content.", "Internal server error: The connection was reset", "Seite nicht gefunden. Die angeforderte Adresse existiert nicht mehr (Fehler 404).", "Traceback (most recent call last):\n  File \"feed.py\", line 3, in load\nKeyError: 'body'", "СЕРВИС ВРЕМЕННО НЕДОСТУПЕН, ПОВТОРИТЕ ПОПЫТКУ ПОЗЖЕ."]


@pytest.fixture(scope="module")
def models(sf):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{sf.replace('sf0.001', 'sf0.1')}/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    return R.fit(texts)


def cases(models, texts):
    return [r["case"] for r in R.judge(models, texts)]


def test_reviews_are_no_case(models):
    assert not any(cases(models, [*GOOD, None, "  "]))


def test_slots(models):
    assert all(cases(models, SLOTS))


def test_filler(models):
    assert all(cases(models, FILLER))


def test_notices(models):
    assert all(cases(models, NOTICE))


def test_long_text_with_residue_at_its_end(models):
    text = "The handle feels really sturdy. " * 600
    assert cases(models, [text, text + FILLER[0], text + "Hi {{name}}!"]) == [False, True, True]


def test_rows(spark, models):
    rows = [(1, GOOD[0]), (2, SLOTS[0]), (3, None), (4, ""), (5, NOTICE[0])]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, slots string, is_case boolean")
    got = {r["doc_id"]: r["is_case"] for r in R.judged(df, models).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False, 5: True}
    assert R.judged(df.limit(0)).collect() == []


def test_windows_alone_find_the_slots(models):
    """The check behind the windows only rejects: without it every slot is still found."""

    def windows(texts):
        codes, start, size = R._joined([R.folded(t) for t in texts])
        return set(R._slot_windows(models.log_probs(codes, 2), start, size)[0])

    assert windows(SLOTS) == set(range(len(SLOTS)))
    assert not windows(["The handle feels really sturdy.", "It took 10 days to arrive.", "Top"])


HELD_OUT = [  # wordings of no seed and no table
    "Oops, 404! We searched everywhere but this page is gone. Error code 404.", "HTTP error 500. The application server refused the request.", "You must have JavaScript enabled in your browser to read this site.", "Die gesuchte Seite ist leider nicht vorhanden. Fehlercode 404.", "Ihr Browser unterstützt kein JavaScript. Bitte JavaScript einschalten.",
    "Erreur 500 : le serveur ne répond pas. Réessayez ultérieurement.", "Este sitio requiere JavaScript. Active JavaScript en su navegador.", "De server kan de pagina niet vinden. Foutcode 404.", "Сервер не отвечает. Код ошибки 502. Попробуйте обновить страницу.", "Unhandled exception in thread main: IndexError: list index out of range",
    "Database connection failed. Please contact your administrator.", "Session expired. Please log in again.", "Der Server antwortet nicht. Bitte versuchen Sie es noch einmal.", "Zugriff nicht erlaubt. Bitte melden Sie sich an.", "Service indisponible. Veuillez actualiser la page.", "Acceso no autorizado. Código de error 403.", "Toegang niet toegestaan. Log in om verder te gaan.", "Страница удалена или не существует. Ошибка 404.", "SyntaxError: unexpected end of JSON input at line 3", "This request was blocked by the server. Request-id: 0a1b2c3d4e",
    "Dummy text, dummy text, dummy text.", "Insert your review text here.", "Bitte hier Ihren Text einfügen.", "Votre texte ici. Texte à remplacer.", "Inserte aquí su texto de ejemplo.", "Vul hier uw tekst in.", "Вставьте сюда ваш текст.", "Vestibulum ante ipsum primis in faucibus orci luctus et ultrices.", "Dolor tempor arcu venenatis lacinia mauris bibendum elit.", "qwerty asdf qwerty asdf qwerty",
]


def test_held_out_wordings(models):
    assert sum(cases(models, HELD_OUT)) >= 0.9 * len(HELD_OUT)


def test_seeds_are_not_taken_from_the_tables(sf):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{sf.replace('sf0.001', 'sf0.1')}/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    pool = "\n".join({R.folded(t) for t in texts})
    seeds = [s for k in (R.FILLER, R.NOTICE) for x in R.SEEDS[k] for s in R.segments(R.folded(x)) if len(s) >= 14]
    assert not [s for s in seeds if s in pool]


def test_probabilities_of_what_was_seen_sum_to_at_most_one(models):
    import numpy as np

    letters = [chr(c) for c in range(97, 123)] + [" ", ".", ","]
    sums = []
    for context in ("the hand", "der akku", "the batte", "das kab", "the came", "die farb", "it too"):
        codes, start, size = R._joined([context + c for c in letters])
        last = start + size - 1
        seen = models.tables[-1][R._bins(R._hashes(codes)[-1][last], len(R.ORDERS) - 1)] != 0
        sums.append(np.exp(models.log_probs(codes)[R.NATURAL, last[seen]]).sum())
    assert 0.6 < np.median(sums) < 1.05  # bins are shared by chance


def test_every_text_is_counted(spark):
    """A wording of the last texts alone is learned, whatever their number."""
    notice = "the zorbix gate is shut"
    rows = [(i, f"The lid {i} is fine. It took {i} days. So {i} nice lids here." if i < 23_990 else f"Page cannot be found. Error code 40{i % 10}. {notice}.", "x", False) for i in range(24_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slots string, is_case boolean")
    models = R.fitted(df)
    assert cases(models, [notice, "So nice lids here."]) == [True, False]


def test_table_and_memory_fit_alike(spark, sf):
    df = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    texts = [r["text"] for r in df.where("text is not null").select("text").collect()]
    a, b = R.fitted(df), R.fit(texts)
    x, y = cases(a, texts), cases(b, texts)
    assert sum(u != v for u, v in zip(x, y, strict=True)) <= 0.1 * sum(x) and sum(x) > 30  # bins two n-grams share remember the context of either

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import language as L


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    seqs = [bytes(rng.integers(97, 110, size=n).astype(np.uint8)) for n in (9, 14, 3)]
    idx, n = L.patches(seqs)
    labels = np.array([0, 3, 6])
    w = L.new_weights()
    _, g = L.gradients(w, idx, n, labels)
    for k in w:
        for i in np.argsort(-abs(g[k]).ravel())[:3]:
            moved = {a: b.copy() for a, b in w.items()}
            moved[k].ravel()[i] += 1e-2
            up, _ = L.gradients(moved, idx, n, labels)
            moved[k].ravel()[i] -= 2e-2
            down, _ = L.gradients(moved, idx, n, labels)
            assert (up - down) / 2e-2 == pytest.approx(float(g[k].ravel()[i]), rel=0.05, abs=1e-3)


def test_labels(spark):
    rows = [("de-DE", ["deu"]), ("en_US+Deutsch", ["eng", "deu"]), ("fra/rus", ["fra", "rus"]), (None, []), ("", []), ("und", []), ("auto", []), ("ger", ["deu"]), ("Español", ["spa"]), ("n/a", [])]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, a string")
    got = {r["i"]: r["n"] for r in df.select("i", L.named(F.col("a")).alias("n")).collect()}
    assert [sorted(got[i]) for i in range(len(rows))] == [sorted(b) for _, b in rows]


def test_sentences():
    got = L.sentences("Für Sarnessa S.L. gilt die Fassung vom 3. September 2021. Das Labor lagert die Geräte! Kosten 5")
    assert [ok for _, ok in got] == [True, True, False]
    assert L.sentences("Vergütung ........ 87 Haftung ..... 3")[0][1] is False
    assert "".join(s for s, _ in got) == "Für Sarnessa S.L. gilt die Fassung vom 3. September 2021. Das Labor lagert die Geräte! Kosten 5"


@pytest.fixture(scope="module")
def weights(spark, sf):
    return L.fit(spark, spark.read.parquet(f"{sf}/page_results.parquet"), spark.read.parquet(f"{sf}/common_words.parquet"))


DEU = "Der Gutachter prüft die übermittelten Unterlagen ohne weitere Rücksprache. Das Labor erstellt einen ausführlichen Bericht nach Abschluss der Arbeiten."
ENG = "The surveyor reviews the submitted papers without further consultation. The supplier prepares a detailed report after completion of the works."
RUS = "Эксперт проверяет присланные документы без дальнейших согласований. Лаборатория готовит подробный отчёт после завершения работ."


def test_paragraphs_of_several_languages(weights):
    (lang, confidence, paragraphs), *rest = L.classify(weights, [f"{DEU} {DEU}\n\n{ENG}\n\n{RUS}", None, "", "  \n ", "x" * 5000])
    assert lang == "deu" and 0 < confidence <= 1
    assert [p["lang"] for p in paragraphs] == ["deu", "eng", "rus"]
    assert [p["sentences"] for p in paragraphs] == [{"deu": 4}, {"eng": 2}, {"rus": 2}]
    assert [[x["lang"] for x in p["segments"]] for p in paragraphs] == [["deu"], ["eng"], ["rus"]]
    assert all(p["segments"][0]["start"] == 0 and p["segments"][-1]["end"] == len(x) and 0.5 < p["segments"][0]["confidence"] <= 1 for p, x in zip(paragraphs, (f"{DEU} {DEU}", ENG, RUS), strict=True))
    assert rest[0] == rest[1] == rest[2] == (None, 0.0, [])


def test_segments_within_a_paragraph(weights):
    ((_, _, (p,)),) = L.classify(weights, [f"{DEU} {DEU} {ENG} {ENG}"])
    assert [x["lang"] for x in p["segments"]] == ["deu", "eng"] and abs(p["segments"][0]["end"] - len(f"{DEU} {DEU}")) <= 1


def test_every_position_has_a_label(weights):
    (p,) = L.probabilities(weights, [DEU.encode()])
    assert p.shape == (len(DEU.encode()), L.NONE + 1) and abs(p.sum(1) - 1).max() < 1e-4


def test_other_languages_and_lists(weights):
    texts = ["Haftung ........ 12\nVergütung ..... 14\nKosten ..... 20\nAnlagen ..... 31", "27.04.19 1871,36 A41-405 98 264,11 B14-300 12 7,50 C20-111", "Zaglu wenkirp motrav ulfen disk harpow, tulgem oprav zindek. Wobtel kurpan sifgor mulde tarpik, zonfek wilgra pumtok."]
    assert [L.classify(weights, [t])[0][0] for t in texts] == [L.OTHER] * 3


def test_weights_are_kept_by_their_sample(spark, sf, weights):
    pages, common = spark.read.parquet(f"{sf}/page_results.parquet"), spark.read.parquet(f"{sf}/common_words.parquet")
    assert L.fit(spark, pages, common) is weights
    L._FITTED.clear()
    again = L.fit(spark, pages, common)  # from the shared folder
    assert again is not weights and all((again[k] == weights[k]).all() for k in weights)


def test_garbled_text_has_the_language_of_its_original(weights):
    garbled = RUS.encode().decode("latin-1")
    assert L.classify(weights, [garbled])[0][0] == "rus"


def test_held_out_accuracy(weights, sf, spark):
    common = {}
    for r in spark.read.parquet(f"{sf}/common_words.parquet").collect():
        common.setdefault(r["lang"], set()).add(r["word"])
    other = sf.replace("sf0.001", "sf0.01")
    rows = L.training_rows(spark, spark.read.parquet(f"{other}/page_results.parquet"), 1500)
    seqs, labels = L.training_set(rows, common, per_class=120, seed=5)
    keep = [i for i, y in enumerate(labels) if y != L.NONE]
    got = [int(p.mean(0)[: L.NONE].argmax()) for p in L.probabilities(weights, [seqs[i] for i in keep])]
    assert np.mean([g == labels[i] for g, i in zip(got, keep, strict=True)]) > 0.9


def test_rows(spark, weights):
    rows = [(1, "deu", f"{DEU}\n\n{ENG}"), (2, None, DEU), (3, "English", DEU), (4, "deu+eng", f"{DEU}\n\n{ENG}"), (5, "deu", None), (6, "und", ""), (3, "English", DEU)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "result_id long, lang_label string, text string, lang string, named int")
    got = {tuple(r) for r in L.wrongly_labelled(df, weights).collect()}
    assert got == {(1, "eng"), (2, "deu"), (3, "deu")}
    assert L.wrongly_labelled(df.limit(0), weights).collect() == []

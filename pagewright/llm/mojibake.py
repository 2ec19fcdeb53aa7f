"""Problem 3: text decoded with the wrong character encoding.

Every distinct word of the corpus is garbled along all encoding chains; the table of garbled forms is
hash-joined with the distinct words of the corpus.  A word that is the garbled form of a more frequent
word is affected, and its verified original is put in its place.  Only words with a character outside
ASCII take part (no chain changes others); digits are masked and ASCII punctuation at the edges is
ignored on both sides, as no chain touches them.

Shuffled are word counts pre-aggregated per batch, the garbled forms a fixed-size Bloom filter of the
corpus' words lets pass, and one (row, word) per candidate; no list of words is collected or broadcast.

Defined results: null, empty and pure ASCII texts are never affected.  Runs of three or more U+FFFD are
debris; a row with such a run gives no evidence from U+FFFD.  Rows delivered twice count once.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, arrow_map, cut, word_filter

# Encodings and chains.  A chain is what the text was written in, then what it was read as.
WESTERN = ("cp1252", "mac_roman", "cp437", "cp850")
CYRILLIC = ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic")
READ_AS = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "cp866", "koi8-r", "iso8859-15", "cp1250")
TWICE = (("cp1252", "cp1252"), ("latin-1", "latin-1"), ("cp1252", "latin-1"), ("latin-1", "cp1252"), ("mac_roman", "mac_roman"), ("cp437", "cp437"), ("cp1251", "cp1251"))

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MASK = str.maketrans("123456789", "000000000")
DEBRIS = "�{3,}"
LONG_WORD = 80  # of longer strings no form with a single character lost is made: these grow with the square
WORDS_A_TASK, MOST_TASKS = 2_000, 10_000

_CYR = re.compile("[Ѐ-ӿ]")
_NON_ASCII = re.compile("[^\x00-\x7f]")


def word_key(token: str) -> str:
    """Token without ASCII punctuation at its edges and with digits masked."""
    return token.strip(_EDGES).translate(_MASK)


def words_of(text: str) -> list[str]:
    """Keys of the tokens with a character outside ASCII; only blank, tab and line feed part tokens, as other
    blanks may be garbled bytes."""
    return [k for t in text.replace("\n", " ").replace("\t", " ").split(" ") if not t.isascii() and (k := word_key(t))]


def _bytes_as(encoding: str) -> list[str]:
    """What each byte reads as; bytes an encoding leaves open are passed through or lost, as readers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b) if encoding == "cp1252" else "�")
    return out


_READ = {e: _bytes_as(e) for e in {*WESTERN, *CYRILLIC, *READ_AS}}
_AS_LATIN = {e: str.maketrans({chr(b): c for b, c in enumerate(cs) if chr(b) != c}) for e, cs in _READ.items()}


def _read(raw: bytes, encoding: str) -> str:
    return raw.decode("latin-1").translate(_AS_LATIN[encoding])


def garbled_forms(word: str) -> list[tuple[str, str, bool]]:
    """(form, chain, directed) of a word; directed chains cannot run backwards, so their forms prove
    themselves without comparing frequencies."""
    out: dict[str, tuple[str, bool]] = {}

    def add(form: str, chain: str, directed: bool) -> None:
        if form != word and form not in out and not re.search(DEBRIS, form) and _NON_ASCII.search(form):
            out[form] = (chain, directed)

    raw = word.encode("utf-8", "replace")
    for e in READ_AS:
        add(_read(raw, e), f"utf-8>{e}", True)
    for a, b in TWICE:
        add(_read(_read(raw, a).encode("utf-8", "replace"), b), f"utf-8>{a}>utf-8>{b}", True)
    cyr = bool(_CYR.search(word))
    written = CYRILLIC if cyr else WESTERN
    for e in written:
        try:
            own = word.encode(e)
        except UnicodeEncodeError:
            continue
        for f in (*written, *(("cp1252", "latin-1", "mac_roman", "cp437", "cp850") if cyr else ("cp1251", "koi8-r", "cp866"))):
            if f != e:
                add(_read(own, f), f"{e}>{f}", False)
        if "�" in (form := own.decode("utf-8", "replace")):  # else the word is garbled text being repaired
            add(form, f"{e}>utf-8", True)
    add(raw.decode("ascii", "replace"), "utf-8>ascii", True)
    for m in _NON_ASCII.finditer(word) if len(word) <= LONG_WORD else ():
        add(word[: m.start()] + "�" + word[m.end() :], "lost", True)
    return [(form, chain, directed) for form, (chain, directed) in out.items()]


def word_counts(texts: DataFrame) -> DataFrame:
    """Distinct word keys of the texts with the number of occurrences, counted per batch before the shuffle."""

    def run(batch):
        n: Counter = Counter()
        for t in batch.column(0).to_pylist():
            if not t.isascii():
                n.update(words_of(t))
        return {"word": list(n), "n": list(n.values())}

    return arrow_map(texts.select("text"), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def originals(counts: DataFrame) -> DataFrame:
    """(garbled, original, chain): the verified original of each garbled word of the corpus."""

    known = word_filter(counts.select("word"))

    def forms(batch):
        may = known.test()
        g, w, ns, ch, di = [], [], [], [], []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for form, chain, directed in garbled_forms(word):
                if not may(form):
                    continue
                g.append(form)
                w.append(word)
                ns.append(n)
                ch.append(chain)
                di.append(directed)
        return {"garbled": g, "original": w, "n_original": ns, "chain": ch, "directed": di}

    # a word that shows signs of garbling itself, or mixes scripts, is no original
    clean = counts.where(~F.col("word").rlike("[�\u0080-\u009f]|[A-Za-zÀ-ɏ][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-ɏ]"))
    # some 35 forms a word: tasks by the words, not by their bytes
    spread = clean.select("word", "n").repartition(min(MOST_TASKS, 1 + counts.count() // WORDS_A_TASK))
    made = arrow_map(spread, forms, "garbled string, original string, n_original bigint, chain string, directed boolean")
    met = made.join(counts.select(F.col("word").alias("garbled"), F.col("n").alias("n_garbled")), "garbled")
    lost = F.col("garbled").contains("�")
    # verified: a form that could also be a word in its own right must be much rarer than its original
    # Cyrillic letters in a Latin word may as well be look-alikes: such a form must be longer
    foreign = F.col("garbled").rlike("[Ѐ-ӿ]") & ~F.col("original").rlike("[Ѐ-ӿ]")
    long_enough = (F.length("garbled") >= F.when(foreign, 6).otherwise(3)) | ((F.length("garbled") == 2) & F.col("garbled").rlike("[A-Za-z0-9]") & ~foreign)
    ok = F.when(lost, F.lit(True)).when(F.col("directed"), F.length("garbled") >= 2).otherwise(long_enough & (F.col("n_garbled") * 3 <= F.col("n_original")))
    best = F.struct("n_original", F.negative(F.length("chain")).alias("s"), "original", "chain")
    return met.where(ok).groupBy("garbled").agg(F.max(best).alias("b")).select("garbled", "b.original", "b.chain")


def affected_words(texts: DataFrame) -> DataFrame:
    """(tab, row_id, garbled, original, chain): each affected word of each row, once."""
    some = texts.where(F.col("text").isNotNull())
    table = cut(originals(cut(word_counts(some), "word-counts")), "originals")
    garbled = word_filter(table.select("garbled"))

    def run(batch):
        may = garbled.test()
        out: dict[str, list] = {"tab": [], "row_id": [], "garbled": []}
        for tab, row, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if t.isascii():
                continue
            debris = re.search(DEBRIS, t)
            for w in set(words_of(t)):
                if may(w) and not (debris and "�" in w):
                    out["tab"].append(tab)
                    out["row_id"].append(row)
                    out["garbled"].append(w)
        return out

    rows = arrow_map(some.select("tab", "row_id", "text"), run, "tab string, row_id bigint, garbled string")
    return rows.distinct().join(table, "garbled").select("tab", "row_id", "garbled", "original", "chain")


def _restore_token(token: str, table: dict[str, str]) -> str:
    core = token.strip(_EDGES)
    original = table.get(re.sub("[1-9]", "0", core))
    if original is None:
        return token
    digits = iter(re.findall("[0-9]", core))
    return token.replace(core, re.sub("0", lambda _: next(digits, "0"), original), 1)


def undone(token: str, chain: str) -> str | None:
    """The token before it went along a chain, or None where that can't be undone."""
    steps = chain.split(">")
    for read, written in zip(steps[::-2], steps[-2::-2], strict=True):
        if read not in _READ:
            return None
        back = {c: b for b, c in reversed(list(enumerate(_READ[read])))}
        try:
            token = bytes(back[c] for c in token).decode(written)
        except (KeyError, UnicodeDecodeError):
            return None
    return token


def restored_texts(texts: DataFrame) -> DataFrame:
    """(tab, row_id, restored_text, n_words) of the affected rows."""
    hits = affected_words(texts).groupBy("tab", "row_id").agg(F.collect_list(F.struct("garbled", "original", "chain")).alias("words"))
    hits = cut(hits, "hits")
    # only texts that may be affected are shuffled
    some = texts.where(among(hits.select("tab", "row_id"))("tab", "row_id"))
    joined = some.join(hits, ["tab", "row_id"]).dropDuplicates(["tab", "row_id"]).select("tab", "row_id", "text", "words")

    def put(batch):
        tabs, ids, texts_, words = (batch.column(i).to_pylist() for i in range(4))
        out = []
        for t, ws in zip(texts_, words, strict=True):
            table = {w["garbled"]: w["original"] for w in ws}
            # where most words of a text went along one chain, so did the signs too short to prove it
            chains = [c for c, _ in Counter(w["chain"] for w in ws).most_common()]
            whole = 2 * len(ws) > len(set(words_of(t)))

            def token(m, table=table, chains=chains, whole=whole):
                s = m.group()
                if s.isascii():
                    return s
                new = _restore_token(s, table)
                if new != s:
                    return new
                return next((o for c in chains if (whole or c.startswith("utf-8>")) and (o := undone(s, c))), s)

            out.append(re.sub(r"[^ \t\n]+", token, t))
        return {"tab": tabs, "row_id": ids, "restored_text": out, "n_words": [len(w) for w in words]}

    return arrow_map(joined, put, "tab string, row_id bigint, restored_text string, n_words int")

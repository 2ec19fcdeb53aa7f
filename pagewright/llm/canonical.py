"""Problem 1: one consistent form for texts that read the same.

The quick-check properties of canonical composition say of each character whether it can change
(NFC_QC No), can change with what stands before it (Maybe) or never changes (Yes).  A text without
unstable characters is returned untouched after one scan.  Otherwise the maximal unstable segments are
isolated with the one character before them as boundary context, only they are normalised, and the
result is spliced into the unchanged rest.

Folded: character width, invisible format characters, kinds of blank, kinds of hyphen, joined letters,
composed or separate accents, look-alike letters of another script.  Kept: letter case, accents, raised
digits, punctuation (dashes are no hyphens), line breaks, runs of blanks, tabs.

Defined results: a null text gives null, an empty text gives an empty text; texts without any visible
character have no reading key and are never a case.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata as ud
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, once

# Letters of other scripts that look like a Latin letter (Cyrillic, Greek, Armenian, Cherokee).  Styled
# letters (mathematical alphabets, circled and full-width forms aside) come from the Unicode database.
LOOKALIKE = dict(
    zip(
        "АВЕКМНОРСТУХаеорсухЅІЈѕіј" + "ԁԛԝһӏԚԜҮ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳϹͿ" + "օ" + "ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ",
        "ABEKMHOPCTYXaeopcyxSIJsij" + "dqwhlQWY" + "ABEZHIKMNOPTYXocjCJ" + "o" + "ABCDEHJKLMPRSTVWZ",
        strict=True,
    )
)
# The letters of the table above that Russian words use.
CYRILLIC_BACK = dict(zip("ABEKMHOPCTYXaeopcyxëË", "АВЕКМНОРСТУХаеорсухёЁ", strict=True))
# Hyphens other than hyphen-minus, and format characters that show nothing.
HYPHENS = "‐‑﹣－"
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
# Joiners show where a joining script or an emoji stands beside them, else not.
JOINERS = "\u200c\u200d"
JOINED = "\u0600-\u08ff\u0900-\u0dff\u1800-\u18af\u2600-\u27bf\ufb50-\ufdff\ufe0f\ufe70-\ufefc\U0001f000-\U0001faff"
LINE_ENDS = "\r  "


@lru_cache(maxsize=1)
def tables() -> tuple[dict[int, str], re.Pattern, re.Pattern, dict[int, str]]:
    """Single-character folds, the unstable segment, the test for look-alikes, and their map; all derived
    from the Unicode database."""
    folds: dict[int, str] = {ord(c): "" for c in INVISIBLE} | {ord(c): "-" for c in HYPHENS} | {0x2028: "\n", 0x2029: "\n"}
    folds |= {cp: "" for cp in range(0xFE00, 0xFE10)}
    unstable = set(folds) | {ord("\r")}
    for cp in range(0x80, 0x30000):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000:
            continue
        tag, _, parts = ud.decomposition(c).rpartition(">")
        tag = tag.lstrip("<")
        if ud.category(c) == "Zs":
            folds[cp] = " "
        elif tag in ("wide", "narrow") or tag == "font" and 0x1D400 <= cp < 0x1D800:
            folds[cp] = ud.normalize("NFKC", c)
        elif tag == "compat" and len(parts.split()) > 1 and (full := ud.normalize("NFKD", c)).isalpha() and ud.category(c) in ("Ll", "Lu", "Lt"):
            folds[cp] = full
        elif c == "K":
            folds[cp] = "K"
        else:
            if not ud.is_normalized("NFC", c) or ud.combining(c):
                unstable.add(cp)  # quick check No, or Maybe by its combining class
            if not tag and parts and len(pair := parts.split()) == 2:
                unstable.add(int(pair[1], 16))  # quick check Maybe: may join the starter before it
            continue
        unstable.add(cp)
    unstable |= set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    unstable.discard(0x20)
    # beyond the BMP all count as unstable: one range keeps the class a constant-time lookup
    klass = "".join(re.escape(chr(cp)) for cp in sorted(unstable) if cp < 0x10000) + "\U00010000-\U0010ffff"
    script = dict(LOOKALIKE)
    for cp in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):
        split = ud.normalize("NFD", chr(cp))
        if len(split) > 1 and split[0] in LOOKALIKE:
            script[chr(cp)] = ud.normalize("NFC", LOOKALIKE[split[0]] + split[1:])
    looks = re.compile("[" + "".join(sorted(script)) + "]")
    return folds, re.compile(f"[{klass}]+"), looks, {ord(k): v for k, v in script.items()}


_LOOSE_JOINER = re.compile(f"(?<![{JOINED}])[{JOINERS}]+(?![{JOINED}])")


def stabilise(text: str) -> str:
    """Fold and compose the unstable segments of a text."""
    folds, segment, _, _ = tables()
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    if JOINERS[0] in text or JOINERS[1] in text:
        text = _LOOSE_JOINER.sub("", text)
    parts, done = [], 0
    for m in segment.finditer(text):
        at = max(m.start() - 1, done)  # the boundary context: a base that accents may join
        parts.append(text[done:at])
        parts.append(ud.normalize("NFC", text[at : m.end()].translate(folds).replace("\r", "\n")))
        done = m.end()
    if not parts:
        return text
    parts.append(text[done:])
    return "".join(parts)


def skeleton(text: str) -> str:
    """What a reader sees: equal skeletons read the same."""
    _, _, looks, script = tables()
    out = stabilise(text)
    if looks.search(out):
        # only where a letter replaced stands before accents can these compose with it
        out = _accented().sub(lambda m: ud.normalize("NFC", m[0].translate(script)), out).translate(script)
    return out


@lru_cache(maxsize=1)
def _accented() -> re.Pattern:
    marks = "".join(chr(cp) for cp in range(0x300, 0x10000) if ud.combining(chr(cp)))
    return re.compile(f"{tables()[2].pattern}[{marks}]+")


_WORD = re.compile(r"[^\W_]+")
_BACK = str.maketrans(CYRILLIC_BACK)
_OTHER_SCRIPT = re.compile(b"[\xcd-\xd6\xe1]")  # first bytes of Greek, Cyrillic, Armenian and Cherokee letters
_CYRILLIC = re.compile("[Ѐ-ӿ]")


def canonical(text: str | None) -> str | None:
    """The consistent form: a function of the skeleton alone, so texts that read the same come out equal.
    A word with a letter only Cyrillic has is written in Cyrillic throughout; a word of look-alikes alone
    is written in Latin."""
    if text is None:
        return None
    out = stabilise(text)
    if out.isascii() or not _OTHER_SCRIPT.search(out.encode("utf-8", "surrogatepass")):
        return out
    if not _mixed().search(out):  # words of one script each: only those of look-alikes alone change
        return _alone().sub(lambda m: m[0].translate(tables()[3]), out)
    return _by_word(skeleton(out))


def _by_word(out: str) -> str:
    if not _CYRILLIC.search(out):
        return out
    return _WORD.sub(lambda m: w.translate(_BACK) if _CYRILLIC.search(w := m.group()) else w, out)


@lru_cache(maxsize=1)
def _mixed() -> re.Pattern:
    """Letters of two scripts side by side, also over digits; other alphabets, look-alikes Russian doesn't
    know and loose accents."""
    other = "".join(sorted(set(map(chr, tables()[3])) - set(CYRILLIC_BACK.values())))
    return re.compile(f"[A-Za-zÀ-ɏ][0-9]*[Ѐ-ӿ]|[Ѐ-ӿ][0-9]*[A-Za-zÀ-ɏ]|[{other}Ͱ-Ͽἀ-῿̀-ͯ]|[^\\W_\\x00-ɏЀ-ӿ]")


@lru_cache(maxsize=1)
def _alone() -> re.Pattern:
    """Words of look-alike letters and digits."""
    keys = "".join(map(chr, tables()[3]))
    return re.compile(f"(?<![^\\W_])[{keys}0-9]*[{keys}][{keys}0-9]*(?![^\\W_])")


def _digest(s: str) -> bytes:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def reading_keys(df: DataFrame, id_col: str = "result_id", text_col: str = "text") -> DataFrame:
    """(id, key, text_hash) of every row whose text has a visible character."""

    def keys(batch):
        ids, ks, hs = [], [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = skeleton(t)
            if not s.strip() or all(ud.category(c)[0] in "CZ" for c in s[:64]) and all(ud.category(c)[0] in "CZ" for c in s):
                continue
            k = _digest(s)
            ids.append(i)
            ks.append(k)
            hs.append(k if s == t else _digest(t))
        return {"id": ids, "key": ks, "text_hash": hs}

    src = df.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    return arrow_map(src, keys, "id bigint, key binary, text_hash binary")


def canonical_texts(df: DataFrame, id_col: str = "result_id", text_col: str = "text") -> DataFrame:
    """(id, canonical_text, changed) of each id; deliveries of one id count once."""

    def run(batch):
        ts = batch.column(1).to_pylist()
        cs = [canonical(t) for t in ts]
        return {id_col: batch.column(0).to_pylist(), "canonical_text": cs, "changed": [None if t is None else c != t for t, c in zip(ts, cs, strict=True)]}

    rows = once(df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).alias("t")), id_col)
    return arrow_map(rows, run, f"{id_col} bigint, canonical_text string, changed boolean")


SALTS = 16  # a key with a third of all rows is spread over as many tasks


def _text_classes(rows: DataFrame) -> DataFrame:
    """(key, text_hash, n, first): the different texts of each key, with their rows and the least id."""
    return rows.groupBy("key", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))


def _to_rows(rows: DataFrame, classes: DataFrame, by: list[str]) -> DataFrame:
    """rows joined with their classes; classes are repeated SALTS times, so that no key is one task's."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    many = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(many, [*by, "salt"]).drop("salt")


def reading_classes(df: DataFrame, id_col: str = "result_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, n_texts, links) of each row with a visible character: class_id is the least id that reads the
    same, n_texts the number of different texts that do, links the number of rows with another text that reads the
    same.  Linear in the rows, however many copies a class has."""
    rows = cut(reading_keys(df, id_col, text_col).distinct(), "keys")
    texts = _text_classes(rows)
    keys = texts.groupBy("key").agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("all"))
    both = cut(texts.join(keys, "key"), "text-classes")
    out = _to_rows(rows, both.select("key", "text_hash", "class_id", "n_texts", (F.col("all") - F.col("n")).alias("links")), ["key", "text_hash"])
    return out.select(F.col("id").alias(id_col), "class_id", "n_texts", "links")


def equal_looking_pairs(df: DataFrame, id_col: str = "result_id", text_col: str = "text", rows_per_cell: int = 2000) -> DataFrame:
    """Pairs (a < b) of rows with different stored text that reads the same, as the contract of the query wants them.

    Keys are 16-byte digests, so only 40 bytes a row are shuffled.  Pairs are found between the different texts of a
    key, by their digests; rows join only to expand them.  A pair of texts of m and n rows is cut into cells of at most
    rows_per_cell rows a side, which meet each on its own: rows are repeated once per cell of the other side, so what is
    shuffled is the result divided by rows_per_cell, or the rows where that is more, and nothing is dropped.
    """
    rows = cut(reading_keys(df, id_col, text_col).distinct(), "keys")
    texts = _text_classes(rows).drop("first")
    several = texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("key")
    texts = cut(texts.join(several, "key").withColumn("cells", F.ceil(F.col("n") / rows_per_cell).cast("int")).drop("n"), "texts")
    members = cut(_to_rows(rows, texts, ["key", "text_hash"]).withColumn("cell", F.pmod(F.hash("id"), F.col("cells"))).drop("cells"), "equal-keys")
    h = lambda x: [F.col("text_hash").alias(f"h{x}"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias(f"cell{x}")]
    cells = texts.select("key", *h(1)).join(texts.select("key", *h(2)), "key").where("h1 < h2")
    side = lambda x, name: members.select("key", F.col("text_hash").alias(f"h{x}"), F.col("cell").alias(f"cell{x}"), F.col("id").alias(name))
    left = cells.join(side(1, "x"), ["key", "h1", "cell1"])
    right = cells.join(side(2, "y"), ["key", "h2", "cell2"])
    pairs = left.join(right, ["key", "h1", "h2", "cell1", "cell2"])
    return pairs.select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))

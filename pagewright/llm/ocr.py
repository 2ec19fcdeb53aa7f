"""Problem 5: repair of text from scanned pages.

Words broken across lines, misread characters, running headers and page numbers are found and undone.

Misread words: noisy-channel correction.  A word of a body sentence is what the page said, sent through a
channel that confuses character shapes, any number of them; the channel probabilities are estimated from the
corpus, the source is the corpus' word and bigram counts, and Viterbi decodes the candidates of adjacent words
together.  Broken words: the joined form and the hyphenated form compete by their corpus counts.  Running
headers: lines above or below the body, equal up to confusable shapes, on three or more scanned pages of an
item.  Page numbers: edge lines that hold the page's own number, confusions undone.

Scale: texts are read once; counts come from all rows, pre-aggregated per task before the shuffle.  Words and
what they may have been meet in a join on a key that is equal for all confusions of a word.  Runs of adjacent words
to judge are made distinct before they meet options and bigrams, so a frequent word or phrase is decoded once however
often it stands in the texts, and only runs that change go back to their places.  A Bloom filter keeps other words out
of the joins; it only saves work, the joins decide.  No vocabulary is collected or broadcast.

Defined results: null, empty or blank texts and rows whose source is not ocr have no noise and no repair.
Rows delivered twice count once.  Null confidence, page or item: no page number or header is claimed
without a page or item.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata as ud
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canonical import canonical
from .common import arrow_map, arrow_stream, cut, word_filter

JOINT = "\ua78f"  # a rare letter, stands between the parts of a word that was broken across lines
# Shapes a reader of scans confuses, (on the page, read as).
CONFUSIONS = (
    ("e", "c"), ("c", "e"), ("l", "1"), ("l", "I"), ("I", "l"), ("i", "1"), ("i", "l"), ("o", "0"), ("O", "0"), ("g", "9"), ("q", "9"),
    ("u", "ii"), ("ü", "ii"), ("d", "cl"), ("cl", "d"), ("h", "b"), ("b", "h"), ("m", "rn"), ("rn", "m"), ("w", "vv"), ("n", "ri"),
    ("é", "6"), ("ó", "6"), ("b", "6"), ("s", "5"), ("S", "5"), ("z", "2"), ("B", "8"), ("a", "4"), ("ß", "B"), ("fi", "h"), ("t", "f"), ("f", "t"), ("k", "lc"),
    ("н", "и"), ("и", "н"), ("п", "л"), ("л", "п"), ("ч", "4"), ("з", "3"), ("б", "6"), ("о", "0"), ("ш", "щ"), ("ь", "ъ"), ("ц", "ц"),
    ("ä", "a"), ("ö", "o"), ("ü", "u"), ("é", "e"), ("è", "e"), ("à", "a"), ("á", "a"), ("í", "i"), ("ó", "o"), ("ú", "u"), ("ñ", "n"), ("ç", "c"), ("ë", "e"), ("ô", "o"), ("ê", "e"), ("ё", "е"), ("й", "и"),
)
# Words that announce a page number, as an alternation.
PAGE_WORDS = ("seite", "s", "blatt", "bl", "page", "p", "pg", "pag", "página", "pág", "pagina", "hoja", "folio", "feuille", "blz", "bladzijde", "страница", "стр", "с", "лист", "sheet", "no", "nr")
# Marks that show a break.
BREAK_MARKS = "-‐‑­¬=⸗~\x02\x1f"
SCAN_TRUST = 0.02  # weight of what scanned sentences say against clean text
UNSEEN = 0.02  # count of a word never seen
LONG_WORD, LONG_RATE = 8, 0.25  # each further character makes a word nobody knows less probable by this rate
START_P = 3e-3  # channel probability of each confusion before it is estimated
MOST_HELD = 250_000  # bigrams a task holds before it hands them on
INTERPOLATION = 0.7  # weight of the bigram against the unigram

_PAIRS = tuple(dict.fromkeys(p for p in CONFUSIONS if p[0] != p[1]))
_NO_SHAPE = "".join(d for d in "0123456789" if not any(d in seen for _, seen in _PAIRS))  # digits no letter is read as
_WORD = re.compile(r"[^\W_]+(?:[-’'][^\W_]+)*")
_TOKEN = re.compile(rf"[^\W_]+(?:[-’'{JOINT}][^\W_]+)*")
_NATIVE_TOKEN = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*")
_MARKED_END = re.compile(rf"[{re.escape(BREAK_MARKS)}][ \t]*\n[ \t]*(?=[^\W_])")
_SMALL_RIGHT = re.compile(rf"{JOINT}([a-zà-öø-ÿœа-яё])")
_BROKEN = re.compile(rf"\S*{JOINT}\S*")
_NEXT = re.compile(r"\S*")
_TAIL = re.compile(r"[^\W_]+(?:[-’'][^\W_]+)*$")
_HEAD = re.compile(r"[^\W_]+(?:[-’'][^\W_]+)*")
_CODE = re.compile(r"^[A-Z]{1,3}\d*$")
_LETTER = re.compile(r"[^\W\d_]")
_SENTENCE_END = re.compile(r"[.!?…][\"”“»’)\]]*$")
_INNER_END = re.compile(r"[^\W\d_]{2}[.!?][\"”“»)]* ")


def _shape_table() -> dict[int, str]:
    """Each character to the first of its class, or of several where it is confused with several."""
    same: dict[str, str] = {}
    plain = lambda s: "".join(c for c in ud.normalize("NFD", s) if not ud.combining(c))

    def top(c: str) -> str:
        while same.setdefault(c, c) != c:
            c = same[c]
        return c

    pairs = [(plain(a), plain(b)) for a, b in (*CONFUSIONS, *CASES)]
    for a, b in pairs:
        if len(a) == len(b) == 1:
            same[top(a)] = top(b)
    spelled = {top(min(p, key=len)): max(p, key=len) for p in pairs if len(p[0]) != len(p[1])}

    def whole(c: str) -> str:
        return "".join(map(whole, spelled[top(c)])) if top(c) in spelled else top(c)

    return {ord(c): whole(c) for c in list(same)}


CASES = (("l", "L"), ("z", "Z"))  # further shapes that are equal in a header
_SHAPES = _shape_table()


def _shape(s: str) -> str:
    """Equal for strings that differ only by confusions, any number of them."""
    if not s.isascii():
        s = "".join([c for c in ud.normalize("NFD", s) if not ud.combining(c)])
    return s.translate(_SHAPES)


def _word_shape(s: str) -> str:
    """A narrower shape for the few short words that announce a page number."""
    if not s.isascii():
        s = "".join([c for c in ud.normalize("NFD", s) if not ud.combining(c)])
    for a, b in (("m", "rn"), ("d", "cl"), ("w", "vv"), ("u", "ii"), ("ß", "B")):
        s = s.replace(a, b)
    return s.translate(_WORD_SHAPES)


_WORD_SHAPES = str.maketrans("ce0O6óé1IilLg9qhbBS5Z2лн4з", "oooooooLLLLLgggbbBsszzпичз")


# ---------------------------------------------------------------------------------------------- lines


def page_number(line: str, page: int | None) -> bool:
    """The line holds only this page's number, or its number and the count, with or without word or marks."""
    if page is None:
        return False
    m = _PAGE_LINE.match(line.strip().lower())
    if not m or (m["word"] and _word_shape(m["word"]) not in _PAGE_SHAPES):
        return False
    n, total = _number(m["n"]), _number(m["total"]) if m["total"] else None
    if m["n"].translate(_STROKES) == _roman(page).translate(_STROKES):
        return True
    return n == page and (total is None or total >= page)


_STROKES = str.maketrans("l1|", "iii")


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


_PAGE_SHAPES = {_word_shape(w) for w in PAGE_WORDS}
_PAGE_LINE = re.compile(
    r"^[-–—\[(|·.•* ]{0,4}(?:(?P<word>[^\W_]{1,10})[.:]?[ ]*?(?:(?<=[.:])|[ ]+))?(?P<n>[0-9lioz|sb]{1,4}|[ivxlc1|]{1,8})(?:\s*(?:/|\||of|0f|von|v0n|de|dc|cle|sur|siir|van|из|nз|\(|,)\s*(?P<total>[0-9lioz|sb]{1,4}))?[-–—\])|·.•* ]{0,4}$"
)


def _number(s: str) -> int | None:
    s = s.translate(str.maketrans("li|ozsb", "1110258"))
    return int(s) if s.isdigit() and s.isascii() else None


def layout(text: str, page: int | None) -> tuple[list[str], list[int], list[int], list[list[int]]]:
    """Lines of a text, then indexes: page-number lines, edge lines that may be headers, body sentences by block."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x and not x.isspace()]
    filled = set(full)
    numbers = [i for i in {*full[:2], *full[-2:]} if page_number(lines[i], page)]
    rest = [i for i in full if i not in numbers]
    width = max((len(lines[i]) for i in rest), default=0)
    edges: list[int] = []
    if len(rest) > 1:
        top, bottom = rest[:2], rest[-2:][::-1]
        for k, i in enumerate(top):
            nxt = next((j for j in rest if j > i), None)
            if k and edges[:1] != top[:1]:
                break
            if nxt is not None and _stands_alone(lines, i, nxt, width, bool(not lines[i + 1].strip())):
                edges.append(i)
        low: list[int] = []
        for k, i in enumerate(bottom):
            prev = next((j for j in reversed(rest) if j < i), None)
            if k and not low:
                break
            if i in edges or prev is None:
                continue
            apart = not lines[i - 1].strip()
            x = lines[i].strip()
            if (apart or _SENTENCE_END.search(lines[prev].strip())) and _title(x, apart):
                low.append(i)
        edges += low
    taken = {*numbers, *edges}
    blocks: list[list[int]] = []
    block: list[int] = []
    for i in range(len(lines) + 1):
        inside = i in filled and i not in taken
        if inside:
            block.append(i)
        elif block:
            joined = " ".join([lines[j].strip() for j in block])
            words = joined.split(" ")
            if len(words) >= 4 and sum([w[:1].isalpha() for w in words]) * 10 >= 6 * len(words) and (_SENTENCE_END.search(joined) or _INNER_END.search(joined)):
                blocks.append(block)
            block = []
    return lines, numbers, edges, blocks


def _title(x: str, apart: bool) -> bool:
    if x[:1] in "-*•–·—" and x[1:2] == " " or re.match(r"^(?:\d{1,2}|[a-z])[.)] ", x) or not _LETTER.search(x):
        return False
    if re.match(r"^[^\w]*[\d.,  ]+ ?(?:€|EUR|USD|£|\$)$|^(?:€|EUR|USD|£|\$) ?[\d.,  ]+$", x):
        return False
    if x[0].islower():
        return False
    return apart or not re.search(r"[,;:!?]$", x) and not (x.endswith(".") and not re.search(r"\b(?:[^\W\d_]\.)+$", x))


_MARKED_TITLE = re.compile(r"\d{4}\)?$| [/·|–—] |[^\W\d_] {2,}\S")


def _edge_kinds(lines: list[str], numbers: list[int], edges: list[int]) -> list[tuple[int, str]]:
    """Lines at the edges of the page: 'edge' where form or place says header, 'maybe' where only its
    recurrence can."""
    full = [i for i, x in enumerate(lines) if x and not x.isspace() and i not in numbers]
    out = [(i, "edge") for i in edges]
    for i in {*full[:2], *full[-2:]} - set(edges):
        if _title(x := lines[i].strip(), False):
            out.append((i, "edge" if _MARKED_TITLE.search(x) else "maybe"))
    return out


def _stands_alone(lines: list[str], i: int, nxt: int, width: int, apart: bool) -> bool:
    """A top line that no wrapped sentence runs on from."""
    x, y = lines[i].strip(), lines[nxt].strip()
    if not _title(x, apart) or x[-1] in BREAK_MARKS:
        return False
    if apart:
        return True
    first = y.split(" ", 1)[0]
    return not y[:1].islower() and (len(x) + 1 + len(first) <= width or bool(re.search(r"\d{4}\)?$| [/·|–—] ", x)))


def _prepared(raw: str) -> tuple[str, list[tuple[str, str]]]:
    """Text in its consistent form with JOINT where a word was broken, and the breaks as (left, right)."""
    breaks: list[tuple[str, str]] = []
    parts, done = [], 0
    for m in _MARKED_END.finditer(raw):
        both = canonical(raw[raw.rfind("\n", 0, m.start()) + 1 : m.start()] + JOINT + _NEXT.match(raw, m.end())[0])
        line, _, rest = both.rpartition(JOINT) if JOINT not in raw else (both, "", "")
        left, right = _TAIL.search(line), _HEAD.match(rest)
        if left and right and _LETTER.search(left[0]) and _LETTER.search(right[0]) and not _CODE.match(left[0]):
            breaks.append((left[0], right[0]))
            parts += [raw[done : m.start()], JOINT]
            done = m.end()
    return canonical("".join(parts) + raw[done:]), breaks


# --------------------------------------------------------------------------------------------- counts


def facts(df: DataFrame) -> DataFrame:
    """All that one pass over the texts finds, told apart by kind:
    bigram: a before b, n times in all rows and m times in body sentences of scanned pages, counted within a
    task as long as MOST_HELD entries hold them;
    break: a and b parted at a line end of result_id; page_number, edge, maybe: such a line with the digest of its shape;
    body: the words of the body sentences of result_id, each line behind its number, blocks behind an empty line.
    A word joined from a break counts as no evidence (n 0), it is only a word to judge."""

    def flush(total: Counter, scanned: Counter) -> dict[str, list]:
        keys = list(total.keys() | scanned.keys())
        none = [None] * len(keys)
        cols = dict.fromkeys(_FACTS, none)
        return cols | {"kind": ["bigram"] * len(keys), "a": [k[0] for k in keys], "b": [k[1] for k in keys], "n": [total[k] for k in keys], "m": [scanned[k] for k in keys]}

    def run(batches):
        total: Counter = Counter()
        scanned: Counter = Counter()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in _FACTS}

            def add(*values):
                for k, v in zip(_FACTS, values, strict=True):
                    out[k].append(v)  # noqa: B023

            for rid, item, source, page, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if source != "ocr":
                    # a word broken before a small letter counts as one; other parts are no evidence, nor what stands beside them
                    for part in _BROKEN.split(_SMALL_RIGHT.sub(r"\1", _prepared(raw)[0])) if _MARKED_END.search(raw) else (canonical(raw),):
                        words = _NATIVE_TOKEN.findall(part)
                        total.update(zip(["", *words], words, strict=False))
                    continue
                text, broken = _prepared(raw)
                for left, right in dict.fromkeys(broken):
                    add("break", left, right, None, None, rid, item, None, None, None)
                lines, numbers, edges, blocks = layout(text, page)
                for i, kind in [*((i, "page_number") for i in numbers), *_edge_kinds(lines, numbers, edges)]:
                    shape = _shape(" ".join(lines[i].split())).encode("utf-8", "surrogatepass")
                    add(kind, None, None, None, None, rid, item, i, hashlib.blake2b(shape, digest_size=16).digest(), None)
                body = {i for b in blocks for i in b}
                words = _NATIVE_TOKEN.findall("\n".join(x for i, x in enumerate(lines) if i not in body).replace(JOINT, "\n"))
                total.update(zip(["", *words], words, strict=False))
                kept = []
                for b in blocks:
                    part = " ".join(lines[i] for i in b)
                    by_line = [_TOKEN.findall(lines[i]) for i in b]
                    words = [w for ws in by_line for w in ws]
                    kept.append("\n".join(f"{i}\t{' '.join(ws)}" for i, ws in zip(b, by_line, strict=True)))
                    pairs = list(zip(["", *words], words, strict=False))
                    if JOINT in part:
                        scanned.update((u.replace(JOINT, ""), v.replace(JOINT, "")) for u, v in pairs if JOINT in u or JOINT in v)
                        pairs = [(u, v) for u, v in pairs if JOINT not in u and JOINT not in v]
                    total.update(pairs)
                    scanned.update(pairs)
                if kept:
                    add("body", None, None, None, None, rid, item, None, None, "\n\n".join(kept))
            yield out
            if len(total) + len(scanned) > MOST_HELD:
                yield flush(total, scanned)
                total.clear()
                scanned.clear()
        yield flush(total, scanned)

    src = df.where(F.col("text").isNotNull()).select("result_id", "item_id", "source", "page", "text")
    return arrow_stream(src, run, "kind string, a string, b string, n bigint, m bigint, result_id bigint, item_id bigint, line int, key binary, body string")


_FACTS = ("kind", "a", "b", "n", "m", "result_id", "item_id", "line", "key", "body")


def bigram_counts(found: DataFrame) -> DataFrame:
    """(prev, word, n, n_ocr) of the corpus."""
    rows = found.where("kind = 'bigram'").select(F.col("a").alias("prev"), F.col("b").alias("word"), "n", "m")
    return rows.groupBy("prev", "word").agg(F.sum("n").alias("n"), F.sum("m").alias("n_ocr"))


def undone(source: str, read: str) -> list[int] | None:
    """The fewest confusions that turn what the page said into what was read; None where none do."""
    n, m = len(source), len(read)
    best: list[dict[int, list[int]]] = [{} for _ in range(n + 1)]
    best[0][0] = []
    for i in range(n):
        starts = _BY_FIRST.get(source[i], ())
        for j, path in best[i].items():
            if j < m and source[i] == read[j]:
                known = best[i + 1].get(j + 1)
                if known is None or len(known) > len(path):
                    best[i + 1][j + 1] = path
            for k, a, b in starts:
                if read.startswith(b, j) and source.startswith(a, i):
                    known = best[i + len(a)].get(j + len(b))
                    if known is None or len(known) > len(path) + 1:
                        best[i + len(a)][j + len(b)] = [*path, k]
    return best[n].get(m)


_BY_FIRST: dict[str, list[tuple[int, str, str]]] = {}
for _k, (_a, _b) in enumerate(_PAIRS):
    _BY_FIRST.setdefault(_a[0], []).append((_k, _a, _b))


def word_counts(bigrams: DataFrame) -> DataFrame:
    return bigrams.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_ocr").alias("n_ocr"))


def candidates(counts: DataFrame) -> DataFrame:
    """(word, n, options) of words that a more probable word can have become."""
    # a word seen on scanned pages alone is hardly a word of its own right; a known word has no digit no letter is read as
    rare = F.exp(-LONG_RATE * F.greatest(F.length("word") - LONG_WORD, F.lit(0)))
    own = F.greatest(F.col("n") - F.col("n_ocr"), F.lit(0)) + SCAN_TRUST * F.col("n_ocr") * rare

    def keys(batch):
        ws = batch.column(0).to_pylist()
        return {"word": ws, "n": batch.column(1).to_pylist(), "n_ocr": batch.column(2).to_pylist(), "own": batch.column(3).to_pylist(), "shape": [_shape(w) for w in ws]}

    shaped = cut(arrow_map(counts.select("word", "n", "n_ocr", own.alias("own")), keys, "word string, n bigint, n_ocr bigint, own double, shape string"), "shapes")
    word = F.col("word")
    asked = shaped.where((F.col("n_ocr") > 0) & (F.length("word") >= 2) & word.rlike(r"\p{L}") & ~word.rlike(rf"[{_NO_SHAPE}]"))
    real = shaped.where("n > 1").select("shape", F.col("word").alias("cand"), F.col("n").alias("n_cand"), F.col("n_ocr").alias("n_cand_ocr"))
    both = asked.select("shape", "word", F.col("own").alias("n"), "n_ocr").join(real, "shape").where("word <> cand").drop("shape")

    def run(batch):
        cols = {c: batch.column(i).to_pylist() for i, c in enumerate(("word", "n", "n_ocr", "cand", "n_cand", "n_cand_ocr"))}
        errors = [undone(c, w) for c, w in zip(cols["cand"], cols["word"], strict=True)]
        return cols | {"errors": errors}

    met = arrow_map(both, run, "word string, n double, n_ocr bigint, cand string, n_cand bigint, n_cand_ocr bigint, errors array<int>")
    met = cut(met.where("errors is not null"), "readings")
    # confusion probabilities: how often each confusion explains a rare word, against what it could have hit
    one = met.where("size(errors) = 1 and n_cand > 20 * (n + 1)")
    seen = one.groupBy(F.col("errors")[0].alias("k")).agg(F.sum("n_ocr").alias("hits"), F.sum("n_cand_ocr").alias("base")).collect()  # at most one row a confusion
    p = [START_P] * len(_PAIRS)
    for r in seen:
        p[r["k"]] = min(0.05, max(START_P / 3, r["hits"] / max(r["base"], 1)))
    logs = F.array(*[F.lit(math.log(x)) for x in p])
    channel = F.aggregate("errors", F.lit(0.0), lambda a, k: a + F.get(logs, k))
    scored = met.select("word", "n", "cand", "n_cand", channel.alias("channel"))
    # plausible: the source alone or with its context could outweigh what was read
    plausible = scored.where(F.log("n_cand") + F.col("channel") > F.log(F.col("n") + UNSEEN * rare) - 2.0)
    return plausible.groupBy("word").agg(F.max("n").alias("n"), F.collect_list(F.struct("cand", "n_cand", "channel")).alias("options"))


def contexts(bigrams: DataFrame, options: DataFrame) -> DataFrame:
    """(prev, word, edges): for each bigram read that holds a word with options, the counts of the bigrams
    the page may have said."""
    o = options.select("word", F.transform("options", lambda x: x["cand"]).alias("cands"))
    read = bigrams.where("n_ocr > 0").select("prev", "word")
    left = read.join(o.select(F.col("word").alias("prev"), F.col("cands").alias("pc")), "prev", "left")
    both = left.join(o.select("word", F.col("cands").alias("wc")), "word", "left").where("pc is not null or wc is not null")
    none = F.array().cast("array<string>")
    wide = both.select("prev", "word", F.explode(F.concat(F.array("prev"), F.coalesce("pc", none))).alias("u"), F.concat(F.array("word"), F.coalesce("wc", none)).alias("vs"))
    wide = wide.select("prev", "word", "u", F.explode("vs").alias("v"))
    own = F.greatest(F.col("n") - F.col("n_ocr"), F.lit(0)) + SCAN_TRUST * F.col("n_ocr")
    known = bigrams.where("n > 0").select(F.col("prev").alias("u"), F.col("word").alias("v"), own.alias("n"))
    return wide.join(known, ["u", "v"]).groupBy("prev", "word").agg(F.collect_list(F.struct("u", "v", "n")).alias("edges"))


# -------------------------------------------------------------------------------------------- decoding


def viterbi(tokens: list[str], options: dict[str, tuple[float, list]], edges: dict[tuple[str, str], dict[tuple[str, str], float]], total: float, unigrams: dict[str, float]) -> list[str]:
    """Most probable words of a line given what was read."""
    keep = math.log(1 - 20 * START_P)
    paths: dict[str, tuple[float, list[str]]] = {"": (0.0, [])}
    for i, w in enumerate(tokens):
        prev_read = tokens[i - 1] if i else ""
        own = options.get(w)
        states = [(w, keep, own[0] if own else unigrams.get(w, 1))] + ([(o["cand"], o["channel"], o["n_cand"]) for o in own[1]] if own else [])
        known = edges.get((prev_read, w), {})
        new: dict[str, tuple[float, list[str]]] = {}
        if len(states) == 1 and len(paths) == 1:
            ((score, path),) = paths.values()
            paths = {w: (score, [*path, w])}
            continue
        for v, channel, n in states:
            unseen = UNSEEN * math.exp(-LONG_RATE * max(0, len(v) - LONG_WORD))
            best = None
            for u, (score, path) in paths.items():
                pu = max(unigrams.get(u, 0), 1)
                lm = INTERPOLATION * known.get((u, v), 0) / pu + (1 - INTERPOLATION) * (n + unseen) / total
                s = score + channel + math.log(lm)
                if best is None or s > best[0]:
                    best = (s, path)
            new[v] = (best[0], [*best[1], v])
        paths = new
    return max(paths.values(), key=lambda x: x[0])[1]


def ocr_rows(df: DataFrame) -> DataFrame:
    return df.where((F.col("source") == "ocr") & F.col("text").isNotNull() & (F.trim("text") != "")).select("result_id", "item_id", "page", "text")


def corrections(found: DataFrame, bigrams: DataFrame, counts: DataFrame) -> DataFrame:
    """(result_id, line, pos, word, corrected) of the misread words of body sentences."""
    options = cut(candidates(counts), "options")
    edges = contexts(bigrams, options)
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    bloom = word_filter(options.select("word"))

    def runs(batch):
        may = bloom.test()
        out: dict[str, list] = {k: [] for k in ("result_id", "lines", "places", "tokens", "run")}
        for rid, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for block in body.replace(JOINT, "").split("\n\n"):
                words: list[str] = [""]
                at: list[tuple[int, int]] = [(0, 0)]
                for line in block.split("\n"):
                    i, _, ws = line.partition("\t")
                    if ws:
                        ws = ws.split(" ")
                        words += ws
                        at += [(int(i), p) for p in range(len(ws))]
                words.append("")
                j = 1
                while j < len(words) - 1:
                    if not may(words[j]):
                        j += 1
                        continue
                    first = j
                    while j < len(words) - 1 and may(words[j]):
                        j += 1
                    tokens = words[first - 1 : j + 1]
                    out["result_id"].append(rid)
                    out["lines"].append([x[0] for x in at[first:j]])
                    out["places"].append([x[1] for x in at[first:j]])
                    out["tokens"].append(tokens)
                    out["run"].append(hashlib.blake2b("\0".join(tokens).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        return out

    met = arrow_map(found.where("kind = 'body'").select("result_id", "body"), runs, "result_id bigint, lines array<int>, places array<int>, tokens array<string>, run binary")
    met = cut(met, "runs")
    around = F.transform(F.sequence(F.lit(1), F.size("tokens") - 2), lambda i: F.struct(F.get("tokens", i - 1).alias("prev"), F.get("tokens", i).alias("word"), F.get("tokens", i + 1).alias("next")))
    each = met.groupBy("run").agg(F.first("tokens").alias("tokens")).select("run", F.posexplode(around).alias("pos", "w")).select("run", "pos", "w.*")
    # narrow joins first, so that the arrays of options and edges travel as little as can be
    n_prev = counts.select(F.col("word").alias("prev"), F.col("n").alias("n_prev"))
    e1 = edges.select("prev", "word", F.col("edges").alias("before"))
    e2 = edges.select(F.col("prev").alias("word"), F.col("word").alias("next"), F.col("edges").alias("after"))
    a = each.join(n_prev, "prev", "left").join(e1, ["prev", "word"], "left").join(e2, ["word", "next"], "left").join(options, "word", "left")
    per_run = a.groupBy("run").agg(F.collect_list(F.struct("pos", "prev", "word", "next", "n", "n_prev", "options", "before", "after")).alias("words"))

    def decode(batch):
        out: dict[str, list] = {"run": [], "pos": [], "corrected": []}
        for run, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words.sort(key=lambda x: x["pos"])
            for x, c in zip(words, _decode_run(words, total), strict=True):
                if c != x["word"]:
                    out["run"].append(run)
                    out["pos"].append(x["pos"])
                    out["corrected"].append(c)
        return out

    changed = arrow_map(per_run, decode, "run binary, pos int, corrected string")
    hit = met.join(changed, "run")
    return hit.select("result_id", F.get("lines", F.col("pos")).alias("line"), F.get("places", F.col("pos")).alias("pos"), F.get("tokens", F.col("pos") + 1).alias("word"), "corrected")


def _decode_run(run_: list[dict], total: float) -> list[str]:
    """Viterbi over adjacent words with options, between the fixed words around them."""
    tokens = [run_[0]["prev"], *(x["word"] for x in run_), run_[-1]["next"]]
    options = {x["word"]: (x["n"], x["options"]) for x in run_ if x["options"]}
    unigrams = {run_[0]["prev"]: run_[0]["n_prev"] or 1}
    edges: dict[tuple[str, str], dict[tuple[str, str], float]] = {}
    for x in run_:
        unigrams[x["word"]] = x["n"] or 1
        for o in x["options"] or []:
            unigrams[o["cand"]] = o["n_cand"]
        for key, es in (((x["prev"], x["word"]), x["before"]), ((x["word"], x["next"]), x["after"])):
            edges[key] = {(e["u"], e["v"]): e["n"] for e in es or []}
    if not tokens[-1]:
        tokens.pop()
    found = viterbi(tokens, options, edges, total, unigrams)
    return found[1 : 1 + len(run_)]


# ------------------------------------------------------------------------------------- the other kinds


def headers(lines: DataFrame, least: int = 3) -> DataFrame:
    """Edge lines that recur on at least `least` scanned rows of their item, where one of them at least is
    told by its form or place."""
    edge = lines.where("kind in ('edge', 'maybe') and item_id is not null").select("item_id", "key", "result_id", "line", "kind").distinct()
    often = edge.groupBy("item_id", "key").agg(F.countDistinct("result_id").alias("n"), F.min("kind").alias("told")).where((F.col("n") >= least) & (F.col("told") == "edge"))
    return edge.drop("kind").join(often.select("item_id", "key"), ["item_id", "key"])


def breaks(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(result_id, left, right, joined, broken): words broken at a line end; broken is false where the word
    is spelled with a hyphen.  The spelling the corpus knows better wins; where it knows neither, a part
    in lower case continues the word."""
    pairs = found.where("kind = 'break'").select("result_id", F.col("a").alias("left"), F.col("b").alias("right"))
    pairs = pairs.select("*", F.concat("left", "right").alias("joined"), F.concat_ws("-", "left", "right").alias("spelled"))
    c = counts.where("n > 0")
    pairs = pairs.join(c.select(F.col("word").alias("joined"), F.col("n").alias("n_joined")), "joined", "left")
    pairs = pairs.join(c.select(F.col("word").alias("spelled"), F.col("n").alias("n_spelled")), "spelled", "left")
    a, b = F.coalesce("n_joined", F.lit(0)), F.coalesce("n_spelled", F.lit(0))
    broken = F.when(a == b, F.col("right").rlike(r"^[\p{Ll}\d]")).otherwise(a > b)
    return pairs.select("result_id", "left", "right", "joined", broken.alias("broken"))


def noise(df: DataFrame) -> DataFrame:
    """(result_id, noise) of every scanned row."""
    found = cut(facts(df), "facts", by=("kind",))
    bigrams = cut(bigram_counts(found), "bigrams")
    counts = cut(word_counts(bigrams), "word-counts")
    lines = found.where("kind in ('page_number', 'edge', 'maybe')").select("result_id", "item_id", "line", "kind", "key")
    parts = [
        breaks(found, counts).where("broken").select("result_id", F.lit("hyphen").alias("noise")),
        corrections(found, bigrams, counts).select("result_id", F.lit("misread").alias("noise")),
        headers(lines).select("result_id", F.lit("header").alias("noise")),
        lines.where("kind = 'page_number'").select("result_id", F.lit("page_number").alias("noise")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.distinct()


def repaired(df: DataFrame) -> DataFrame:
    """(result_id, repaired_text): headers and page numbers dropped, breaks undone, misread words replaced,
    lines joined to paragraphs."""
    found = cut(facts(df), "facts", by=("kind",))
    bigrams = cut(bigram_counts(found), "bigrams")
    counts = cut(word_counts(bigrams), "word-counts")
    lines = found.where("kind in ('page_number', 'edge', 'maybe')").select("result_id", "item_id", "line", "kind", "key")
    drop = headers(lines).select("result_id", "line").unionAll(lines.where("kind = 'page_number'").select("result_id", "line"))
    drops = drop.groupBy("result_id").agg(F.collect_set("line").alias("drops"))
    fixes = corrections(found, bigrams, counts).groupBy("result_id").agg(F.collect_list(F.struct("line", "pos", "corrected")).alias("fixes"))
    hyphens = breaks(found, counts).where("not broken").groupBy("result_id").agg(F.collect_list(F.struct("left", "right")).alias("spelled"))
    rows = ocr_rows(df).dropDuplicates(["result_id"]).select("result_id", "text")
    rows = rows.join(drops, "result_id", "left").join(fixes, "result_id", "left").join(hyphens, "result_id", "left")

    def run(batch):
        out = []
        for raw, dropped, fixed, spelled in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
            keep = {(x["left"], x["right"]) for x in spelled or []}
            put = {(x["line"], x["pos"]): x["corrected"] for x in fixed or []}
            text, _ = _prepared(raw)
            paragraphs: list[list[str]] = [[]]
            for i, line in enumerate(text.split("\n")):
                if not line.strip():
                    paragraphs.append([])
                elif i not in (dropped or ()):
                    n = iter(range(len(line)))

                    def word(m, i=i, n=n):
                        w = put.get((i, next(n)), m.group())
                        if JOINT in w:
                            left, right = w.split(JOINT, 1)
                            w = f"{left}-{right}" if (left, right) in keep else left + right
                        return w

                    paragraphs[-1].append(_TOKEN.sub(word, line.strip()))
            out.append("\n\n".join(" ".join(p) for p in paragraphs if p))
        return {"result_id": batch.column(0).to_pylist(), "repaired_text": out}

    return arrow_map(rows, run, "result_id bigint, repaired_text string")

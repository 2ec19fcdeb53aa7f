"""Problem 4: statistics that tell prose from lists, tables and junk.

Of each page: counts of words, lines, symbols, line ends, frequent words; and repetition: shares of
duplicate lines and paragraphs, share of characters in the dominant word bigram and in repeated word
5-grams, share of lines that begin or end with the same mark (a bullet, a number, a leader with its page).
Combined rules give a kind: junk has mostly unreadable characters, boilerplate says mostly the same again, a
table has mostly rows of cells with figures, a list is made of entries that form no sentences (short entries,
marks that recur and lines that recur add up), the rest is prose, also in short lines.  Pages roll up to
documents in one aggregation by item.

Garbled letters (problem 3) count as letters and keep sentence ends, so a garbled page keeps the kind of
its original.

Defined results: pages with null text or fewer than 40 visible characters are not countable; a document
without countable pages has no kind (null).  A page delivered twice counts once.  Null stored word counts
and coverages are left out of their averages.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

LEAST_CHARS = 40
KINDS = ("prose", "list", "table", "junk", "boilerplate")
MOST_REPEATED = 0.5  # share of the characters in repetitions beyond which a page is boilerplate
LIST_SCORE = 0.5

_SPLIT = re.compile(r"[\s|;]+")
_PARAGRAPH = re.compile(r"\n[ \t]*\n")
_SENTENCE_END = re.compile(r"(?<=[^\s.])(?:\.\.\.|[.!?…])[\"”“»’)\]]*(?= |$)")
_LINE_END = re.compile(r"[^\s.][.!?…][\"”“»’)\]]*$")
_BULLET = re.compile(r"^(?:[-*•–·—+]|\d{1,3}[.)]|[a-zA-Z][.)]) ")
_TWO_LETTERS = re.compile(r"[^\W\d_]{2}")
_FORM = re.compile(r"[^\W_]")
_RUN = re.compile(r"(.)\1+")
_PLAIN = re.compile(r"[^\W_]+| +")
_CID = re.compile(r"\(cid:\d+\)")
_HEX = re.compile(r"^(?=.*\d)(?=.*[a-f])[0-9a-f]{6,}$|^\d{8}$")
_VOWEL = re.compile("[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿœаеёиоуыэюяіїє]", re.IGNORECASE)
_LETTER = re.compile(r"[^\W\d_]")
_LAST = set(".!?…\"”“»’)]")
_EDGE = ".,;:()[]„“”\"'’!?«»…"
_STROKES = set("il1|")
_DEBRIS = set("«»°¦¬·*§")

WORD, FIGURE, UNREADABLE, MARK = range(4)


def token_class(t: str) -> int:
    """A readable word, a figure or code, an unreadable string, or a mark that says nothing."""
    core = t.strip(_EDGE)
    if not core:
        return MARK if len(t) <= 3 or set(t) <= {"."} else UNREADABLE
    if "�" in core and core.count("�") * 3 >= len(core) or any("" <= c <= "" or c < " " for c in core):
        return UNREADABLE
    if _HEX.match(core):
        return UNREADABLE
    if len(core) >= 3 and set(core.lower()) <= _STROKES and not core.isdigit():
        return UNREADABLE
    if any(c.isdigit() for c in core):
        return FIGURE
    if core.isascii():
        if not _LETTER.search(core):
            return MARK if len(core) <= 1 else UNREADABLE
        if len(core) <= 3 and core.isalpha() and len(set(core.lower())) > 1:
            return WORD
        low = core.lower()
        kinds = len(set(low))
        if kinds == 1 and len(core) >= 3 or kinds == 2 and len(core) >= 4:
            return UNREADABLE
        return WORD if _VOWEL.search(core) or len(core) <= 4 and not core.islower() else UNREADABLE
    odd = [c for c in core if ord(c) > 127]
    if all(c in _DEBRIS for c in odd) and not _LETTER.search(core):
        return MARK if len(core) <= 1 else UNREADABLE
    if len(odd) * 2 >= len(core) or _VOWEL.search(core):
        return WORD
    return WORD if _LETTER.search(core) else UNREADABLE


class PageStats:
    """Statistics of one page after another; classes of tokens are remembered."""

    FIELDS = ("n_chars", "n_words", "n_lines", "mean_word_length", "symbol_ratio", "end_mark_share", "common_share", "figure_share", "unreadable_share", "sentence_share", "short_line_share", "duplicate_line_share", "duplicate_paragraph_share", "top_bigram_coverage", "repeated_5gram_coverage", "repeated_mark_share")

    def __init__(self, common: frozenset[str]) -> None:
        self.common, self.memo, self.marks = common, {}, {}

    def know(self, token: str) -> tuple[int, str]:
        """Class and plain form of a token."""
        known = (token_class(token), token.strip(_EDGE).lower())
        if len(self.memo) < 300_000:
            self.memo[token] = known
        return known

    def mark(self, token: str) -> str:
        """The form of a bullet, a number or a leader; empty for words."""
        known = self.marks.get(token)
        if known is None:
            known = "" if _TWO_LETTERS.search(token) else _RUN.sub(r"\1", _FORM.sub(lambda m: "0" if m[0].isdigit() else "a", token))
            if len(self.marks) < 100_000:
                self.marks[token] = known
        return known

    def __call__(self, text: str) -> tuple[str | None, dict]:
        chars = len("".join(text.split()))
        lines = [x.strip() for x in text.split("\n") if x.strip()]
        cid = sum(len(x) for x in _CID.findall(text)) if "(cid:" in text else 0
        tokens: list[str] = []
        size = [0, 0, 0, 0]
        number = [0, 0, 0, 0]
        words: list[str] = []
        rows = entries = ended = 0
        heads: Counter = Counter()
        tails: Counter = Counter()
        for line in lines:
            ts = line.split() if "|" not in line and ";" not in line else [t for t in _SPLIT.split(line) if t]
            n = [0, 0, 0, 0]
            for t in ts:
                known = self.memo.get(t) or self.know(t)
                c = known[0]
                n[c] += 1
                size[c] += len(t)
                words.append(known[1])
            ends = line[-1] in _LAST and bool(_LINE_END.search(line[-8:]))
            ended += ends
            for k in range(4):
                number[k] += n[k]
            tokens += ts
            if ts:
                heads[self.mark(ts[0])] += 1
                tails[self.mark(ts[-1])] += 1
            cells = sum(n) - n[MARK] + (line.count(" - ") if n[FIGURE] > 1 else 0)
            if n[FIGURE] >= 2 and n[FIGURE] * 2 >= cells and not ends:
                rows += 1
            elif len(ts) <= 12 and (not ends or _BULLET.match(line)):
                entries += 1
        total = max(1, sum(number) - number[MARK])
        visible = max(1, sum(size))
        unreadable = (size[UNREADABLE] if not cid else max(size[UNREADABLE], cid)) / visible
        joined = " ".join(text.split())
        in_sentences, at, count = 0, 0, 0
        for m in _SENTENCE_END.finditer(joined):
            n_words = joined.count(" ", at, m.end())
            if n_words >= 4 and not _short_stop(joined, m.start()):
                in_sentences += n_words + (at == 0)
                count += 1
                at = m.end()
        marks = max((c for m in (heads, tails) for k, c in m.items() if k and c > 1), default=0)
        several = Counter(lines)
        paragraphs = [p.strip() for p in _PARAGRAPH.split(text) if p.strip()]
        several_p = Counter(paragraphs)
        pairs = Counter(zip(words, words[1:], strict=False))
        again = [(g, n) for g, n in pairs.items() if n > 1]
        top, top_n = max(again, key=lambda x: x[1] * (len(x[0][0]) + len(x[0][1]))) if again else (("", ""), 0)
        fives = Counter(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False)) if again else {}
        stats = {
            "n_chars": chars,
            "n_words": number[WORD] + number[FIGURE],
            "n_lines": len(lines),
            "mean_word_length": sum(map(len, words)) / max(1, len(words)),
            "symbol_ratio": len(_PLAIN.sub("", joined)) / max(1, chars),
            "end_mark_share": ended / max(1, len(lines)),
            "common_share": sum(1 for x in words if x in self.common) / max(1, len(words)),
            "figure_share": number[FIGURE] / total,
            "unreadable_share": unreadable,
            "sentence_share": min(1.0, in_sentences / max(1, len(tokens))),
            "short_line_share": entries / max(1, len(lines)),
            "duplicate_line_share": sum(n - 1 for n in several.values()) / max(1, len(lines)),
            "duplicate_paragraph_share": sum(n - 1 for n in several_p.values()) / max(1, len(paragraphs)),
            "top_bigram_coverage": min(1.0, top_n * (len(top[0]) + len(top[1])) / max(1, chars)) if top_n > 1 else 0.0,
            "repeated_5gram_coverage": _covered(words, fives) / max(1, sum(map(len, words))) if again and max(fives.values(), default=1) > 1 else 0.0,
            "repeated_mark_share": marks / max(1, len(lines)),
        }
        if chars < LEAST_CHARS:
            return None, stats
        # entries that form no sentences: short ones, marks that recur and lines that recur add up
        of_list = 0.5 * stats["short_line_share"] + 0.5 * stats["repeated_mark_share"] + stats["duplicate_line_share"] + 0.5 * stats["top_bigram_coverage"]
        if unreadable > 0.5:
            kind = "junk"
        elif max(stats["repeated_5gram_coverage"], stats["duplicate_paragraph_share"], stats["top_bigram_coverage"]) > MOST_REPEATED:
            kind = "boilerplate"
        elif rows * 2 > len(lines):
            kind = "table"
        elif stats["sentence_share"] < 0.5 and (of_list > LIST_SCORE or len(lines) >= 3 and entries * 2 > len(lines)):
            kind = "list"
        else:
            kind = "prose"
        return kind, stats


def _covered(words: list[str], fives: Counter) -> int:
    """Characters of the words that lie in a word 5-gram said more than once."""
    total = end = 0
    for i, g in enumerate(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False)):
        if fives[g] > 1:
            total += sum(map(len, words[max(i, end) : i + 5]))
            end = i + 5
    return total


def _short_stop(s: str, at: int) -> bool:
    """A full stop after an initial or an ordinal ends no sentence."""
    start = s.rfind(" ", 0, at) + 1
    word = s[start:at].lstrip("(«„“")
    return len(word) <= 1 or word.isdigit() and len(word) <= 2 or "." in word and not any(c.isdigit() for c in word) and len(word) <= 4


def page_stats(df: DataFrame, common_words: DataFrame) -> DataFrame:
    """(analysis_id, item_id, kind, word_count, image_coverage, statistics) of each analysed page."""
    common = frozenset(r["word"].lower() for r in common_words.where("word is not null").select("word").distinct().collect())
    keep = ("analysis_id", "item_id", "word_count", "image_coverage")

    def run(batch):
        cols = {k: batch.column(i).to_pylist() for i, k in enumerate(keep)}
        measure = run.__dict__.setdefault("m", PageStats(common))
        kinds, rows = [], []
        for t in batch.column(len(keep)).to_pylist():
            kind, stats = measure(t or "")
            kinds.append(kind)
            rows.append(stats)
        return cols | {"kind": kinds} | {f: [r[f] for r in rows] for f in PageStats.FIELDS}

    ints = {"n_chars", "n_words", "n_lines"}
    schema = "analysis_id bigint, item_id bigint, word_count int, image_coverage double, kind string, " + ", ".join(f"{f} {'bigint' if f in ints else 'double'}" for f in PageStats.FIELDS)
    return arrow_map(df.select("analysis_id", "item_id", F.col("word_count").cast("int").alias("word_count"), F.col("image_coverage").cast("double").alias("image_coverage"), "text"), run, schema)


def document_stats(pages: DataFrame) -> DataFrame:
    """One row per item: pages by kind, statistics weighted by words, and the kind of more than half of its
    countable pages (null where there is none)."""
    once = pages.dropDuplicates(["analysis_id"])
    n = {k: F.sum((F.col("kind") == k).cast("int")).alias(f"{k}_pages") for k in KINDS}
    shares = [f for f in PageStats.FIELDS if not f.startswith("n_")]
    weight = F.greatest(F.col("n_words"), F.lit(1))
    docs = once.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count("kind").alias("countable_pages"),
        *n.values(),
        F.sum("n_words").alias("n_words"),
        F.sum("n_chars").alias("n_chars"),
        *[(F.sum(F.col(f) * weight) / F.sum(weight)).alias(f) for f in shares],
        F.sum("word_count").alias("stored_word_count"),
        F.avg("image_coverage").alias("mean_image_coverage"),
    )
    kind = F.coalesce(*[F.when(F.col(f"{k}_pages") * 2 > F.col("countable_pages"), k) for k in KINDS])
    return docs.withColumn("kind", kind)

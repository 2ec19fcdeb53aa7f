"""Problem 2: a language with a confidence for every text and every paragraph.

A bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time,
labels every position with one of the languages or none (lists, tables, headings, debris, other languages).
One recurrent step reads PATCH bytes, each with its own embedding by place, and each of these positions gets a
label of its own.  Probabilities pool over the positions of a sentence, a segment, a paragraph and a text.

Gates and candidates use v / (1 + |v|) in place of sigmoid and tanh: alike in form, several times cheaper.

Training: a bounded sample of labelled rows (SAMPLE_ROWS, ordered by a hash of the id), kept where the
frequent words of the claimed language outnumber those of any other; copies garbled as in problem 3 teach
the network that a garbled text has the language of its original, and copies with letters exchanged, vowels for
vowels, that text can be of no language known here.  The weights (about 0.4 MB, independent of the data) are kept
by a key of the sample, so queries on the same sample fit once, and broadcast; every row is then labelled in one map without a shuffle.

Defined results: null, empty and blank texts get a null language with confidence 0; where none of the languages
prevails (lists, other languages) the language is 'other'.  Rows delivered twice
count once.  Texts of any length are labelled whole, in windows of WINDOW bytes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .canonical import canonical
from .common import arrow_map, portions, shared_dir, ship
from .mojibake import garbled_forms

# The languages, and how senders spell them.
LANGS = ("deu", "eng", "fra", "spa", "nld", "rus")
SPELLINGS = {
    "deu": ("de", "deu", "ger", "german", "deutsch", "allemand", "alemán", "duits", "немецкий"),
    "eng": ("en", "eng", "english", "englisch", "anglais", "inglés", "engels", "английский"),
    "fra": ("fr", "fra", "fre", "french", "français", "francais", "französisch", "francés", "frans", "французский"),
    "spa": ("es", "spa", "spanish", "español", "espanol", "castellano", "spanisch", "espagnol", "spaans", "испанский"),
    "nld": ("nl", "nld", "dut", "dutch", "nederlands", "niederländisch", "néerlandais", "neerlandés", "нидерландский"),
    "rus": ("ru", "rus", "russian", "русский", "russisch", "russe", "ruso"),
}
NONE = len(LANGS)
SAMPLE_ROWS = 5000  # labelled rows the classifier is fitted on, at most
PATCH, HIDDEN, WINDOW = 4, 16, 512
OTHER = "other"  # result where none of the languages prevails
PORTION = 1_000_000  # characters labelled at a time
PARAGRAPH_WEIGHT = 0.6  # of the paragraph's probabilities against those of a sentence itself
LEAST_SHARE = 0.5  # pooled probability a sentence needs to count for its language

_BLOCK = re.compile(r"\n[ \t]*\n\s*")
_END = re.compile(r"(?<=[^\s.])(?:\.\.\.|[.!?…])[\"”“»’)\]]*(?= |$)")
_ABBREVIATION = re.compile(r"(?:^|[ («„“])(?:\d{1,2}|(?:[^\W\d_]\.)*[^\W\d_]|[Nn]r|[Nn]o|Co|Ltd|Inc|St|Dr|bzw|ca|usw|etc)$")


def named(label: Column) -> Column:
    """Languages a claimed label names, in any spelling; empty where it says nothing."""
    words = F.transform(F.split(F.lower(F.coalesce(label, F.lit(""))), r"[+,/;&|\s]+"), lambda w: F.regexp_replace(w, r"[-_][a-z0-9]+$", ""))
    table = F.create_map(*[F.lit(x) for lang, all_ in SPELLINGS.items() for s in all_ for x in (s, lang)])
    return F.array_distinct(F.array_compact(F.transform(words, lambda w: F.try_element_at(table, w))))


# ------------------------------------------------------------------------------------------ the network


def new_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    g = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    return {
        "tab": g(PATCH * 257, 6 * HIDDEN, scale=0.08),
        "U": g(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "W": g(2 * HIDDEN, PATCH * (NONE + 1), scale=0.2),
        "b": np.zeros(PATCH * (NONE + 1), np.float32),
    }


def patches(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table for each patch, padded to the longest; and the number of patches."""
    n = np.array([max(1, -(-len(s) // PATCH)) for s in seqs])
    steps = int(n.max())
    out = np.full((len(seqs), steps * PATCH), 256, np.int32)
    for i, s in enumerate(seqs):
        out[i, : len(s)] = np.frombuffer(s, np.uint8)
    return out.reshape(len(seqs), steps, PATCH) + np.arange(PATCH, dtype=np.int32) * 257, n


def _bent(x: np.ndarray) -> np.ndarray:
    """v / (1 + |v|)."""
    d = np.abs(x)
    d += 1
    x /= d
    return x


def forward(w: dict[str, np.ndarray], idx: np.ndarray, n: np.ndarray, keep: bool = False):
    """Probabilities [batch, positions, classes], a position for each byte; with keep log probabilities and what
    the backward pass needs."""
    batch, steps, _ = idx.shape
    h3 = 3 * HIDDEN
    mask = (np.arange(steps)[None, :] < n[:, None]).astype(np.float32)
    states = np.empty((steps, batch, 2 * HIDDEN), np.float32)
    saved: list = [[None] * steps, [None] * steps]
    ragged = mask.all(axis=0)
    tab = w["tab"]
    x = np.empty((steps, batch, 2 * h3), np.float32)
    for t in range(steps):
        x[t] = tab[idx[:, t, 0]]
        for k in range(1, PATCH):
            x[t] += tab[idx[:, t, k]]
    for d in (0, 1):
        h = np.zeros((batch, HIDDEN), np.float32)
        u = w["U"][d]
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            a = h @ u
            xt = x[t, :, d * h3 : (d + 1) * h3]
            zr = _bent(xt[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = _bent(xt[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            step = z * (c - h)
            if not ragged[t]:
                step *= mask[:, t, None]
            if keep:
                saved[d][t] = (h, a[:, 2 * HIDDEN :], z, r, c)
            h = h + step
            states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
    logits = (states @ w["W"] + w["b"]).reshape(steps, batch, PATCH, NONE + 1)
    if keep:
        logits -= logits.max(-1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(-1, keepdims=True))
    else:  # states lie within (-1, 1), so no logit overflows
        flat = np.exp(logits, out=logits).reshape(-1, NONE + 1)
        flat /= (flat @ np.ones(NONE + 1, np.float32))[:, None]
    out = logits.transpose(1, 0, 2, 3).reshape(batch, steps * PATCH, NONE + 1)
    return (out, states, saved, mask) if keep else out


def gradients(w: dict[str, np.ndarray], idx: np.ndarray, n: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over positions, and its gradients by backpropagation through time."""
    logp, states, saved, mask = forward(w, idx, n, keep=True)
    batch, steps, _ = idx.shape
    at = (idx.reshape(batch, -1) - np.tile(np.arange(PATCH, dtype=np.int32) * 257, steps) != 256).astype(np.float32)  # bytes, no padding
    total = max(1.0, float(at.sum()))
    p = np.exp(logp)
    loss = float(-(np.take_along_axis(logp, np.broadcast_to(labels[:, None, None], (batch, steps * PATCH, 1)), 2)[..., 0] * at).sum() / total)
    p[np.arange(batch), :, labels] -= 1
    dl = (p * (at[..., None] / total)).reshape(batch, steps, -1).transpose(1, 0, 2).astype(np.float32)
    g = {"W": np.einsum("tbh,tbc->hc", states, dl), "b": dl.sum((0, 1)), "U": np.zeros_like(w["U"])}
    ds = dl @ w["W"].T
    dx = np.empty((steps, batch, 6 * HIDDEN), np.float32)
    for d in (0, 1):
        dh = np.zeros((batch, HIDDEN), np.float32)
        u = w["U"][d]
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            dh = dh + ds[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            h, ac, z, r, c = saved[d][t]
            dhm = dh * mask[:, t, None]
            dz = dhm * (c - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dc = dhm * z * (1 - np.abs(c)) ** 2
            dr = dc * ac * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            da = np.concatenate([dz, dr, dc * r], 1)
            dx[t, :, d * 3 * HIDDEN : (d + 1) * 3 * HIDDEN] = np.concatenate([dz, dr, dc], 1)
            g["U"][d] += h.T @ da
            dh = dh - dhm * z + da @ u.T
    g["tab"] = np.zeros_like(w["tab"])
    flat = dx.transpose(1, 0, 2).reshape(batch * steps, -1)
    for k in range(PATCH):
        rows = idx[:, :, k].reshape(-1)
        order = np.argsort(rows, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0])
        g["tab"][rows[order][cuts]] += np.add.reduceat(flat[order], cuts, axis=0)
    return loss, g


def train(seqs: list[bytes], labels: list[int], epochs: int = 7, batch: int = 256, rate: float = 0.012, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = new_weights(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    ys = np.array(labels)
    step, steps = 0, max(1, epochs * (-(-len(seqs) // batch)))
    for _ in range(epochs):
        order = rng.permutation(len(seqs))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            idx, n = patches([seqs[i] for i in pick])
            _, g = gradients(w, idx, n, ys[pick])
            step += 1
            lr = rate * (1 - step / (steps + 1))
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
                w[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-7)
    return w


def probabilities(w: dict[str, np.ndarray], seqs: list[bytes], batch: int = 1024) -> list[np.ndarray]:
    """[bytes, classes] of each sequence; sequences of like length run together."""
    out: list[np.ndarray | None] = [None] * len(seqs)
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    for at in range(0, len(order), batch):
        pick = order[at : at + batch]
        p = forward(w, *patches([seqs[i] for i in pick]))
        for j, i in enumerate(pick):
            out[i] = p[j, : len(seqs[i])]
    return out


# ---------------------------------------------------------------------------------------------- texts


def blocks(text: str) -> list[str]:
    """Paragraphs: what empty lines separate, its lines joined."""
    return [" ".join(b.split()) for b in _BLOCK.split(text) if b and not b.isspace()]


def sentences(block: str) -> list[tuple[str, bool]]:
    """(sentence, complete) of a paragraph; the parts concatenate to the paragraph."""
    out, at = [], 0
    for m in _END.finditer(block):
        if m.group()[0] == "." and _ABBREVIATION.search(block, max(at, m.start() - 12), m.start()) and m.end() < len(block):
            continue
        s = block[at : m.end()]
        out.append((s, s.count(" ") >= 3 and len(s) >= 15))
        at = m.end()
    if block[at:].strip():
        out.append((block[at:], False))
    return out


def training_rows(spark: SparkSession, pages: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """(language claimed, text) of a bounded sample of rows that claim exactly one language."""
    one = pages.where(F.col("text").isNotNull() & F.col("lang_label").isNotNull()).select("result_id", named(F.col("lang_label")).alias("l"), "text").where("size(l) = 1")
    # a share of the rows by hash comes to about twice the sample, so that tasks don't each offer a whole one
    share = min(1.0, 2 * rows / max(1, one.select(F.count(F.lit(1))).first()[0]))
    mark = F.pmod(F.xxhash64("result_id"), F.lit(1 << 30))
    picked = one.where(mark < int(share * (1 << 30))).orderBy(mark, "result_id", "text").limit(rows).select(F.col("l")[0].alias("lang"), "text").collect()
    return [(r["lang"], r["text"]) for r in picked]


def training_set(rows: list[tuple[str, str]], common: dict[str, set[str]], per_class: int = 2000, seed: int = 7) -> tuple[list[bytes], list[int]]:
    """Windows of bytes with their class."""
    rng = np.random.default_rng(seed)
    by: dict[int, list[str]] = {i: [] for i in range(NONE + 1)}
    for lang, text in rows:
        for block in blocks(canonical(text)):
            if not any(ok for _, ok in sentences(block)):
                by[NONE].append(block)
                continue
            words = re.findall(r"[^\W\d_]+", block.lower())
            votes = {k: sum(w in c for w in words) for k, c in common.items()}
            if votes and max(votes, key=votes.get) == lang and votes[lang] >= 2 and list(votes.values()).count(votes[lang]) == 1:
                by[LANGS.index(lang)].append(block)
    seqs: list[bytes] = []
    labels: list[int] = []
    known = [s for k in range(NONE) for s in by[k]]
    for _ in range(per_class // 6 if known else 0):
        raw = _exchanged(known[int(rng.integers(len(known)))], rng).encode("utf-8", "surrogatepass")
        at = int(rng.integers(max(1, len(raw) - 60))) if len(raw) > 160 else 0
        seqs.append(raw[at : at + 192])
        labels.append(NONE)
    for label, found in by.items():
        if not found:
            continue
        for j in range(per_class):
            s = found[int(rng.integers(len(found)))] if len(found) > per_class else found[j % len(found)]
            kind = rng.random()
            if kind < 0.07:
                s = s.upper()
            elif kind < 0.32 and label != NONE:
                s = _garbled(s, rng)
            elif kind < 0.37:
                s = "".join("�" if ord(c) > 127 and rng.random() < 0.6 else c for c in s)
            elif kind < 0.44:
                s = re.sub(r"[eolghu]", lambda m: "c019bv"["eolghu".index(m[0])] if rng.random() < 0.12 else m[0], s)
            raw = s.encode("utf-8", "surrogatepass")
            at = int(rng.integers(max(1, len(raw) - 60))) if len(raw) > 160 else 0
            seqs.append(raw[at : at + 192])
            labels.append(label)
    return seqs, labels


def _exchanged(s: str, rng: np.random.Generator) -> str:
    """Text of no language: vowels exchanged for vowels, other letters for others of their script."""
    table: dict[int, str] = {}
    for kind in ("aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ"):
        to = [kind[i] for i in rng.permutation(len(kind))]
        table |= dict(zip(map(ord, kind), to, strict=True)) | dict(zip(map(ord, kind.upper()), map(str.upper, to), strict=True))
    return s.translate(table)


def _garbled(s: str, rng: np.random.Generator) -> str:
    forms = garbled_forms(s)
    return forms[int(rng.integers(len(forms)))][0] if forms else s


_FITTED: dict[str, dict[str, np.ndarray]] = {}


def fit(spark: SparkSession, pages: DataFrame, common_words: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Weights for a sample; they are kept in the shared folder under its digest, and fitted where they aren't there."""
    common: dict[str, set[str]] = {}
    for r in common_words.where("lang is not null and word is not null").select("lang", "word").distinct().collect():
        common.setdefault(r["lang"], set()).add(r["word"].lower())
    seqs, labels = training_set(training_rows(spark, pages, rows), common)
    key = hashlib.blake2b(digest_size=12)
    for s, y in zip(seqs, labels, strict=True):
        key.update(len(s).to_bytes(4, "big") + s + bytes([y]))
    name = key.hexdigest()
    if name not in _FITTED:
        path = f"{shared_dir(spark)}/pagewright-language-{name}"
        try:
            held = {r["k"]: np.frombuffer(r["raw"], np.float32).reshape(r["shape"]).copy() for r in spark.read.schema(_WEIGHTS).parquet(path).collect()}
        except AnalysisException:
            held = {}
        if held.keys() != new_weights().keys():
            held = train(seqs, labels)
            spark.createDataFrame([(k, list(v.shape), v.astype(np.float32).tobytes()) for k, v in held.items()], _WEIGHTS).coalesce(1).write.mode("overwrite").parquet(path)
        _FITTED[name] = held
    return _FITTED[name]


_WEIGHTS = "k string, shape array<int>, raw binary"


def classify(w: dict[str, np.ndarray], texts: list[str | None], segments: bool = True) -> list[tuple[str | None, float, list[dict]]]:
    """(language, confidence, paragraphs) of each text.  A paragraph has its language, confidence, the languages of
    its full sentences with their number, and its segments: adjacent sentences of one language, as offsets in the
    paragraph's text (consistent form, lines joined by a blank), with a confidence (none where not asked for)."""
    seqs: list[bytes] = []
    starts: list[int] = []  # of paragraphs, then of sentences, in bytes over all sequences
    ends: list[int] = []
    owner: list[int] = []  # paragraph of each sentence
    begin: list[int] = []
    full: list[bool] = []
    spans: list[tuple[int, int]] = []  # of sentences, in characters of the paragraph
    plan: list[int] = []  # paragraphs of each text
    at = 0
    for t in texts:
        n = 0
        for block in blocks(canonical(t)) if t else []:
            raw, here, char = block.encode("utf-8", "surrogatepass"), 0, 0
            plain = len(raw) == len(block)
            for s, whole in sentences(block):
                size = len(s) if plain else len(s.encode("utf-8", "surrogatepass"))
                owner.append(len(starts))
                begin.append(at + here)
                full.append(whole)
                spans.append((char, char + len(s)))
                here += size
                char += len(s)
            seqs += [raw[i : i + WINDOW] for i in range(0, len(raw), WINDOW)]
            starts.append(at)
            at += len(raw)
            ends.append(at)
            n += 1
        plan.append(n)
    if not starts:
        return [(None, 0.0, []) for _ in texts]
    # sentences tile their paragraphs, and paragraphs all bytes
    bysentence = np.add.reduceat(np.concatenate(probabilities(w, seqs)), begin, axis=0).astype(np.float64)
    pooled = np.add.reduceat(bysentence, np.searchsorted(begin, starts), axis=0)
    means = pooled / (np.array(ends) - np.array(starts))[:, None]
    best = means.argmax(1)
    found: list[dict[str, int]] = [{} for _ in starts]
    parts: list[list[dict]] = [[] for _ in starts]
    each = bysentence / (np.append(begin[1:], at) - begin)[:, None]
    each = (each + PARAGRAPH_WEIGHT * means[owner]) / (1 + PARAGRAPH_WEIGHT)  # neighbours speak the same, mostly
    which, top = each.argmax(1), each.max(1)
    sure = (which != NONE) & (top >= LEAST_SHARE)
    for k in np.flatnonzero(sure & np.array(full)).tolist():
        lang, of = LANGS[which[k]], found[owner[k]]
        of[lang] = of.get(lang, 0) + 1
    for k, p in enumerate(owner if segments else ()):
        lang = LANGS[which[k]] if sure[k] else None
        a, b = spans[k]
        last = parts[p][-1] if parts[p] else None
        if last and last["lang"] == lang:
            size = last["end"] - last["start"]
            last["confidence"] = float(last["confidence"] * size + top[k] * (b - a)) / (size + b - a)
            last["end"] = b
        else:
            parts[p].append({"start": a, "end": b, "lang": lang, "confidence": float(top[k])})
    out: list[tuple[str | None, float, list[dict]]] = []
    at = 0
    for n in plan:
        if not n:
            out.append((None, 0.0, []))
            continue
        whole = pooled[at : at + n].sum(0)
        paragraphs = [{"paragraph": i, "lang": LANGS[best[k]] if best[k] != NONE else None, "confidence": float(means[k, best[k]]), "sentences": found[k], "segments": parts[k]} for i, k in enumerate(range(at, at + n))]
        top = int(whole.argmax())
        out.append((LANGS[top] if top != NONE else OTHER, float(whole[top] / whole.sum()), paragraphs))
        at += n
    return out


def labelled(df: DataFrame, w: dict[str, np.ndarray], id_col: str = "result_id", segments: bool = True) -> DataFrame:
    """(id, named, lang, confidence, paragraphs) of each row, deliveries counted once by the caller."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(w)

    def run(batch):
        ids, names, texts = (batch.column(i).to_pylist() for i in range(3))
        got = [g for part in portions(texts, PORTION) for g in classify(shared.value, texts[part], segments)]
        return {
            id_col: ids,
            "named": names,
            "lang": [g[0] for g in got],
            "confidence": [g[1] for g in got],
            "paragraphs": [[p | {"sentences": list(p["sentences"].items())} for p in g[2]] for g in got],
        }

    src = df.select(F.col(id_col).cast("bigint").alias(id_col), named(F.col("lang_label")).alias("named"), "text")
    return arrow_map(src, run, f"{id_col} bigint, named array<string>, lang string, confidence double, paragraphs array<struct<paragraph:int,lang:string,confidence:double,sentences:map<string,int>,segments:array<struct<start:int,end:int,lang:string,confidence:double>>>>")


def wrongly_labelled(df: DataFrame, w: dict[str, np.ndarray], least_sentences: int = 2) -> DataFrame:
    """(result_id, lang): a paragraph holds least_sentences full sentences in a language the label doesn't name."""
    rows = labelled(df, w, segments=False).select("result_id", "named", F.explode("paragraphs").alias("p")).select("result_id", "named", F.explode("p.sentences").alias("lang", "n"))
    return rows.where((F.col("n") >= least_sentences) & ~F.array_contains("named", F.col("lang"))).select("result_id", "lang").distinct()

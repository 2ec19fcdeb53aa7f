"""Problem 6: token ids of every document by a public byte-level tokenizer.

A text is parted by the tokenizer's pattern; each part is encoded by byte pair encoding.  A segment tree
over the byte positions of the part holds the leftmost minimum rank of a pair of live neighbours; each
merge reads the root and updates at most three leaves, so a part of n bytes takes O(n log n) however many
merges it needs.  Parts seen before within a task are remembered.

The ranks (a fixed vocabulary of about 50,000 entries) are read by the driver from a path that is a
parameter, and broadcast.  Encoding is one map over the rows: no shuffle.

Defined results: null and empty texts give an empty list.  Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, ship

# Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 200_000
_NEVER = 1 << 30


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a public vocabulary on this machine."""
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return f"/opt/tokenizers/{name}"


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode_part(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte pair encoding of one part."""
    whole = ranks.get(part)
    if whole is not None:
        return [whole]
    n = len(part)
    size = 1
    while size < n - 1:
        size *= 2
    # live tokens as a linked list over positions: end[i] is where the token that starts at i ends
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    low = [_NEVER] * (2 * size)
    for i in range(n - 1):
        low[size + i] = ranks.get(part[i : i + 2], _NEVER)
    for k in range(size - 1, 0, -1):
        a, b = low[2 * k], low[2 * k + 1]
        low[k] = a if a <= b else b

    def put(i: int, rank: int) -> None:
        k = size + i
        if low[k] == rank:
            return
        low[k] = rank
        k //= 2
        while k:
            a, b = low[2 * k], low[2 * k + 1]
            new = a if a <= b else b
            if low[k] == new:
                break
            low[k] = new
            k //= 2

    def pair(i: int) -> int:
        j = end[i]
        return ranks.get(part[i : end[j]], _NEVER) if j < n else _NEVER

    while low[1] < _NEVER:
        k = 1
        while k < size:
            k = 2 * k if low[2 * k] == low[k] else 2 * k + 1
        i = k - size
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            before[end[i]] = i
        if j < n - 1:
            put(j, _NEVER)
        if i < n - 1:
            put(i, pair(i))
        p = before[i]
        if p >= 0:
            put(p, pair(p))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[part[i : end[i]]])
        i = end[i]
    return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        import regex

        self.ranks, self.memo, self.split = ranks, {}, regex.compile(PATTERN).findall

    def __call__(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        memo = self.memo
        for part in self.split(text):
            ids = memo.get(part)
            if ids is None:
                ids = encode_part(part.encode("utf-8"), self.ranks)
                if len(memo) < MEMO and len(part) <= 64:
                    memo[part] = ids
            out += ids
        return out


def _encoder(df: DataFrame, path: str | None):
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(path or vocabulary_path()))
    held: list[Encoder] = []

    def encoder() -> Encoder:
        if not held:
            held.append(Encoder(shared.value))
        return held[0]

    return encoder


def encoded(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of each row."""
    encoder = _encoder(df, path)

    def run(batch):
        e = encoder()
        return {id_col: batch.column(0).to_pylist(), "ids": [e(t) for t in batch.column(1).to_pylist()]}

    return arrow_map(df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("t")), run, f"{id_col} bigint, ids array<int>")


def sized(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """(doc_id, kept columns, ids, n_tokens) of each row."""
    encoder = _encoder(df, path)
    names = [id_col, *keep]

    def run(batch):
        e = encoder()
        ids = [e(t) for t in batch.column(len(names)).to_pylist()]
        return {k: batch.column(i).to_pylist() for i, k in enumerate(names)} | {"ids": ids, "n_tokens": [len(x) for x in ids]}

    types = dict(df.dtypes)
    schema = f"{id_col} bigint, " + "".join(f"{k} {types[k]}, " for k in keep) + "ids array<int>, n_tokens bigint"
    return arrow_map(df.select(F.col(id_col).cast("bigint").alias(id_col), *keep, F.col(text_col).cast("string").alias("t")), run, schema)

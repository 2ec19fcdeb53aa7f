"""Problem 7: mixing sources to target weights.

The tokens of each source, its documents in a pseudorandom order, are packed into blocks of BLOCK_TOKENS.
A mix is made of output shards of SHARD_SLOTS slots.  Each shard draws how many of its slots each source
gets from a multinomial over the target shares; a source's slots are numbered over all shards and mapped by
a keyed permutation to block indexes, so that in every pass over a source each block comes once; then
slots and blocks, which hold the token ids, are joined by (source, index).

The size of a mix is the largest for which every source stays within max_repeats passes with a margin of
five standard deviations of the draw, or a given number of tokens; slots beyond a source's passes stay
empty, so the cap always holds, and the report shows the actual shares.

Scale: token offsets are prefix sums in two levels (sums of hash buckets, then within a bucket), so a
source with a third of all rows is spread like the others.  Only one row per source and mix reaches the
driver.  Joins are on (source, block).

Defined results: documents with null source, null or empty text bring no tokens.  Targets with a null or
non-positive weight are no targets; a source without tokens is left out of the draw, the others scaled up, and the
report says so.  A null max_repeats counts as 1.  A mix without any source with tokens is empty.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, cut

BLOCK_TOKENS, SHARD_SLOTS = 64, 256
ROWS_A_BUCKET = 20_000


def prefix_sums(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], value: str, name: str) -> DataFrame:
    """df with the sum of value over the rows before it within keys.  Buckets are summed first, so that no
    task holds more than a bucket's rows, or one row per bucket of a key."""
    rows = df.withColumn("_bucket", bucket)
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_sum"))
    over = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inner = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.join(starts, [*keys, "_bucket"])
    return out.withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_bucket", "_start")


def packed(documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(source, block, doc_id, first, last, ids): the pieces of documents, as token positions [first, last) with
    their ids, in the blocks of each wanted source.  Only sizes go through the prefix sums; ids are joined by row."""
    wanted = targets.where("source is not null and target_weight > 0").select("source").distinct()
    sized = tokens.sized(documents.where("source is not null and text is not null").join(wanted, "source", "left_semi").select("doc_id", "source", "text"), path)
    sized = cut(sized.where("n_tokens > 0").withColumn("row", F.monotonically_increasing_id()), "sizes")
    buckets = max(1, -(-sized.count() // ROWS_A_BUCKET))
    mark = F.xxhash64("doc_id", "row")
    placed = prefix_sums(sized.drop("ids"), ["source"], F.pmod(F.hash("row"), F.lit(buckets)), [mark, F.col("row")], "n_tokens", "start")
    blocks = F.sequence((F.col("start") / BLOCK_TOKENS).cast("bigint"), ((F.col("start") + F.col("n_tokens") - 1) / BLOCK_TOKENS).cast("bigint"))
    whole = placed.select("row", "start").join(sized.select("row", "source", "doc_id", "n_tokens", "ids"), "row")
    pieces = whole.select("source", "doc_id", "start", "n_tokens", "ids", F.explode(blocks).alias("block"))
    first = F.greatest(F.col("block") * BLOCK_TOKENS - F.col("start"), F.lit(0))
    last = F.least((F.col("block") + 1) * BLOCK_TOKENS - F.col("start"), F.col("n_tokens"))
    return pieces.select("source", "block", "doc_id", first.alias("first"), last.alias("last"), F.slice("ids", (first + 1).cast("int"), (last - first).cast("int")).alias("ids"))


def plan(pieces: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[dict]:
    """Per mix and source: target share, blocks, passes, slots of the mix.  Bounded by the targets' rows."""
    sizes = {r["source"]: (r["blocks"], r["n"]) for r in pieces.groupBy("source").agg((F.max("block") + 1).alias("blocks"), F.sum(F.col("last") - F.col("first")).alias("n")).collect()}
    mixes: dict[str, list[dict]] = {}
    wanted = targets.where("mix_name is not null and source is not null and target_weight > 0").groupBy("mix_name", "source").agg(F.sum("target_weight").alias("w"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("r"))
    for r in wanted.orderBy("mix_name", "source").collect():
        if r["source"] in sizes and r["r"] > 0:
            blocks, n = sizes[r["source"]]
            mixes.setdefault(r["mix_name"], []).append({"mix_name": r["mix_name"], "source": r["source"], "weight": r["w"], "passes": r["r"], "blocks": blocks, "tokens": n})
    out = []
    for rows in mixes.values():
        whole = sum(x["weight"] for x in rows)
        slots = math.inf
        for x in rows:
            x["share"] = x["weight"] / whole
            cap = x["blocks"] * x["passes"]
            # largest t with share t + 5 sqrt(share t) <= cap
            root = (-5 + math.sqrt(25 + 4 * cap)) / 2
            slots = min(slots, root * root / x["share"] if len(rows) > 1 else cap)
        if total_tokens is not None:
            slots = min(total_tokens / BLOCK_TOKENS, sum(x["blocks"] * x["passes"] for x in rows))
        for x in rows:
            x["slots"] = max(1, int(slots))
        out += rows
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of [0, size): four Feistel rounds on the next even number of bits, walked until
    the image lies within the domain."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    x = index.astype(np.uint64)
    todo = np.ones(len(x), dtype=bool)
    while todo.any():
        v = x[todo]
        left, right = v >> np.uint64(half), v & mask
        for r in range(4):
            h = (right + np.uint64((key + r * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            left, right = right, left ^ (h & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo[todo] = x[todo] >= size
    return x.astype(np.int64)


def slots(rows: list[dict], documents: DataFrame, seed: int = 11) -> DataFrame:
    """(mix_name, shard, source, slot, turn, block): every slot of every mix with its block, -1 where the source has
    used up its passes."""
    spark = documents.sparkSession
    by: dict[str, list[dict]] = {}
    for x in rows:
        by.setdefault(x["mix_name"], []).append(x)
    names = sorted(by)
    shards = spark.createDataFrame([(i, n, -(-by[n][0]["slots"] // SHARD_SLOTS)) for i, n in enumerate(names)] or [(0, "", 0)], "m int, mix_name string, shards bigint")
    each = shards.where("shards > 0").select("m", "mix_name", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"))

    def draw(batch):
        out: dict[str, list] = {"mix_name": [], "shard": [], "source": [], "n": []}
        for m, name, shard in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            parts = by[name]
            size = min(SHARD_SLOTS, parts[0]["slots"] - shard * SHARD_SLOTS)
            got = np.random.default_rng([seed, m, shard]).multinomial(size, [x["share"] for x in parts])
            for x, n in zip(parts, got.tolist(), strict=True):
                out["mix_name"].append(name)
                out["shard"].append(shard)
                out["source"].append(x["source"])
                out["n"].append(n)
        return out

    counts = cut(arrow_map(each, draw, "mix_name string, shard bigint, source string, n bigint"), "counts")
    numbered = prefix_sums(counts, ["mix_name", "source"], (F.col("shard") / 4096).cast("bigint"), [F.col("shard")], "n", "start")
    flat = numbered.where("n > 0").select("mix_name", "shard", "source", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("slot"))

    def choose(batch):
        mixes, sources, at = (np.array(batch.column(i).to_pylist(), dtype=object if i != 2 else np.int64) for i in range(3))
        shard = batch.column(3).to_pylist()
        block = np.full(len(at), -1, dtype=np.int64)
        turn = np.zeros(len(at), dtype=np.int64)
        for k, x in enumerate(rows):
            mine = (mixes == x["mix_name"]) & (sources == x["source"])
            if mine.any():
                turn[mine] = at[mine] // x["blocks"]
                for p in np.unique(turn[mine]):
                    if p < x["passes"]:
                        now = mine & (turn == p)
                        block[now] = permuted(at[now] % x["blocks"], x["blocks"], seed * 1_000_003 + k * 7919 + int(p))
        return {"mix_name": mixes.tolist(), "shard": shard, "source": sources.tolist(), "slot": at.tolist(), "turn": turn.tolist(), "block": block.tolist()}

    out = arrow_map(flat.select("mix_name", "source", "slot", "shard"), choose, "mix_name string, shard bigint, source string, slot bigint, turn bigint, block bigint")
    return out


def planned(documents: DataFrame, targets: DataFrame, path: str | None = None, total_tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix, and one row (mix_name, source, share, missed_slots) for each source that takes part."""
    pieces = cut(packed(documents, targets, path), "pieces")
    rows = plan(pieces, targets, total_tokens)
    drawn = cut(slots(rows, documents), "slots")
    mix = drawn.where("block >= 0").join(pieces, ["source", "block"])
    part = documents.sparkSession.createDataFrame([(x["mix_name"], x["source"], float(x["share"])) for x in rows], "mix_name string, source string, share double")
    missed = drawn.where("block < 0").groupBy("mix_name", "source").agg(F.count(F.lit(1)).alias("missed_slots"))
    return mix.select("mix_name", "shard", "source", "slot", "turn", "block", "doc_id", "first", "last", "ids"), part.join(missed, ["mix_name", "source"], "left").fillna(0, ["missed_slots"])


def mixed(documents: DataFrame, targets: DataFrame, path: str | None = None, total_tokens: int | None = None) -> DataFrame:
    """(mix_name, shard, source, slot, turn, block, doc_id, first, last, ids): the tokens [first, last) of doc_id
    fill part of a slot of a shard."""
    return planned(documents, targets, path, total_tokens)[0]


def wanted_shares(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, reachable_share) of every target: its share of the weights of its mix, and of
    those of the sources that stand in `sources`, null for others."""
    t = targets.where("mix_name is not null and source is not null and target_weight > 0").groupBy("mix_name", "source").agg(F.sum("target_weight").alias("weight"))
    t = t.join(sources.select("source", F.lit(True).alias("there")), "source", "left")
    whole, there = W.partitionBy("mix_name"), F.when(F.col("there"), F.col("weight"))
    return t.select("mix_name", "source", (F.col("weight") / F.sum("weight").over(whole)).alias("target_share"), (there / F.sum(there).over(whole)).alias("reachable_share"))


def shares(mix: DataFrame, targets: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """(mix_name, source, target_share, reachable_share, actual_share, tokens, most_uses, missed_tokens, note): what
    each mix is made of, a row for every target.  Without `part`, of planned(), the sources of the mix are those that
    take part.  missed_tokens: what a mix of a given size wanted beyond the source's passes."""
    uses = mix.groupBy("mix_name", "source", "doc_id", "first").agg(F.count(F.lit(1)).alias("uses"), F.sum(F.col("last") - F.col("first")).alias("n"))
    got = uses.groupBy("mix_name", "source").agg(F.sum("n").alias("tokens"), F.max("uses").alias("most_uses"))
    missed = (got if part is None else part).select("mix_name", "source", (F.lit(0) if part is None else F.col("missed_slots") * BLOCK_TOKENS).cast("bigint").alias("missed_tokens"))
    t = wanted_shares(targets, missed.select("source").distinct())
    both = t.join(got, ["mix_name", "source"], "left").join(missed, ["mix_name", "source"], "left").fillna(0, ["tokens", "most_uses", "missed_tokens"])
    whole = W.partitionBy("mix_name")
    actual = F.coalesce(F.try_divide("tokens", F.sum("tokens").over(whole)), F.lit(0.0))
    note = F.when(F.col("reachable_share").isNull(), "no tokens").when(F.col("tokens") == 0, "no slot drawn").when(F.col("missed_tokens") > 0, "used up")
    return both.select("mix_name", "source", "target_share", "reachable_share", actual.alias("actual_share"), "tokens", "most_uses", "missed_tokens", note.alias("note"))

import numpy as np
import pytest

from pagewright.llm import mixing as X
from pagewright.llm import tokens as T


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_permutation(n):
    got = X.permuted(np.arange(n), n, key=n * 31)
    assert sorted(got.tolist()) == list(range(n))
    if n > 60:
        assert got.tolist() != X.permuted(np.arange(n), n, key=n * 31 + 1).tolist()


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(i, f"text number {i} of the big source " * (1 + i % 7), "big") for i in range(1500)] + [(5000 + i, f"small one {i} " * 30, "small") for i in range(60)]
    docs += [(9000, None, "big"), (9001, "", "small"), (9002, "no source", None), (9003, "unused", "other")]
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, source string, block int, slot int")
    targets = [("even", "big", 1.0, 2), ("even", "small", 1.0, 3), ("tilt", "big", 30.0, None), ("tilt", "small", 10.0, 2), ("tilt", "absent", 5.0, 2), ("tilt", "other", 0.0, 2), ("none", "absent", 1.0, 1), ("bad", None, 1.0, 1), ("bad", "big", None, 1)]
    return d, spark.createDataFrame(targets, "mix_name string, source string, target_weight double, max_repeats int")


def test_pieces_cover_every_token_once(spark, tables):
    docs, targets = tables
    rows = X.packed(docs, targets).collect()
    e = T.Encoder(T.read_ranks(T.vocabulary_path()))
    sizes = {r["doc_id"]: len(e(r["text"])) for r in docs.collect() if r["source"] in ("big", "small") and r["text"]}
    covered: dict[int, list] = {}
    blocks: dict[tuple, int] = {}
    for r in rows:
        covered.setdefault(r["doc_id"], []).append((r["first"], r["last"]))
        blocks[r["source"], r["block"]] = blocks.get((r["source"], r["block"]), 0) + r["last"] - r["first"]
    assert {k: sum(b - a for a, b in v) for k, v in covered.items()} == sizes
    for v in covered.values():
        v.sort()
        assert v[0][0] == 0 and all(a[1] == b[0] for a, b in zip(v, v[1:], strict=False))
    for source in ("big", "small"):
        own = {b: n for (s, b), n in blocks.items() if s == source}
        assert sorted(own) == list(range(len(own))) and all(n == X.BLOCK_TOKENS for b, n in own.items() if b != max(own))


def test_shares_and_caps(tables):
    docs, targets = tables
    mix = X.mixed(docs, targets).cache()
    got = {(r["mix_name"], r["source"]): r for r in X.shares(mix, targets).collect()}
    assert {k[0] for k in got} == {"even", "tilt", "none"}
    absent = got.pop(("none", "absent")), got.pop(("tilt", "absent"))
    assert all(r["actual_share"] == 0 and r["tokens"] == 0 and r["reachable_share"] is None and r["note"] == "no tokens" for r in absent) and absent[1]["target_share"] == pytest.approx(5 / 45)
    caps = {("even", "big"): 2, ("even", "small"): 3, ("tilt", "big"): 1, ("tilt", "small"): 2}
    for k, r in got.items():
        assert r["most_uses"] <= caps[k]
        assert abs(r["actual_share"] - r["reachable_share"]) < 0.12 and r["note"] is None
    slots = mix.select("mix_name", "shard", "source", "slot").distinct().count()
    assert slots == mix.select("mix_name", "source", "turn", "block").distinct().count()
    assert sorted(map(tuple, mix.collect())) == sorted(map(tuple, X.mixed(docs, targets).collect()))  # the same every time


def test_sources_that_drew_no_slot_are_reported(spark, tables):
    docs, _ = tables
    targets = spark.createDataFrame([("tiny", "big", 1e6, 1), ("tiny", "small", 1.0, 1), ("tiny", "absent", 1.0, 1)], "mix_name string, source string, target_weight double, max_repeats int")
    mix, rows = X.planned(docs, targets, total_tokens=10 * X.BLOCK_TOKENS)
    got = {r["source"]: r for r in X.shares(mix, targets, rows).collect()}
    assert set(got) == {"big", "small", "absent"} and got["absent"]["note"] == "no tokens"
    assert got["small"]["reachable_share"] == pytest.approx(1 / (1e6 + 1)) and got["small"]["actual_share"] == 0 and got["small"]["tokens"] == 0 == got["small"]["most_uses"] and got["small"]["note"] == "no slot drawn"
    assert got["big"]["reachable_share"] == pytest.approx(1e6 / (1e6 + 1)) and got["big"]["actual_share"] == 1


def test_slots_beyond_the_passes_are_reported(spark, tables):
    docs, _ = tables
    targets = spark.createDataFrame([("much", "big", 1.0, 1), ("much", "small", 1.0, 1)], "mix_name string, source string, target_weight double, max_repeats int")
    mix, part = X.planned(docs, targets, total_tokens=10**9)
    got = {r["source"]: r for r in X.shares(mix, targets, part).collect()}
    drawn = sum(r["tokens"] + r["missed_tokens"] for r in got.values())
    assert got["small"]["note"] == "used up" and got["small"]["missed_tokens"] > 0 and got["small"]["most_uses"] == 1
    assert abs(got["small"]["tokens"] + got["small"]["missed_tokens"] - drawn / 2) < 0.1 * drawn


def test_blocks_hold_the_ids(tables):
    docs, targets = tables
    e = T.Encoder(T.read_ranks(T.vocabulary_path()))
    whole = {r["doc_id"]: e(r["text"]) for r in docs.collect() if r["text"]}
    rows = X.mixed(docs, targets).collect()
    assert rows and all(r["ids"] == whole[r["doc_id"]][r["first"] : r["last"]] for r in rows)


def test_empty(tables):
    docs, targets = tables
    assert X.mixed(docs.limit(0), targets).count() == 0
    assert X.mixed(docs, targets.limit(0)).count() == 0

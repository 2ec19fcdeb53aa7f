import math
import random

import pytest
from pyspark.sql import functions as F

from pagewright.functions import geometry, rounding

OPS = "array<struct<fn:int,matrix:array<double>,scale_x:double,scale_y:double,positions:array<double>,placements:array<array<double>>>>"


def op(name, matrix=None, sx=None, sy=None, positions=None, placements=None):
    return (geometry.OPCODES[name], matrix and [float(x) for x in matrix], sx, sy, positions, placements)


def coverage(spark, ops, w=100.0, h=100.0):
    df = spark.createDataFrame([(w, h, ops)], f"w double, h double, ops {OPS}")
    return df.select(geometry.image_coverage(F.col("w"), F.col("h"), F.col("ops"))).first()[0]


FULL = [100, 0, 0, 100, 0, 0]


@pytest.mark.parametrize(
    ("ops", "expected"),
    [
        # a logo in a corner, a scan turned by ninety degrees, a banner half beyond the edge
        ([op("transform", [30, 0, 0, 25, 60, 70]), op("image")], 0.075),
        ([op("transform", [0, 80, -40, 0, 90, 10]), op("image")], 0.32),
        ([op("transform", [60, 0, 0, 10, 80, 40]), op("image")], 0.02),
        # two photos that overlap, one of them in a saved state
        ([op("save"), op("transform", [40, 0, 0, 40, 10, 10]), op("image"), op("restore"), op("transform", [40, 0, 0, 40, 30, 30]), op("image")], 0.28),
        # tiles of a contact sheet, repeated and grouped under a scaled page
        ([op("transform", [2, 0, 0, 2, 0, 0]), op("image_repeat", sx=10.0, sy=5.0, positions=[0.0, 0.0, 20.0, 0.0, 40.0, 0.0])], 0.06),
        ([op("transform", [1, 0, 0, 1, 5, 5]), op("image_group", placements=[[10.0, 0.0, 0.0, 10.0, 0.0, 0.0], [10.0, 0.0, 0.0, 10.0, 5.0, 0.0], [20.0, 0.0, 0.0, 10.0, 70.0, 80.0]])], 0.035),
        ([op("image_repeat", sx=50.0, sy=100.0, positions=[0.0, 0.0, 50.0])], 0.5),
        ([op("image_repeat", sx=50.0, sy=None, positions=[0.0, 0.0])], 0.0),
        ([op("transform", [50, 0, 0, 50, 0, 0]), op("restore"), op("image")], 0.25),
        ([op("form_begin", [50, 0, 0, 50, 0, 0]), op("image"), op("form_end"), op("inline_image")], 0.25),
        ([op("transform", FULL), op("form_begin", [1, 2]), op("form_end"), op("image")], 1.0),
        ([op("transform", [1, 0, 0]), op("transform", [math.nan, 0, 0, 1, 0, 0]), op("image")], 0.0001),
        ([op("transform", [10, 0, 0, 10, 500, 500]), op("image")], 0.0),
        ([(999, None, None, None, None, None)], 0.0),
        ([], 0.0),
        (None, 0.0),
    ],
)
def test_coverage(spark, ops, expected):
    assert coverage(spark, ops) == pytest.approx(expected, abs=1e-12)


def test_page_without_size(spark):
    assert coverage(spark, [op("image")], w=None) is None


def by_cells(rects):
    xs = sorted({v for r in rects for v in (r[0], r[2])})
    ys = sorted({v for r in rects for v in (r[1], r[3])})
    return sum((b - a) * (d - c) for a, b in zip(xs, xs[1:]) for c, d in zip(ys, ys[1:]) if any(r[0] <= a and b <= r[2] and r[1] <= c and d <= r[3] for r in rects))


def test_union_against_cells(spark):
    rng = random.Random(4)
    cases = [[], [[0, 0, 100, 100]] * 2, [[0, 0, 50, 100], [50, 0, 100, 100]]]
    cases += [[[x, y, x + rng.randint(1, 9), y + rng.randint(1, 9)] for x, y in ((rng.randint(0, 20), rng.randint(0, 20)) for _ in range(rng.randint(1, 12)))] for _ in range(120)]
    rows = [(i, [[float(v) for v in r] for r in c]) for i, c in enumerate(cases)]
    got = spark.createDataFrame(rows, "i int, r array<array<double>>").select("i", geometry.union_area(F.col("r")).alias("a")).collect()
    assert {r["i"]: r["a"] for r in got} == {i: by_cells(c) for i, c in enumerate(cases)}


def exact(x):  # half up on the exact binary value
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(x).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def test_rounding(spark):
    rng = random.Random(1)
    xs = [0.00015, 0.03125, 0.00005, 0.0, 1.0, 0.96875] + [k / 32 for k in range(33)] + [k / 100000 for k in range(5, 4000, 10)] + [rng.random() for _ in range(500)]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(rounding.fixed4(F.col("x"))).collect()]
    assert got == [exact(x) for x in xs]

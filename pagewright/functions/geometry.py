"""Share of a page that images cover, from its drawing operators.

The operators of a page are folded in order: a transformation matrix and its stack are kept, and each image
leaves the matrix it was drawn under.  Then each matrix becomes the bounding box of the unit square, clipped
to the page, and the area of the union of the boxes is summed over vertical strips.  All of it is one
higher-order expression on the page's row: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The drawing operators that matter.
OPCODES = {"save": 10, "restore": 11, "transform": 12, "form_begin": 74, "form_end": 75, "image": 85, "inline_image": 86, "image_group": 87, "image_repeat": 88}

_MATRIX = "array<double>"
_MATRICES = "array<array<double>>"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at(m: Column, i: int) -> Column:
    return F.get(m, F.lit(i))


def multiply(left: Column, right: Column) -> Column:
    """left after right, both [a, b, c, d, e, f]."""
    a, b, c, d, e, f = (_at(left, i) for i in range(6))
    r = [_at(right, i) for i in range(6)]
    return F.array(a * r[0] + c * r[1], b * r[0] + d * r[1], a * r[2] + c * r[3], b * r[2] + d * r[3], a * r[4] + c * r[5] + e, b * r[4] + d * r[5] + f)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def is_matrix(m: Column) -> Column:
    """At least six entries, the first six finite; others are ignored by the operators."""
    return F.coalesce((F.size(m) >= 6) & F.forall(F.slice(m, 1, 6), _finite), F.lit(False))


def box(m: Column) -> Column:
    """[x0, y0, x1, y1] around the unit square under m; null where a corner is not a number."""
    a, b, c, d, e, f = (_at(m, i) for i in range(6))
    xs, ys = F.array(e, a + e, c + e, a + c + e), F.array(f, b + f, d + f, b + d + f)
    bad = lambda v: F.exists(v, lambda x: F.coalesce(F.isnan(x), F.lit(True)))
    return F.when(~bad(xs) & ~bad(ys), F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def clip(rect: Column, width: Column, height: Column) -> Column:
    """rect within [0, width] x [0, height]; null where nothing remains."""
    x0, y0 = F.greatest(F.lit(0.0), _at(rect, 0)), F.greatest(F.lit(0.0), _at(rect, 1))
    x1, y1 = F.least(width, _at(rect, 2)), F.least(height, _at(rect, 3))
    return F.when(rect.isNotNull() & (x1 > x0) & (y1 > y0), F.array(x0, y0, x1, y1))


def union_area(rects: Column) -> Column:
    """Area of the union of [x0, y0, x1, y1] rectangles; touching ones merge; 0 for none."""
    xs = F.array_sort(F.array_distinct(F.flatten(F.transform(rects, lambda r: F.array(_at(r, 0), _at(r, 2))))))

    def covered(left: Column, right: Column) -> Column:
        crossing = F.filter(rects, lambda r: (_at(r, 0) < right) & (_at(r, 2) > left))
        spans = F.array_sort(F.transform(crossing, lambda r: F.struct(_at(r, 1).alias("lo"), _at(r, 3).alias("hi"))))
        none = F.lit(None).cast("double")
        start = F.struct(F.lit(0.0).alias("done"), none.alias("lo"), none.alias("hi"))

        def step(acc: Column, s: Column) -> Column:
            apart = acc["lo"].isNull() | (s["lo"] > acc["hi"])
            return F.struct(
                F.when(apart, acc["done"] + F.coalesce(acc["hi"] - acc["lo"], F.lit(0.0))).otherwise(acc["done"]).alias("done"),
                F.when(apart, s["lo"]).otherwise(acc["lo"]).alias("lo"),
                F.when(apart, s["hi"]).otherwise(F.greatest(acc["hi"], s["hi"])).alias("hi"),
            )

        return F.aggregate(spans, start, step, lambda acc: acc["done"] + F.coalesce(acc["hi"] - acc["lo"], F.lit(0.0)))

    def strips(edges: Column) -> Column:
        pairs = F.arrays_zip(F.slice(edges, F.lit(1), F.greatest(F.size(edges) - 1, F.lit(0))).alias("l"), F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 1, F.lit(0))).alias("r"))
        areas = F.transform(pairs, lambda p: (p["r"] - p["l"]) * covered(p["l"], p["r"]))
        return F.aggregate(areas, F.lit(0.0), lambda acc, x: acc + x)

    return F.coalesce(_let(xs, strips), F.lit(0.0))


def fold(ops: Column) -> Column:
    """struct(m, stack, drawn) after all operators; drawn are the matrices images were drawn under."""
    code = OPCODES
    one = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 1, 0, 0)])
    none = F.array().cast(_MATRICES)
    start = F.struct(one.alias("m"), none.alias("stack"), none.alias("drawn"))

    def repeated(m: Column, op: Column) -> Column:
        pos, sx, sy = op["positions"], op["scale_x"], op["scale_y"]
        pairs = (F.size(pos) / 2).cast("int")
        ok = F.coalesce(_finite(sx) & _finite(sy) & (pairs >= 1), F.lit(False))
        place = lambda i: multiply(m, F.array(sx, F.lit(0.0), F.lit(0.0), sy, F.get(pos, 2 * i), F.get(pos, 2 * i + 1)))
        return F.when(ok, F.transform(F.sequence(F.lit(0), F.greatest(pairs - 1, F.lit(0))), place)).otherwise(none)

    def step(acc: Column, op: Column) -> Column:
        m, stack, fn, arg = acc["m"], acc["stack"], op["fn"], op["matrix"]
        pushes = fn.isin(code["save"], code["form_begin"])
        pops = fn.isin(code["restore"], code["form_end"])
        turns = fn.isin(code["transform"], code["form_begin"]) & is_matrix(arg)
        drawn = (
            F.when(fn.isin(code["image"], code["inline_image"]), F.array(m))
            .when(fn == code["image_repeat"], repeated(m, op))
            .when(fn == code["image_group"], F.transform(F.filter(F.coalesce(op["placements"], none), is_matrix), lambda p: multiply(m, p)))
            .otherwise(none)
        )
        return F.struct(
            F.when(turns, multiply(m, arg)).when(pops, F.coalesce(F.try_element_at(stack, F.lit(-1)), m)).otherwise(m).cast(_MATRIX).alias("m"),
            F.when(pushes, F.concat(stack, F.array(m))).when(pops & (F.size(stack) > 0), F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))).otherwise(stack).cast(_MATRICES).alias("stack"),
            F.concat(acc["drawn"], drawn).cast(_MATRICES).alias("drawn"),
        )

    ordered = F.coalesce(ops, F.array().cast("array<struct<fn:int,matrix:array<double>,scale_x:double,scale_y:double,positions:array<double>,placements:array<array<double>>>>"))
    return F.aggregate(ordered, start, step)


def image_coverage(width: Column, height: Column, ops: Column) -> Column:
    """Share of the page covered by images, at most 1; null where the page has no size."""
    rects = F.filter(F.transform(fold(ops)["drawn"], lambda m: clip(box(m), width, height)), lambda r: r.isNotNull())
    return F.when(width.isNotNull() & height.isNotNull(), _let(rects, lambda r: F.least(F.lit(1.0), union_area(r) / F.greatest(width * height, F.lit(1.0)))))

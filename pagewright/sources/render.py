"""Page images.  Renderers are plugged in; the one here draws what needs no font or image decoder: filled
rectangles on a white canvas, enough for layouts and tests.  Each Spark Python worker is its own process, so
a renderer needs no isolation beyond that; images stay inside the worker that made them."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame

from pagewright.functions import errors
from pagewright.shipping import ship
from pagewright.sources import pdf


class Renderer(Protocol):
    """PNG bytes of a page (1-based) of an open document."""

    def __call__(self, doc: pdf.Document, page: int, dpi: float) -> bytes: ...


def encode_png(rows: np.ndarray, width: int) -> bytes:
    """8-bit rows [height, 1 + channels x width], gray or RGB, each behind its filter byte 0, as PNG."""
    color = 2 if rows.shape[1] > 1 + width else 0
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), 8, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def draw(doc: pdf.Document, page: int, dpi: float) -> bytes:
    """White canvas of the page at dpi, with its filled rectangles."""
    pages = doc.page_list()
    if not 1 <= page <= len(pages):
        raise pdf.PdfError(f"Page {page} does not exist")
    node = pages[page - 1]
    width, height = pdf._size(node, doc)
    scale = dpi / 72
    fills: list[tuple] = []
    parts = doc.get(node.get("Contents"))
    streams = [doc.get(p) for p in parts] if isinstance(parts, list) else [parts]
    lex = pdf.Lexer(b"\n".join(pdf.decoded(s, doc) for s in streams if isinstance(s, pdf.Stream)))
    m, stack, color, path, args = np.eye(3), [], (0, 0, 0), [], []
    while (o := lex.next(False)) is not None:
        if not isinstance(o, pdf.Word):
            args.append(o)
            continue
        n = [float(x) for x in args if isinstance(x, (int, float))]
        if o == b"q":
            stack.append((m, color))
        elif o == b"Q" and stack:
            m, color = stack.pop()
        elif o == b"cm" and len(n) >= 6:
            m = np.array([[n[0], n[1], 0], [n[2], n[3], 0], [n[4], n[5], 1]]) @ m
        elif o == b"rg" and len(n) >= 3:
            color = tuple(round(255 * x) for x in n[:3])
        elif o == b"g" and n:
            color = (round(255 * n[0]),) * 3
        elif o == b"re" and len(n) >= 4:
            path.append(n[:4])
        elif o in (b"f", b"F", b"f*", b"B", b"B*"):
            for x, y, w, h in path:
                box = np.array([[x, y, 1], [x + w, y, 1], [x, y + h, 1], [x + w, y + h, 1]]) @ m
                left, right = sorted((box[:, 0].min() * scale, box[:, 0].max() * scale))
                top, bottom = sorted(((height - box[:, 1].max()) * scale, (height - box[:, 1].min()) * scale))
                fills.append((max(0, round(top)), max(0, round(bottom)), max(0, round(left)), max(0, round(right)), color))
            path = []
        elif o in (b"n", b"S", b"s"):
            path = []
        args = []
    h, w = max(1, math.ceil(height * scale)), max(1, math.ceil(width * scale))
    deep = 3 if any(len(set(f[4])) > 1 for f in fills) else 1
    rows = np.full((h, 1 + deep * w), 255, np.uint8)
    rows[:, 0] = 0
    canvas = np.lib.stride_tricks.as_strided(rows[:, 1:], (h, w, deep), (rows.strides[0], deep, 1))
    for top, bottom, left, right, tone in fills:
        canvas[top:bottom, left:right] = tone[:deep]
    return encode_png(rows, w)


class PageRenderer:
    """Renders pages of one document, opened once; after close() it renders nothing more.  Pages are drawn by the
    caller's own worker: the tasks of the cluster are the queue and the pool, so `workers` is only checked."""

    def __init__(self, content: bytes, workers: int = 1, renderer: Renderer = draw) -> None:
        if isinstance(workers, bool) or not isinstance(workers, int) or workers < 1:
            raise ValueError(errors.WORKERS_POSITIVE)
        self.content, self.renderer, self.doc, self.closed = content, renderer, None, False

    def render(self, page: int, dpi: float) -> bytes:
        if self.closed:
            raise RuntimeError(errors.RENDERER_CLOSED)
        try:
            if self.doc is None:
                self.doc = pdf.Document(self.content)
            return self.renderer(self.doc, page, dpi)
        except Exception as e:
            raise RuntimeError(errors.RENDER_FAILED % (page, e)) from e

    def close(self) -> None:
        self.doc, self.closed = None, True

    def __enter__(self) -> PageRenderer:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def render_pages(df: DataFrame, use: Callable[[str, int, bytes], tuple], schema: str, key: str = "item_id", renderer: Renderer = draw, on_error: str = "fail") -> DataFrame:
    """use(key, page, png) of each row (key, page, dpi, content) as columns of schema.  Images never leave
    the worker; a document is opened once per run of its rows.  on_error 'collect' keeps a page that could not be
    rendered, its key and page set, all else null, and the message in `error`."""
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    target = StructType.fromDDL(schema)
    kept = [f for f in df.schema if f.name in (key, "page") and f.name not in target.names]
    whole = StructType([*kept, *target.fields, *([StructType.fromDDL("error string")["error"]] if on_error == "collect" else [])])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(whole)
        last, images = None, None
        for batch in batches:
            out = []
            for k, page, dpi, content in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                named = {key: k, "page": page}
                try:
                    if images is None or last != k:
                        last, images = k, PageRenderer(content, 1, renderer)
                    png = images.render(page, dpi)
                except RuntimeError as e:
                    if on_error == "fail":
                        raise
                    out.append(named | {"error": str(e)})
                    continue
                out.append(named | dict(zip(target.names, use(k, page, png), strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in arrow], schema=arrow)

    return df.select(key, "page", "dpi", "content").mapInArrow(run, whole)

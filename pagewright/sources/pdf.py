"""PDF source and page cutter in the standard library: documents become rows of pages.

`pages(df)` explodes a binary column into one row per wanted page with its text items, size and drawing
operators; the wanted pages are passed into the reader, as no filter is pushed through Python.  Only what is
asked for is parsed (`want_text`, `want_ops`).  `cut_udf` copies a page range into a document of its own.

Read are classic and stream cross references (with a scan for objects where they are broken), object
streams, Flate data with predictors, inherited page attributes, simple encodings and ToUnicode maps.
Encrypted documents are reported as errors."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagewright.functions.geometry import OPCODES
from pagewright.shipping import ship

PAGE_SCHEMA = (
    "page int, page_count int, width double, height double, items array<struct<str:string,has_eol:boolean>>, "
    "ops array<struct<fn:int,matrix:array<double>,scale_x:double,scale_y:double,positions:array<double>,placements:array<array<double>>>>"
)
ROWS_AT_ONCE = 500  # pages handed on together
CUT_SCHEMA = "bytes binary, page_count int, error string"


class PdfError(ValueError):
    pass


class Name(str):
    __slots__ = ()


class Ref(tuple):
    __slots__ = ()


class Stream:
    __slots__ = ("dict", "raw")

    def __init__(self, d: dict, raw: bytes) -> None:
        self.dict, self.raw = d, raw


class Word(bytes):
    """A bare keyword."""

    __slots__ = ()


_SPACE = b"\0\t\n\f\r "
_TOKEN = re.compile(rb"[^\0\t\n\f\r ()<>\[\]{}/%]+")
_BLANK = re.compile(rb"(?:[\0\t\n\f\r ]+|%[^\r\n]*)*")
_REF = re.compile(rb"[\0\t\n\f\r ]+(\d+)[\0\t\n\f\r ]+R(?![^\0\t\n\f\r ()<>\[\]{}/%])")
_PLAIN_LITERAL = re.compile(rb"\(([^()\\\r]*)\)")
_HEX_NAME = re.compile(rb"#([0-9A-Fa-f]{2})")
_XREF_ROW = re.compile(rb"[\0\t\n\f\r ]*(\d+)[\0\t\n\f\r ]+(\d+)[\0\t\n\f\r ]+([nf])(?=[\0\t\n\f\r ]|$)")
_ESCAPES = {ord("n"): b"\n", ord("r"): b"\r", ord("t"): b"\t", ord("b"): b"\b", ord("f"): b"\f"}


class Lexer:
    """Objects of a byte string, one after another."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def skip(self) -> None:
        self.at = _BLANK.match(self.data, self.at).end()

    def next(self, refs: bool = True):
        """The next object, or None at the end."""
        self.skip()
        d, i = self.data, self.at
        if i >= len(d):
            return None
        c = d[i : i + 1]
        if c == b"/":
            m = _TOKEN.match(d, i + 1)
            self.at = m.end() if m else i + 1
            raw = m[0] if m else b""
            if b"#" in raw:
                raw = _HEX_NAME.sub(lambda x: bytes([int(x[1], 16)]), raw)
            return Name(raw.decode("latin-1"))
        if c == b"(":
            return self._literal()
        if d[i : i + 2] == b"<<":
            self.at = i + 2
            out: dict = {}
            while True:
                self.skip()
                if d[self.at : self.at + 2] == b">>" or self.at >= len(d):
                    self.at += 2
                    return out
                key = self.next(refs)
                out[key if isinstance(key, Name) else Name(str(key))] = self.next(refs)
        if c == b"<":
            end = d.find(b">", i)
            end = len(d) if end < 0 else end
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", d[i + 1 : end])
            self.at = end + 1
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if c == b"[":
            self.at = i + 1
            items: list = []
            while True:
                self.skip()
                if self.at >= len(d) or d[self.at : self.at + 1] == b"]":
                    self.at += 1
                    return items
                items.append(self.next(refs))
        m = _TOKEN.match(d, i)
        if not m:
            self.at = i + 1
            return Word(c)
        self.at = m.end()
        token = m[0]
        if token[0] in b"+-.0123456789":
            if refs and token.isdigit() and (r := _REF.match(d, self.at)):
                self.at = r.end()
                return Ref((int(token), int(r[1])))
            try:
                return int(token) if token.lstrip(b"+-").isdigit() else float(token)
            except ValueError:
                return 0
        return {b"true": True, b"false": False, b"null": None}.get(token, Word(token))

    def _literal(self) -> bytes:
        if m := _PLAIN_LITERAL.match(self.data, self.at):
            self.at = m.end()
            return m[1]
        d, i, depth, out = self.data, self.at + 1, 1, bytearray()
        while i < len(d):
            c = d[i]
            if c == 0x5C and i + 1 < len(d):
                e = d[i + 1]
                if e in _ESCAPES:
                    out += _ESCAPES[e]
                    i += 2
                elif 0x30 <= e <= 0x37:
                    m = re.compile(rb"[0-7]{1,3}").match(d, i + 1)
                    out.append(int(m[0], 8) & 255)
                    i = m.end()
                elif e in b"\r\n":
                    i += 3 if d[i + 1 : i + 3] == b"\r\n" else 2
                else:
                    out.append(e)
                    i += 2
                continue
            depth += (c == 0x28) - (c == 0x29)
            if not depth:
                break
            out.append(c)
            i += 1
        self.at = i + 1
        return bytes(out)


class Document:
    """Objects of a PDF by number."""

    def __init__(self, data: bytes) -> None:
        if b"%PDF-" not in data[:1024]:
            raise PdfError("Invalid PDF structure")
        self.data, self.places, self.cache, self.trailer = data, {}, {}, {}
        try:
            self._xref()
            if not isinstance(self.get(self.trailer.get("Root")), dict):
                raise PdfError("no catalog")
        except (PdfError, IndexError, KeyError, TypeError, ValueError, zlib.error):
            self._scan()
        if "Encrypt" in self.trailer:
            raise PdfError("Encrypted PDF documents are not supported")

    def _xref(self) -> None:
        m = list(re.finditer(rb"startxref\s+(\d+)", self.data[-2048:]))
        if not m:
            raise PdfError("no startxref")
        todo, seen = [int(m[-1][1])], set()
        while todo:
            at = todo.pop(0)
            if at in seen:
                continue
            seen.add(at)
            lex = Lexer(self.data, at)
            lex.skip()
            if self.data[lex.at : lex.at + 4] == b"xref":
                lex.at += 4
                while isinstance(start := lex.next(False), int):
                    for k in range(lex.next(False)):
                        if m := _XREF_ROW.match(self.data, lex.at):
                            lex.at, off, kind = m.end(), int(m[1]), m[3]
                        else:
                            off, _, kind = lex.next(False), lex.next(False), lex.next(False)
                        if kind == b"n":
                            self.places.setdefault(start + k, (1, off))
                d = lex.next()
            else:
                s = self._object_at(at)
                d = s.dict
                w = d["W"]
                raw, step = decoded(s, self), sum(w)
                index = d.get("Index", [0, d["Size"]])
                i = 0
                for first, n in zip(index[::2], index[1::2], strict=True):
                    for k in range(n):
                        f, p = [], i
                        for size in w:
                            f.append(int.from_bytes(raw[p : p + size], "big") if size else None)
                            p += size
                        i += step
                        kind = 1 if f[0] is None else f[0]
                        if kind in (1, 2):
                            self.places.setdefault(first + k, (1, f[1]) if kind == 1 else (2, f[1], f[2]))
            for k, v in d.items():
                self.trailer.setdefault(k, v)
            todo += [d[k] for k in ("XRefStm", "Prev") if isinstance(d.get(k), int)]

    def _scan(self) -> None:
        """Find the objects without a cross reference; later ones win."""
        self.places, self.cache, self.trailer = {}, {}, {}
        for m in re.finditer(rb"(?<![0-9])(\d+)[ \t\r\n]+\d+[ \t\r\n]+obj\b", self.data):
            self.places[int(m[1])] = (1, m.start())
        for m in re.finditer(rb"trailer\s*<<", self.data):
            d = Lexer(self.data, m.start() + 7).next()
            self.trailer |= d if isinstance(d, dict) else {}
        for n in list(self.places):
            try:
                o = self.get(Ref((n, 0)))
            except (PdfError, zlib.error, ValueError, TypeError):
                continue
            if isinstance(o, Stream) and o.dict.get("Type") == "ObjStm":
                lex = Lexer(decoded(o, self))
                for k in range(o.dict.get("N", 0)):
                    inner = lex.next(False)
                    lex.next(False)
                    self.places.setdefault(inner, (2, n, k))
            if isinstance(o, Stream) and o.dict.get("Type") == "XRef":
                self.trailer = o.dict | self.trailer
            if isinstance(o, dict) and o.get("Type") == "Catalog":
                self.trailer.setdefault("Root", Ref((n, 0)))
        if "Root" not in self.trailer:
            for n in list(self.places):
                o = self.get(Ref((n, 0)))
                if isinstance(o, dict) and o.get("Type") == "Catalog":
                    self.trailer["Root"] = Ref((n, 0))
        if not isinstance(self.get(self.trailer.get("Root")), dict):
            raise PdfError("Invalid PDF structure")

    def _object_at(self, at: int):
        lex = Lexer(self.data, at)
        lex.next(False), lex.next(False)
        if lex.next(False) != b"obj":
            raise PdfError("no object where one is expected")
        o = lex.next()
        lex.skip()
        if isinstance(o, dict) and self.data[lex.at : lex.at + 6] == b"stream":
            start = lex.at + 6
            start += 2 if self.data[start : start + 2] == b"\r\n" else 1
            n = self.get(o.get("Length"))
            end = start + n if isinstance(n, int) else -1
            if end < 0 or not self.data[end : end + 20].lstrip().startswith(b"endstream"):
                end = self.data.find(b"endstream", start)
                if end < 0:
                    raise PdfError("unterminated stream")
            return Stream(o, self.data[start:end])
        return o

    def get(self, o):
        """o, or what it refers to."""
        for _ in range(32):
            if not isinstance(o, Ref):
                return o
            n = o[0]
            if n not in self.cache:
                place = self.places.get(n)
                if place is None:
                    return None
                self.cache[n] = None
                if place[0] == 1:
                    self.cache[n] = self._object_at(place[1])
                else:
                    holder = self.get(Ref((place[1], 0)))
                    raw, d = decoded(holder, self), holder.dict
                    lex = Lexer(raw)
                    heads = [(lex.next(False), lex.next(False)) for _ in range(d["N"])]
                    for num, off in heads:
                        if num == n:
                            self.cache[n] = Lexer(raw, d["First"] + off).next()
            o = self.cache[n]
        return None

    def page_list(self) -> list[dict]:
        """Pages in order with inherited attributes."""
        out: list[dict] = []
        root = self.get(self.trailer.get("Root")) or {}
        stack = [(root.get("Pages"), {})]
        seen: set = set()
        while stack:
            ref, inherited = stack.pop()
            if isinstance(ref, Ref):
                if ref[0] in seen:
                    continue
                seen.add(ref[0])
            node = self.get(ref)
            if not isinstance(node, dict):
                continue
            own = inherited | {k: node[k] for k in ("Resources", "MediaBox", "CropBox", "Rotate") if k in node}
            if "Kids" in node:
                stack += [(k, own) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                out.append(node | own | {"_ref": ref})
        return out


def decoded(s: Stream, doc: Document) -> bytes:
    """Data of a stream; filters other than Flate, ASCII hex and run length leave it as it is."""
    filters, parms = doc.get(s.dict.get("Filter")), doc.get(s.dict.get("DecodeParms"))
    filters = filters if isinstance(filters, list) else [filters] if filters else []
    parms = parms if isinstance(parms, list) else [parms]
    data = s.raw
    for k, f in enumerate(filters):
        f, p = doc.get(f), doc.get(parms[k]) if k < len(parms) else None
        if f in ("FlateDecode", "Fl"):
            d = zlib.decompressobj()
            try:
                data = d.decompress(data) + d.flush()
            except zlib.error as e:
                raise PdfError(f"bad Flate data: {e}") from e
            data = _unpredicted(data, p or {})
        elif f in ("ASCIIHexDecode", "AHx"):
            data = bytes.fromhex(re.sub(rb"[^0-9A-Fa-f]", b"", data.split(b">")[0]).decode())
        else:
            return data
    return data


def _unpredicted(data: bytes, p: dict) -> bytes:
    if p.get("Predictor", 1) < 10:
        return data
    size = max(1, p.get("Colors", 1) * p.get("BitsPerComponent", 8) // 8)
    row = (p.get("Colors", 1) * p.get("BitsPerComponent", 8) * p.get("Columns", 1) + 7) // 8
    out, prev = bytearray(), bytearray(row)
    for at in range(0, len(data), row + 1):
        kind, line = data[at], bytearray(data[at + 1 : at + 1 + row])
        for i in range(len(line)):
            a = line[i - size] if i >= size else 0
            b, c = prev[i], prev[i - size] if i >= size else 0
            if kind == 1:
                line[i] = (line[i] + a) & 255
            elif kind == 2:
                line[i] = (line[i] + b) & 255
            elif kind == 3:
                line[i] = (line[i] + (a + b) // 2) & 255
            elif kind == 4:
                e = a + b - c
                near = min((abs(e - a), 0, a), (abs(e - b), 1, b), (abs(e - c), 2, c))[2]
                line[i] = (line[i] + near) & 255
        out += line
        prev = line
    return bytes(out)


# ------------------------------------------------------------------------------------------- contents


class Font:
    """Bytes of a string to text: by its ToUnicode map, else its simple encoding."""

    def __init__(self, d: dict, doc: Document) -> None:
        self.map: dict[int, str] = {}
        self.width = 2 if d.get("Subtype") == "Type0" else 1
        enc = doc.get(d.get("Encoding"))
        base = enc.get("BaseEncoding") if isinstance(enc, dict) else enc
        self.codec = {"MacRomanEncoding": "mac_roman"}.get(base, "cp1252")
        to = doc.get(d.get("ToUnicode"))
        if isinstance(to, Stream):
            self._cmap(decoded(to, doc))

    def _cmap(self, data: bytes) -> None:
        text = lambda b: b.decode("utf-16-be", "replace")
        for kind, body in re.findall(rb"begin(bfchar|bfrange|codespacerange)(.*?)end\1", data, re.DOTALL):
            lex, got = Lexer(body), []
            while (o := lex.next(False)) is not None:
                got.append(o)
            if kind == b"codespacerange":
                self.width = len(got[0]) if got and isinstance(got[0], bytes) else self.width
            elif kind == b"bfchar":
                self.map |= {int.from_bytes(a, "big"): text(b) for a, b in zip(got[::2], got[1::2], strict=False)}
            else:
                for lo, hi, to in zip(got[::3], got[1::3], got[2::3], strict=False):
                    for k, code in enumerate(range(int.from_bytes(lo, "big"), int.from_bytes(hi, "big") + 1)):
                        if isinstance(to, list):
                            self.map[code] = text(to[k]) if k < len(to) else ""
                        else:
                            self.map[code] = text(to[:-2]) + chr((int.from_bytes(to[-2:], "big") + k) & 0xFFFF)

    def text(self, raw: bytes) -> str:
        if not self.map:
            return raw.decode(self.codec, "replace") if self.width == 1 else raw.decode("utf-16-be", "replace")
        codes = [int.from_bytes(raw[i : i + self.width], "big") for i in range(0, len(raw), self.width)]
        return "".join(self.map.get(c, chr(c) if self.width == 1 else "�") for c in codes)


class Interpreter:
    """Runs a page's content; collects text items and drawing operators."""

    def __init__(self, doc: Document, want_text: bool, want_ops: bool) -> None:
        self.doc, self.want_text, self.want_ops = doc, want_text, want_ops
        self.items: list[list] = []
        self.ops: list[dict] = []
        self.fonts: dict = {}
        self.y: float | None = None

    def op(self, name: str, matrix: list | None = None) -> None:
        if self.want_ops:
            self.ops.append({"fn": OPCODES[name], "matrix": matrix, "scale_x": None, "scale_y": None, "positions": None, "placements": None})

    def show(self, raw, y: float) -> None:
        if self.want_text and isinstance(raw, bytes):
            if self.items and self.y is not None and abs(y - self.y) > 1e-6:
                self.items[-1][1] = True
            self.items.append([self.font.text(raw) if self.font else raw.decode("cp1252", "replace"), False])
            self.y = y

    font: Font | None = None

    def run(self, data: bytes, resources: dict, depth: int = 0) -> None:
        doc, lex, args = self.doc, Lexer(data), []
        get = lambda d, k: (doc.get((doc.get(d) or {}).get(k)) or {})
        line_y = leading = 0.0
        while (o := lex.next(False)) is not None:
            if not isinstance(o, Word):
                args.append(o)
                continue
            num = [float(x) for x in args if isinstance(x, (int, float)) and not isinstance(x, bool)]
            if o == b"q":
                self.op("save")
            elif o == b"Q":
                self.op("restore")
            elif o == b"cm" and len(num) >= 6:
                self.op("transform", num[:6])
            elif o == b"Do" and args and depth < 12:
                x = doc.get(get(resources, "XObject").get(args[-1]))
                if isinstance(x, Stream) and doc.get(x.dict.get("Subtype")) == "Image":
                    if not doc.get(x.dict.get("ImageMask")):
                        self.op("image")
                elif isinstance(x, Stream):
                    m = doc.get(x.dict.get("Matrix"))
                    self.op("form_begin", [float(doc.get(v)) for v in m] if isinstance(m, list) and len(m) >= 6 else None)
                    self.run(decoded(x, doc), doc.get(x.dict.get("Resources")) or resources, depth + 1)
                    self.op("form_end")
            elif o == b"BI":
                end = re.compile(rb"\bID[\0\t\n\f\r ](.*?)[\0\t\n\f\r ]EI(?=[\0\t\n\f\r ]|$)", re.DOTALL).search(data, lex.at)
                head = data[lex.at : end.start()] if end else b""
                if not re.search(rb"/(?:IM|ImageMask)\s+true", head):
                    self.op("inline_image")
                lex.at = end.end() if end else len(data)
            elif o == b"BT":
                line_y = 0.0
            elif o == b"Tf" and args:
                f = doc.get(get(resources, "Font").get(args[0])) if isinstance(args[0], Name) else None
                if isinstance(f, dict) and id(f) not in self.fonts:
                    self.fonts[id(f)] = Font(f, doc)
                self.font = self.fonts.get(id(f)) if isinstance(f, dict) else None
            elif o == b"TL" and num:
                leading = num[-1]
            elif o in (b"Td", b"TD") and len(num) >= 2:
                line_y += num[1]
                leading = -num[1] if o == b"TD" else leading
            elif o == b"Tm" and len(num) >= 6:
                line_y = num[5]
            elif o == b"T*":
                line_y -= leading
            elif o == b"Tj" and args:
                self.show(args[-1], line_y)
            elif o in (b"'", b'"') and args:
                line_y -= leading
                self.show(args[-1], line_y)
            elif o == b"TJ" and args and isinstance(args[-1], list):
                parts = [b" " if isinstance(x, (int, float)) and x < -200 else x for x in args[-1] if isinstance(x, bytes) or isinstance(x, (int, float)) and x < -200]
                self.show(b"".join(parts) if not self.font or self.font.width == 1 else b"".join(x for x in args[-1] if isinstance(x, bytes)), line_y)
            args = []


def _size(page: dict, doc: Document) -> tuple[float, float]:
    b = [float(doc.get(v)) for v in doc.get(page.get("CropBox")) or doc.get(page.get("MediaBox")) or [0, 0, 612, 792]]
    w, h = abs(b[2] - b[0]), abs(b[3] - b[1])
    return (h, w) if (doc.get(page.get("Rotate")) or 0) % 180 else (w, h)


def read_pages(content: bytes, wanted: list[int] | None = None, want_text: bool = True, want_ops: bool = True) -> Iterator[dict]:
    """Rows of PAGE_SCHEMA of the wanted pages (all where None), in the order asked."""
    doc = Document(bytes(content))
    pages = doc.page_list()
    for n in wanted if wanted is not None else range(1, len(pages) + 1):
        if not 1 <= n <= len(pages):
            raise PdfError(f"Page {n} does not exist")
        page = pages[n - 1]
        run = Interpreter(doc, want_text, want_ops)
        if want_text or want_ops:
            parts = doc.get(page.get("Contents"))
            streams = [doc.get(p) for p in parts] if isinstance(parts, list) else [parts]
            data = b"\n".join(decoded(s, doc) for s in streams if isinstance(s, Stream))
            run.run(data, doc.get(page.get("Resources")) or {})
        w, h = _size(page, doc)
        yield {"page": n, "page_count": len(pages), "width": w, "height": h, "items": [{"str": s, "has_eol": e} for s, e in run.items], "ops": run.ops}


def page_count(content: bytes) -> int:
    return len(Document(bytes(content)).page_list())


# --------------------------------------------------------------------------------------------- cutting


def _written(o, renumber) -> bytes:
    if isinstance(o, Ref):
        return b"%d 0 R" % renumber(o)
    if isinstance(o, Name):
        return b"/" + re.sub(rb"[^!-~]|[#()<>\[\]{}/%]", lambda m: b"#%02X" % m[0][0], o.encode("latin-1", "replace"))
    if isinstance(o, bool):
        return b"true" if o else b"false"
    if o is None:
        return b"null"
    if isinstance(o, int):
        return b"%d" % o
    if isinstance(o, float):
        return (b"%.6f" % o).rstrip(b"0").rstrip(b".") or b"0"
    if isinstance(o, bytes):
        return b"<" + o.hex().encode() + b">"
    if isinstance(o, list):
        return b"[" + b" ".join(_written(x, renumber) for x in o) + b"]"
    if isinstance(o, dict):
        return b"<<" + b" ".join(_written(Name(k), renumber) + b" " + _written(v, renumber) for k, v in o.items() if not k.startswith("_")) + b">>"
    raise PdfError(f"cannot write {type(o).__name__}")


def cut(doc: Document, first: int, last: int) -> bytes:
    """A document of pages first..last of an open one.  Objects are packed into compressed object streams;
    shared ones are copied once."""
    pages = doc.page_list()
    numbers: dict[int, int] = {}
    todo: list[int] = []

    def renumber(r: Ref) -> int:
        if r[0] not in numbers:
            numbers[r[0]] = len(numbers) + 3 + (last - first + 1)
            todo.append(r[0])
        return numbers[r[0]]

    plain: dict[int, bytes] = {}
    streams: dict[int, bytes] = {}
    kids = []
    for k, p in enumerate(pages[first - 1 : last]):
        n = 3 + k
        kids.append(Ref((n, 0)))
        body = {a: v for a, v in p.items() if a not in ("Parent", "_ref", "StructParents", "B")}
        body.setdefault("MediaBox", [0, 0, 612, 792])
        if isinstance(p.get("_ref"), Ref):
            numbers.setdefault(p["_ref"][0], n)
        plain[n] = _written({**body, "Type": Name("Page")}, renumber)[:-2] + b" /Parent 2 0 R>>"
    while todo:
        old = todo.pop()
        o, n = doc.get(Ref((old, 0))), numbers[old]
        if isinstance(o, Stream):
            d = {a: v for a, v in o.dict.items() if a != "Length"} | {"Length": len(o.raw)}
            streams[n] = _written(d, renumber) + b"\nstream\n" + o.raw + b"\nendstream"
        elif isinstance(o, dict) and o.get("Type") in ("Pages", "Page", "Catalog"):
            plain[n] = b"null"  # links to what lies outside the cut
        else:
            plain[n] = _written(o, renumber)
    plain[1] = b"<</Type /Catalog /Pages 2 0 R>>"
    plain[2] = b"<</Type /Pages /Count %d /Kids [%s]>>" % (len(kids), b" ".join(b"%d 0 R" % k[0] for k in kids))
    out, places = bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), {}
    for n, body in streams.items():
        places[n] = (1, len(out), 0)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    top = max([*plain, *streams]) + 1
    todo_n = sorted(plain)
    for at in range(0, len(todo_n), 100):
        group = todo_n[at : at + 100]
        heads, bodies = [], bytearray()
        for i, n in enumerate(group):
            heads.append(b"%d %d" % (n, len(bodies)))
            bodies += plain[n] + b" "
            places[n] = (2, top, i)
        head = b" ".join(heads) + b" "
        raw = zlib.compress(head + bytes(bodies))
        places[top] = (1, len(out), 0)
        out += b"%d 0 obj\n<</Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d>>\nstream\n%s\nendstream\nendobj\n" % (top, len(group), len(head), len(raw), raw)
        top += 1
    places[top] = (1, len(out), 0)
    table = b"\0\0\0\0\0\0\0\0\xff" + b"".join(bytes([places[n][0]]) + places[n][1].to_bytes(5, "big") + places[n][2].to_bytes(3, "big") if n in places else bytes(9) for n in range(1, top + 1))
    raw = zlib.compress(table)
    start = len(out)
    out += b"%d 0 obj\n<</Type /XRef /Size %d /W [1 5 3] /Root 1 0 R /Filter /FlateDecode /Length %d>>\nstream\n%s\nendstream\nendobj\nstartxref\n%d\n%%%%EOF\n" % (top, top + 1, len(raw), raw, start)
    return bytes(out)


# ------------------------------------------------------------------------------------------ DataFrames


def cut_udf(content: Column, first: Column, last: Column) -> Column:
    """struct(bytes, page_count, error) of a cut: bytes where first..last are pages of the document, error
    where it is unreadable.  A document is opened once."""
    if (active := SparkSession.getActiveSession()) is not None:
        ship(active)

    @F.pandas_udf(CUT_SCHEMA)
    def run(data: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = []
        for raw, x, y in zip(data, a, b, strict=True):
            made = n = error = None
            if raw is not None:
                try:
                    doc = Document(bytes(raw))
                    n = len(doc.page_list())
                    if 1 <= x <= y <= n and x % 1 == y % 1 == 0:  # false for NaN
                        made = cut(doc, int(x), int(y))
                except Exception as e:  # the document is unreadable; the row says so
                    n, made, error = None, None, str(e)
            rows.append((made, n, error))
        return pd.DataFrame(rows, columns=["bytes", "page_count", "error"]).astype({"page_count": "Int32"})

    return run(content, first.cast("double"), last.cast("double"))


def count_udf(content: Column) -> Column:
    """struct(page_count, error) of a document, from its page tree alone."""
    if (active := SparkSession.getActiveSession()) is not None:
        ship(active)

    @F.pandas_udf("page_count int, error string")
    def run(data: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in data:
            try:
                rows.append((None if raw is None else page_count(raw), None))
            except Exception as e:  # the document is unreadable; the row says so
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["page_count", "error"]).astype({"page_count": "Int32"})

    return run(content)


def pages(df: DataFrame, content: str = "content", keep: tuple[str, ...] = (), wanted: str | None = None, want_text: bool = True, want_ops: bool = True, on_error: str = "fail") -> DataFrame:
    """keep columns plus PAGE_SCHEMA, one row per page of each document.  `wanted` names an array<int>
    column of pages; a null there means all.  on_error 'collect' gives an unreadable document one row with
    null page and an `error`."""
    from pagewright.functions import errors

    errors.binary_field(df, content)
    schema = StructType([df.schema[k] for k in keep])
    for f in StructType.fromDDL(PAGE_SCHEMA):
        schema = schema.add(f)
    found = [f.name for f in StructType.fromDDL(PAGE_SCHEMA)]
    schema = schema.add("error", "string")
    ship(df.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        held: list[dict] = []

        def made():
            out = pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], arrow.field(n).type) for n in arrow.names], schema=arrow)
            held.clear()
            return out

        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for i, raw in enumerate(cols[content]):
                base = {k: cols[k][i] for k in keep}
                at = len(held)
                try:
                    if raw is None:
                        raise PdfError(errors.BINARY_MISSING % content)
                    for p in read_pages(raw, cols[wanted][i] if wanted else None, want_text, want_ops):
                        held.append(base | p | {"error": None})
                except Exception as e:
                    if on_error == "fail":
                        raise
                    del held[at:]
                    held.append(base | dict.fromkeys(found, None) | {"error": str(e)})
                if len(held) >= ROWS_AT_ONCE:
                    yield made()
        if held:
            yield made()

    return df.select(*dict.fromkeys([*keep, content, *([wanted] if wanted else [])])).mapInArrow(run, schema)


def document_pages(df: DataFrame, content: str, wanted: str, native: str, on_error: str = "fail") -> DataFrame:
    """df with _pages, array<struct<page, width, height, items, ops>> of the pages named in the array column
    `wanted` (null reads none), and _read_error.  Rows where the boolean column `native` is true get no operators.
    Other columns pass as they are; a document stays one row."""
    ship(df.sparkSession)
    page = "array<struct<" + PAGE_SCHEMA.replace("page_count int, ", "").replace("page int", "page:int").replace("width double", "width:double").replace("height double", "height:double").replace("items array", "items:array").replace("ops array", "ops:array") + ">>"
    schema = StructType(list(df.schema.fields)).add("_pages", StructType.fromDDL(f"x {page}")["x"].dataType).add("_read_error", "string")
    kinds = StructType(schema.fields[-2:])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        pages_type = to_arrow_schema(kinds).field(0).type
        for batch in batches:
            found, wrong = [], []
            for raw, asked, plain in zip(*(batch.column(n).to_pylist() for n in (content, wanted, native)), strict=True):
                got, error = None, None
                if asked is not None:
                    try:
                        got = list(read_pages(raw, asked, True, not plain))
                    except Exception as e:
                        if on_error == "fail":
                            raise
                        error = str(e)
                found.append(got)
                wrong.append(error)
            arrays = [*batch.columns, pa.array(found, pages_type), pa.array(wrong, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "_pages", "_read_error"])

    return df.mapInArrow(run, schema)


def read(spark, path: str) -> DataFrame:
    """PDF files under a path as rows of path, content and length."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content", "length")

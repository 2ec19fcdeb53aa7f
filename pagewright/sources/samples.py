"""Small PDFs and a stand-in OCR engine for tests and demonstrations."""

from __future__ import annotations

import struct
import zlib


class EchoOcr:
    """Stands in for an OCR engine: says what it was shown and told."""

    def recognize(self, image: bytes, language: str, settings: dict[str, str]) -> tuple[str, float]:
        width, height = struct.unpack(">II", image[16:24])
        return f"{language} {width}x{height} at {settings['user_defined_dpi']}", 50.0 + width % 50

    def close(self) -> None:
        pass


def make_pdf(pages: list[tuple[float, float, bytes]], compressed: bool = False) -> bytes:
    """A PDF of pages (width, height, content); each may use font F1 and image Im1."""
    objects = [b"<</Type /Catalog /Pages 2 0 R>>", b"", b"<</Type /Font /Subtype /Type1 /BaseFont /Helvetica>>", b"<</Type /XObject /Subtype /Image /Width 1 /Height 1 /BitsPerComponent 8 /ColorSpace /DeviceGray /Length 1>>\nstream\n\xff\nendstream"]
    kids = []
    for w, h, content in pages:
        data = zlib.compress(content) if compressed else content
        kids.append(len(objects) + 1)
        objects.append(b"<</Type /Page /Parent 2 0 R /MediaBox [0 0 %g %g] /Contents %d 0 R /Resources <</Font <</F1 3 0 R>> /XObject <</Im1 4 0 R>>>>>>" % (w, h, len(objects) + 2))
        objects.append(b"<</Length %d%s>>\nstream\n%s\nendstream" % (len(data), b" /Filter /FlateDecode" if compressed else b"", data))
    objects[1] = b"<</Type /Pages /Count %d /Kids [%s]>>" % (len(kids), b" ".join(b"%d 0 R" % k for k in kids))
    out, places = bytearray(b"%PDF-1.4\n"), []
    for i, o in enumerate(objects):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (i + 1, o)
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    out += b"trailer\n<</Size %d /Root 1 0 R>>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, start)
    return bytes(out)

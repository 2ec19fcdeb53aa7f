"""Recognition: text of the selected pages, from the native layer or by OCR, one result per document.

A document stays in its row from the scan to the result: it is counted, its wanted pages are read, routed by
expressions on the row, the pages that need it are rendered and recognised, and the result is assembled.  All
steps are narrow, so no document's bytes and no page are ever shuffled, and each branch is evaluated once."""

from __future__ import annotations

import multiprocessing
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import errors, text
from pagewright.shipping import ship

# Fixed value: the context keys a result never carries over.
DROPPED = ("pages", "pageCount", "recommendedMode", "nativePageCount", "ocrPageCount", "downloaded_base64", "attachment_base64", "attachments_to_process")
# Settings of the OCR engine.
ENGINE = {"oem": "lstm_only", "psm": "auto", "preserve_interword_spaces": "1"}


class OcrEngine(Protocol):
    """Turns the image of a page into (text, confidence)."""

    def recognize(self, image: bytes, language: str, settings: dict[str, str]) -> tuple[str, float]: ...

    def close(self) -> None: ...


def engine_settings(dpi: int) -> dict[str, str]:
    """What an engine is told about each image."""
    return ENGINE | {"user_defined_dpi": str(dpi)}


def context(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Context columns without the keys of an earlier preflight and of attachments."""
    return df.drop(*DROPPED, *extra)


def routed_mode(mode: Column, page_text: Column, coverage: Column) -> Column:
    """'native' or 'ocr' of a page under the recognition mode of its document."""
    return F.when(mode.isin("native", "ocr"), mode).otherwise(text.recommended_mode(page_text, coverage))


def document_source(source: Column) -> Column:
    """Aggregate: the one source of all pages, else 'mixed'."""
    return F.when(F.min(source) == F.max(source), F.min(source)).otherwise("mixed")


def render_size(points: Column, dpi: Column) -> Column:
    """Pixels of a page edge: the scaled length, rounded up."""
    return F.ceil(points * (dpi / 72)).cast("int")


class EngineProcess:
    """An engine in a process of its own, started with the first image.  A call that takes longer than its
    limit ends with the process, so it can't hold up or disturb the next page, which gets a new engine."""

    def __init__(self, make_engine: Callable[[], OcrEngine]) -> None:
        self.make_engine, self.process, self.pipe = make_engine, None, None

    def _serve(self, pipe, other) -> None:
        other.close()
        engine = None
        try:
            while (job := pipe.recv()) is not None:
                try:
                    engine = engine or self.make_engine()
                    pipe.send((True, tuple(engine.recognize(*job))))
                except Exception as e:  # the caller words and raises it
                    pipe.send((False, str(e)))
        except EOFError:  # the caller is gone
            pass
        finally:
            if engine is not None:
                engine.close()

    def recognize(self, image: bytes, language: str, settings: dict[str, str], ms: float | None) -> tuple[str, float]:
        """Within ms milliseconds; no limit for null, 0 and below."""
        if self.process is None:
            fork = multiprocessing.get_context("fork")
            self.pipe, theirs = fork.Pipe()
            self.process = fork.Process(target=self._serve, args=(theirs, self.pipe), daemon=True)
            self.process.start()
            theirs.close()
        self.pipe.send((image, language, settings))
        if not self.pipe.poll(ms / 1000 if ms is not None and ms > 0 else None):
            self._end(kill=True)
            raise TimeoutError(errors.OCR_TIMEOUT % f"{ms:g}")
        try:
            ok, got = self.pipe.recv()
        except EOFError:
            self._end(kill=True)
            raise RuntimeError("the OCR engine ended") from None
        if not ok:
            raise RuntimeError(got)
        return got

    def _end(self, kill: bool) -> None:
        if self.process is not None:
            if kill:
                self.process.kill()
            else:
                self.pipe.send(None)
            self.process.join()
            self.pipe.close()
            self.process = self.pipe = None

    def close(self) -> None:
        self._end(kill=False)


def page_results(pages: DataFrame) -> DataFrame:
    """page, source, text, confidence from routed pages with ocr_text and ocr_confidence."""
    ocr = F.col("mode") == "ocr"
    return pages.select(
        *[c for c in pages.columns if c not in ("mode", "text", "ocr_text", "ocr_confidence", "ocr_error", "image_coverage", "source", "confidence")],
        F.col("mode").alias("source"),
        F.when(ocr, F.col("ocr_text")).otherwise(F.coalesce("text", F.lit(""))).alias("text"),
        F.when(ocr, F.col("ocr_confidence")).alias("confidence"),
    )


def document_results(results: DataFrame, key: str, page_count: str, selection: str, requested: str) -> DataFrame:
    """One recognition_result per document: source, pageCount, then the selected pages or the range asked
    for, and the pages in order.  `requested` is the document's selected pages, ascending."""
    page = F.struct("page", "source", "text", "confidence")
    agg = results.groupBy(key).agg(
        document_source(F.col("source")).alias("source"),
        F.first(page_count).cast("int").alias("n"),
        F.first(selection).alias("kind"),
        F.first(requested).alias("asked"),
        F.array_sort(F.collect_list(page)).alias("pages"),
    )
    span = F.struct(F.array_min("asked").alias("from"), F.array_max("asked").alias("to"))
    return agg.select(
        key,
        F.struct(
            "source",
            F.col("n").alias("pageCount"),
            F.when(F.col("kind") != "specific", span).alias("range"),
            F.when(F.col("kind") == "specific", F.col("asked")).alias("selectedPages"),
            "pages",
        ).alias("recognition_result"),
    )


# Parameters of a document and what they default to.
DEFAULTS = {"recognition_mode": "auto", "page_selection": "range", "page_from": 1.0, "page_to": 0.0, "specific_pages": "", "ocr_language": "deu", "dpi": 300, "timeout_ms": 120000.0}


_FOUND = "array<struct<page:int,source:string,text:string,confidence:double>>"


def recognize(documents: DataFrame, make_engine: Callable[[], OcrEngine], key: str = "item_id", content: str = "data", on_error: str = "fail", renderer=None) -> DataFrame:
    """Documents with a PDF and optional parameter columns (see DEFAULTS, resolved per row) to their context
    columns and one recognition_result each.

    The page selection is checked before any page is read; native mode reads no operators, ocr mode reads no page.
    Only pages that need it are rendered (by `renderer`, draw() of the sources by default) and recognised.  on_error
    'collect' keeps every document, with `error` set where something failed and a null result."""
    from pagewright.functions import geometry
    from pagewright.functions import pages as rules
    from pagewright.sources import pdf

    binary = errors.binary_field(documents, content)
    types = {"page_from": "double", "page_to": "double", "dpi": "int", "timeout_ms": "double"}
    given = {k: F.coalesce(F.col(k), F.lit(v)) if k in documents.columns else F.lit(v) for k, v in DEFAULTS.items()}
    p = {k: F.col(f"_p.{k}") for k in DEFAULTS}
    n = F.col("_n.page_count")
    outer = [c for c in context(documents, (content, "recognition_result")).columns if c != "error" or on_error != "collect"]
    rows = documents.select(*outer, binary.alias("_content"), F.struct(*[c.cast(types.get(k, "string")).alias(k) for k, c in given.items()]).alias("_p"))
    rows = rows.withColumn("_n", pdf.count_udf(F.col("_content")))
    rule = rules.selection_error(p["page_selection"], n, p["page_from"], p["page_to"], p["specific_pages"])
    error = F.coalesce(F.when(F.col("_content").isNull(), errors.BINARY_MISSING % content), F.col("_n.error"), rule)
    asked = rules.selected_pages(p["page_selection"], n, p["page_from"], p["page_to"], p["specific_pages"])
    if on_error == "fail":
        asked = F.when(error.isNotNull(), F.raise_error(error)).otherwise(asked)
    rows = rows.withColumns({"_error": error, "_asked": asked})
    mode = p["recognition_mode"]
    read = F.when(F.col("_error").isNull() & (mode != "ocr"), F.col("_asked"))
    rows = pdf.document_pages(rows.withColumns({"_read": read, "_native": mode == "native"}), "_content", "_read", "_native", on_error)
    none, native = F.lit(None), F.lit("native")

    def seen(x: Column) -> Column:
        share = F.when(mode == "native", F.lit(0.0)).otherwise(F.coalesce(geometry.image_coverage(x["width"], x["height"], x["ops"]), F.lit(0.0)))
        return F.struct(x["page"].alias("page"), text.assemble(x["items"]).alias("text"), share.alias("share"))

    def routed(x: Column) -> Column:
        source = F.when(mode == "native", native).otherwise(text.recommended_mode(x["text"], x["share"]))
        return F.struct(x["page"].alias("page"), source.alias("source"), F.when(source == "native", x["text"]).alias("text"), none.cast("double").alias("confidence"))

    forced = F.transform("_asked", lambda x: F.struct(x.alias("page"), F.lit("ocr").alias("source"), none.cast("string").alias("text"), none.cast("double").alias("confidence")))
    rows = rows.withColumn("_seen", F.transform("_pages", seen))
    plan = F.when(F.col("_error").isNull() & F.col("_read_error").isNull(), F.when(mode == "ocr", forced).otherwise(F.transform("_seen", routed)))
    rows = rows.select(*outer, "_content", "_asked", F.col("_n.page_count").alias("_count"), F.coalesce("_error", "_read_error").alias("_error"), plan.alias("_plan"), *[p[k].alias(f"_{k}") for k in ("page_selection", "ocr_language", "dpi", "timeout_ms")])
    rows = _recognized(rows, make_engine, renderer, on_error)
    done = F.array_sort("_found")
    sources = F.array_distinct(F.transform("_found", lambda x: x["source"]))
    span = F.struct(F.array_min("_asked").alias("from"), F.array_max("_asked").alias("to"))
    result = F.struct(
        F.when(F.size(sources) == 1, F.get(sources, F.lit(0))).otherwise("mixed").alias("source"),
        F.col("_count").alias("pageCount"),
        F.when(F.col("_page_selection") != "specific", span).alias("range"),
        F.when(F.col("_page_selection") == "specific", F.col("_asked")).alias("selectedPages"),
        done.alias("pages"),
    )
    failed = F.coalesce("_error", "_late")
    ok = failed.isNull() & F.col("_asked").isNotNull()
    out = rows.select(*outer, F.when(ok, result).alias("recognition_result"), *([failed.alias("error")] if on_error == "collect" else []), ok.alias("_ok"))
    return (out if on_error == "collect" else out.where("_ok")).drop("_ok")


def _recognized(rows: DataFrame, make_engine: Callable[[], OcrEngine], renderer, on_error: str) -> DataFrame:
    """rows without _content, with _found, the pages of _plan with what OCR read, and _late, the first error of a
    document.  Columns of the context pass as they are; an engine is started by the first page a task needs it for."""
    from pyspark.sql.types import StructType

    from pagewright.sources import render

    schema = StructType([f for f in rows.schema if f.name not in ("_content", "_plan")]).add("_found", StructType.fromDDL(f"x {_FOUND}")["x"].dataType).add("_late", "string")
    draw = renderer or render.draw
    ship(rows.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        engine = EngineProcess(make_engine)
        try:
            for batch in batches:
                found, late = [], []
                at = {k: batch.column(f"_{k}") for k in ("content", "ocr_language", "dpi", "timeout_ms")}
                for i, plan in enumerate(batch.column("_plan").to_pylist()):
                    wrong = None
                    if plan and any(x["source"] == "ocr" for x in plan):
                        language, dpi, ms = (at[k][i].as_py() for k in ("ocr_language", "dpi", "timeout_ms"))
                        try:
                            with render.PageRenderer(at["content"][i].as_py(), 1, draw) as images:
                                for x in plan:
                                    if x["source"] == "ocr":
                                        image = images.render(x["page"], dpi)
                                        try:
                                            x["text"], x["confidence"] = engine.recognize(image, language, engine_settings(dpi), ms)
                                        except Exception as e:
                                            raise RuntimeError(errors.OCR_FAILED % (x["page"], e)) from e
                        except Exception as e:
                            if on_error == "fail":
                                raise
                            wrong = str(e)
                    found.append(plan if wrong is None else None)
                    late.append(wrong)
                made = {"_found": pa.array(found, arrow.field("_found").type), "_late": pa.array(late, pa.string())}
                yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)
        finally:
            engine.close()

    return rows.mapInArrow(run, schema)

"""Helpers shared by the text operators: tables, cut points in the shared folder, Arrow maps."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.shipping import ship
from pagewright.sources.tables import read_table as table  # noqa: F401

_OPENED: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share.  The cluster names it in spark.checkpoint.dir; only where that is
    unset (tests, a single machine) is one of our own chosen."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_pagewright"
    own = "file://" + tempfile.mkdtemp(prefix="pagewright-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def cut(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, so a lost executor costs no
    recomputation of what came before, and two consumers don't evaluate it twice.  Columns named in `by` become folders, so readers of one value skip the
    rest."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagewright-{uuid.uuid4().hex[:12]}-{name}"
    if not _OPENED:
        atexit.register(_remove_all)
    _OPENED.append((spark, path))
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _remove_all() -> None:
    for spark, path in _OPENED:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone; the folder is the cluster's to clean
            return


def arrow_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """mapInArrow where fn gives the batches of a task as columns of the schema, as lists."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """arrow_stream for functions of one batch."""
    return arrow_stream(df, lambda batches: map(fn, batches), schema)


def portions(texts: list[str | None], most: int) -> Iterator[slice]:
    """Slices of a batch of about `most` characters, so that long texts don't multiply a task's memory."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and held + n > most:
            yield slice(at, i)
            at, held = i, 0
        held += n
    if at < len(texts):
        yield slice(at, len(texts))


class WordFilter:
    """A Bloom filter in a broadcast: it never misses a member, so an exact join may follow on what passes."""

    def __init__(self, broadcast, bits: int) -> None:
        self.broadcast, self.bits = broadcast, bits

    def test(self) -> Callable[[str], bool]:
        raw, bits, memo = self.broadcast.value, self.bits, {}

        def may(word: str) -> bool:
            hit = memo.get(word)
            if hit is None:
                a, b = _places(word, bits)
                hit = bool(raw[a >> 3] & (128 >> (a & 7)) and raw[b >> 3] & (128 >> (b & 7)))
                if len(memo) < 200_000:
                    memo[word] = hit
            return hit

        return may


LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # 128 KB to 32 MB
BITS_A_WORD = 16
PARTS = 64  # of a filter, merged each on its own


def _places(word: str, bits: int) -> tuple[int, int]:
    h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h % bits, (h >> 32) % bits


def word_filter(words: DataFrame) -> WordFilter:
    """The filter of the one string column of words, a table.  It has BITS_A_WORD bits a word within LEAST_BITS and
    MOST_BITS; beyond 16 million words it grows no more and lets more pass, never less.  Every task sets the bits of
    its own words; the parts of the filter are then merged by as many tasks, and only the filter reaches the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_WORD * max(1, words.count()) - 1).bit_length()))
    size = bits // 8 // PARTS

    def own(batches):
        marks = np.zeros(bits, dtype=bool)
        for b in batches:
            at = [p for w in b.column(0).to_pylist() for p in _places(w, bits)]
            marks[at] = True
        packed = np.packbits(marks).reshape(PARTS, size)
        full = np.flatnonzero(packed.any(axis=1))
        yield {"part": full.tolist(), "bits": [packed[k].tobytes() for k in full]}

    def merged(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(part, np.zeros(size, np.uint8))
                held[part] |= np.frombuffer(raw, np.uint8)
        yield {"part": list(held), "bits": [x.tobytes() for x in held.values()]}

    parts = arrow_stream(words, own, "part int, bits binary").repartition(min(PARTS, 8 if bits == LEAST_BITS else PARTS), "part")
    out = np.zeros((PARTS, size), np.uint8)
    for row in arrow_stream(parts, merged, "part int, bits binary").collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return WordFilter(words.sparkSession.sparkContext.broadcast(out.tobytes()), bits)


def among(ids: DataFrame) -> Callable[..., Column]:
    """A function of columns that tells, without a shuffle of the rows it is asked for, which of them may stand in a
    table of ids; those of the table all do, few others (null ids always do).  An exact join may follow."""
    key = lambda cols: F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\1")) for c in cols])
    known = word_filter(ids.select(key(ids.columns).alias("id")))

    @F.pandas_udf("boolean")
    def may(x: pd.Series) -> pd.Series:
        test = known.test()
        return pd.Series([test(v) or "\1" in v for v in x], dtype=bool)

    return lambda *cols: may(key(cols))


def once(df: DataFrame, *ids: str) -> DataFrame:
    """One row of each id.  Only ids are shuffled to find those delivered again; only their rows are shuffled whole."""
    ship(df.sparkSession)
    again = cut(df.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*ids), "again")
    seen = among(again)(*ids)
    return df.where(~seen).unionByName(df.where(seen).dropDuplicates(list(ids)))

"""Things that several operators need: tables, scratch tables, size-checked broadcasts, hashing of bytes."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as all operators count them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast up to so many rows; beyond it the join shuffles.
BROADCAST_ROWS = 20_000
#: A list of ids is broadcast up to so many (8 bytes each), else the join shuffles.
BROADCAST_IDS = 1_000_000
#: Bytes of text that one vectorised step handles at a time; a longer document is handled alone.
CHUNK_BYTES = 1 << 19
#: What a batch that goes to Python holds at most, for the memory of executors that run several workers.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, in it one folder for each application. Only a session in one
    process may do without the setting: it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/downfield-scratch"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Deletes the scratch tables of this application, once its results are written: results that aren't read them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Lists that note the scratch tables made while they are open (see :func:`noted`).
_open: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the scratch folder."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(path)
    return path


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """Notes the scratch tables that are made inside, so that :func:`drop_tables` can delete just these."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open[:] = [x for x in _open if x is not made]


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes scratch tables that nothing reads any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame, name: str, compression: str = "snappy", **options) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it again: the lineage ends there, so a lost
    executor costs a read of the table and no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes scratch tables (see :func:`cut`) that nothing reads any more."""
    for df in tables:
        drop_tables(df.sparkSession, sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}))


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast of a scratch table (see :func:`cut`) only if its counted rows stay under BROADCAST_ROWS."""
    n = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def fits(rows: DataFrame) -> DataFrame:
    """A scratch table as the smaller side of a join: broadcast up to BROADCAST_ROWS rows, or, if it holds one number a row,
    up to BROADCAST_IDS. Beyond that it is a plain side, and as it is a table, Spark can split the other side's hot keys."""
    light = all(kind in ("bigint", "int") for _, kind in rows.dtypes) and len(rows.columns) == 1
    return F.broadcast(rows) if rows.count() <= (BROADCAST_IDS if light else BROADCAST_ROWS) else rows


def some(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents in (left_semi) or not in (left_anti) a scratch table of ``doc_id``; its counted size picks the join."""
    return docs.join(fits(ids), "doc_id", how)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with the session's batches made no larger than BATCH_ROWS and BATCH_BYTES."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(f"spark.sql.execution.arrow.{key}", None) or ""
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(f"spark.sql.execution.arrow.{key}", str(most))
    return df.mapInArrow(f, schema)


def ascii_lower(c: Column | str) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column | str) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(c) if isinstance(c, str) else c, F.lit(WORD)), F.lit(0)).cast("long")


# ---- hashing of substrings, vectorised ------------------------------------------------------------------------------

#: Sums are modulo this prime, of two bases: no string, however built, makes them vanish as powers of two would.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_355_149_097, 738_264_113)
#: Bytes after which sums are reduced; so many terms of 40 bits stay below 2**64.
_REDUCE = 1 << 23


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, of numbers below 2**64."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    x = (x & _PRIME) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    m = 1
    while m < n:
        out[m : 2 * m] = _reduced(out[: min(m, n - m)] * np.uint64(pow(base, m, int(_PRIME))))
        m *= 2
    return out.astype(np.uint32)


class Powers:
    """Powers of the bases and of their inverses modulo the prime, 16 bytes for each byte of the longest chunk so far."""

    up = [_powers(b, 1 << 12) for b in _BASES]
    down = [_powers(pow(b, -1, int(_PRIME)), 1 << 12) for b in _BASES]

    @classmethod
    def upto(cls, n: int) -> None:
        if n > len(cls.up[0]):
            n += n >> 3
            cls.up = [_powers(b, n) for b in _BASES]
            cls.down = [_powers(pow(b, -1, int(_PRIME)), n) for b in _BASES]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_hash(data: np.ndarray) -> list[np.ndarray]:
    """For each base h with h[j] - h[i] = sum of (byte + 1) * base**position over i <= position < j, modulo the prime."""
    n = len(data)
    Powers.upto(n + 1)
    value = data.astype(np.uint64) + np.uint64(1)
    out = []
    for up in Powers.up:
        sums = np.zeros(n + 1, np.uint64)
        for at in range(0, n, _REDUCE):
            to = min(n, at + _REDUCE)
            np.cumsum(value[at:to] * up[at:to], out=sums[at + 1 : to + 1])
            if n > _REDUCE:
                sums[at + 1 : to + 1] = _reduced(sums[at + 1 : to + 1] + sums[at])
        out.append(sums)
    return out


def span_hash(prefix: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62-bit hash, spread over 64, of the bytes in each [start, end), the same wherever they stand."""
    one, two = (
        _reduced(_reduced(sums[end] + _PRIME - sums[start]) * down[start]) for sums, down in zip(prefix, Powers.down, strict=True)
    )
    return mix64(one << np.uint64(31) | two)


def _loose_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class LoosePowers:
    """Powers of a base and of its inverse modulo 2**64; grown when a longer chunk comes."""

    base = 0x9E3779B97F4A7C15
    up = _loose_powers(base, 1 << 12)
    down = _loose_powers(pow(base, -1, 1 << 64), 1 << 12)

    @classmethod
    def upto(cls, n: int) -> None:
        if n > len(cls.up):
            cls.up, cls.down = _loose_powers(cls.base, 2 * n), _loose_powers(pow(cls.base, -1, 1 << 64), 2 * n)


def loose_sums(data: np.ndarray) -> np.ndarray:
    """Like :func:`prefix_hash`, cheaper, modulo 2**64: strings of a regular build may share a hash more often than by chance.
    For places of features, which are shared anyway, and for names whose strings are compared afterwards."""
    n = len(data)
    LoosePowers.upto(n + 1)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * LoosePowers.up[:n], out=out[1:])
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the document each is in. ``bounds``: where documents begin, and the end."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = bounds[1:-1]  # a word never runs over the border of two documents
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def texts(
    batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES, rows: int = 4096
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of at most ``rows`` rows and about ``limit`` bytes of text: first row, row after the last, bytes, bounds of the rows.
    Null counts as empty."""
    col = batch.column(column)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("").cast(pa.large_string())
    n = len(col)
    if not n:
        return
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = min(at + rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def per_doc_sum(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n)

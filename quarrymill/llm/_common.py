"""What the training-data operators share: shared storage, bounded samples and text arrays.

Texts are worked on in numpy as code-point arrays of many documents at a time, so no
operator runs Python once per character; a batch is cut by characters, not rows, which
bounds a worker's memory whatever the document lengths are.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that a worker expands into numpy arrays at once.
BATCH_CHARS = 250_000
#: Bytes of rows that go to a Python worker at once.
ARROW_BYTES = 8 << 20


def session(df: DataFrame) -> SparkSession:
    """The session, with its Arrow batches bounded by ``ARROW_BYTES``: long texts then don't fill workers."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.sparkSession


def trimmed(f):
    """A batch function whose worker gives freed memory back when it is done: idle workers then stay small.

    What the worker keeps for the functions of another module (``kept_by``) goes first.
    """
    module = f.__module__

    @functools.wraps(f)
    def run(batches: Iterator) -> Iterator:
        kept_by(module)
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL(None).malloc_trim(0)

    return run


#: Tables that a worker keeps from task to task, and the module that it worked for last.
KEPT: list[dict] = []
_LAST: list[str] = []


def kept_by(module: str) -> None:
    """Empties the tables that a worker keeps if it worked for another module before."""
    if _LAST and _LAST[0] != module:
        for held in KEPT:
            held.clear()
    _LAST[:] = [module]


def shared_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine (tests) a local folder is made; on a
    cluster that is an error. What is written there backs DataFrames that are still lazy, so it
    stays until ``discard``.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = getattr(shared_dir, "own", None)
        if root is None:
            root = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="quarrymill-")
    path = f"{root.rstrip('/')}/qm-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE: list[str] = []


def discard(spark: SparkSession) -> None:
    """Deletes all that this process put into the shared folder: to be called when no result is read any more."""
    for path in _MADE:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _MADE.clear()


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, lost executors cost nothing."""
    spark, path = session(df), shared_dir(session(df))
    df.write.parquet(path)
    spark._jvm.System.gc()  # the driver's: Spark deletes shuffle files once the plans that wrote them are collected
    return spark.read.schema(df.schema).parquet(path)


def tidied(df: DataFrame) -> DataFrame:
    """``df``, after every executor was asked to collect its garbage: heap that work before it filled goes back to the machine.

    Heap that was once used otherwise stays with the executor's JVM, beside the Python workers of all that follows.
    One short task a core, so that each executor has one; garbage collection that one of them did counts for the others.
    """
    spark = session(df)
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()
    return df


def remainder(id_col: str, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def bounded_sample(rows: DataFrame, id_col: str, label_cols: list[str], n: int, seed: int = 7) -> DataFrame:
    """At most ``n`` labelled ids, picked by hash: the same ones for the same rows, whatever the partitions.

    Only ids and labels move; the texts of the picked ids are joined afterwards.
    """
    picked = rows.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.min(c).alias(c) for c in label_cols])
    return smallest(picked, F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), n, id_col)


def smallest(rows: DataFrame, key: Column, n: int, tie: str) -> DataFrame:
    """The ``n`` rows with the smallest ``key`` (a 64-bit hash).

    A bound that some 4 n rows lie below goes first, so that tasks don't each send n rows to one.
    """
    total = rows.count()
    if total > 8 * n:
        rows = rows.where(key < int((4 * n / total) * 2**64) - 2**63)
    return rows.orderBy(key, F.col(tie)).limit(n)


def slices(lengths: np.ndarray, budget: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose lengths sum to ``budget`` at most; a longer row stands alone."""
    i, n = 0, len(lengths)
    ends = np.cumsum(lengths, dtype=np.int64)
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield i, j
        i = j


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and where each text starts (n + 1 values)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    joined = "\n".join(texts) + "\n" if texts else ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), starts


def lower_same_length(text: str) -> str:
    """Lower case that keeps every code point's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


#: A-Z to a-z and nothing else.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

#: White space that separates words in the contracts: space and \t to \r.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def utf8(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by a line feed, and where each text starts (n + 1 values)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in raw], out=starts[1:])
    return np.frombuffer(b"\n".join(raw) + b"\n" if raw else b"", np.uint8), starts


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in an array that ends with white space."""
    space = (data == 32) | (data - np.uint8(9) < 5)  # of unsigned bytes: those below 9 wrap around
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


#: An odd multiplier for word hashes; prefix sums of byte * _P**i give all words' hashes at once.
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}
KEPT.append(_POWERS)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        full = np.full(size, base, np.uint64)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if size <= 1 << 22:
            _POWERS[int(base)] = have
    return have[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the byte ranges, all at once."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_P, len(data)), out=sums[1:])
        h = (sums[ends] - sums[starts]) * _powers(_PINV, len(data) + 1)[starts]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h

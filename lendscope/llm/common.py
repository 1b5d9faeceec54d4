"""Shared helpers: table readers, shared folder, word fingerprints, graph components."""

from __future__ import annotations

import ctypes
import functools
import gc
import pickle
import sys
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WINDOW_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    A session without the setting gets a temporary folder in local mode only;
    on a cluster the setting is required, since executors share nothing else.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lendscope-llm-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables materialised inside are deleted at the end, unless kept."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.pop()
        for path in paths:
            drop_folder(spark, path)


def materialised(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    a lost executor costs a re-read instead of a recomputation. With ``keep``
    the table outlives the innermost :func:`scratch` around it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    scopes = _SCOPES[:-1] if keep else _SCOPES
    if scopes:
        scopes[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like :func:`materialised`, in ``buckets`` buckets of ``key``: joins on it
    read the table without a shuffle. The catalog's entry goes at once."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    entry = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(entry)
    if _SCOPES:
        _SCOPES[-1].append(path)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")  # a table with a path of its own keeps its files
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of a DataFrame that :func:`materialised` gave."""
    drop_folder(df.sparkSession, df.stored_at)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose DataFrames are gone: its
    cleaner does so when the driver collects garbage, which may otherwise be
    long after the jobs of a loop have filled the disks."""
    gc.collect()
    spark._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, through Spark's file system layer."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def unused(columns, *stems: str) -> list[str]:
    """A column name from each stem that none of ``columns`` has, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem = f"_{stem}"
        taken.add(stem.lower())
        out.append(stem)
    return out


class Shipped:
    """A broadcast of an object of this subpackage: its classes travel with it,
    so workers need no copy of the package. ``value`` unpickles it anew."""

    def __init__(self, spark: SparkSession, value):
        self.raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.raw.value)


# --- Python workers -----------------------------------------------------------

def worker_cache(owner: str) -> dict:
    """What ``owner``'s tasks keep in this Python worker from task to task.

    Spark's Python workers outlive their tasks, while functions shipped by value
    bring their globals anew each time; so it hangs on the interpreter. The first
    task of another owner drops it (see :func:`tidy`)."""
    return sys.__dict__.setdefault("_kept_by_tasks", {}).setdefault(owner, {})


def _trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def trimmed(run):
    """Wraps a function over the tables of one group or of two: after each group
    freed memory goes back to the system, so that groups do not add up."""
    def one(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            _trim()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            _trim()

    return two if run.__code__.co_argcount == 2 else one


def tidy(owner: str):
    """Wraps a function over batches: at its start the worker lets go of what other
    operators' tasks kept, at its end freed memory goes back to the system, so
    that a worker that serves one stage after the other does not add up."""
    def wrap(run):
        @functools.wraps(run)
        def tidied(batches):
            kept = sys.__dict__.setdefault("_kept_by_tasks", {})
            for other in [k for k in kept if k != owner]:
                del kept[other]
            try:
                yield from run(batches)
            finally:
                _trim()
        return tidied
    return wrap


# --- word fingerprints ------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(x) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(np.asarray(x, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE = mix(_FOLD.astype(np.uint64) + np.uint64(1000))
_R = 0x5851F42D4C957F2D
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base mod 2^64 and of its inverse, by repeated doubling."""
    size = max(WINDOW_BYTES, n)
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_R, pow(_R, -1, 1 << 64)):
            p = np.ones(1, dtype=np.uint64)
            while len(p) < size:
                with np.errstate(over="ignore"):
                    p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            out.append(p[:size])
        _POWERS[size] = tuple(out)
    return _POWERS[size]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (rows + 1) of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, off


def word_windows(texts: pa.Array):
    """Yield (row, start, end, fingerprint, bytes) arrays of the words of
    ``texts``, window by window, in text order.

    Words are runs of non-space bytes, A-Z lower-cased; a window holds about
    ``WINDOW_BYTES`` and never cuts a word, so one very long text is read in
    several windows and memory stays bounded. The fingerprint is a 64-bit
    polynomial hash over the folded bytes, taken from prefix sums.
    """
    data, off = text_buffers(texts)
    row, n = 0, len(off) - 1
    at = int(off[0]) if n > 0 else 0
    end_all = int(off[-1]) if n > 0 else 0
    while at < end_all:
        stop = min(at + WINDOW_BYTES, end_all)
        if stop < end_all:  # cut at a row end, else at a space
            last = int(off[np.searchsorted(off, stop, "right") - 1])
            if last > at:
                stop = last
            else:
                row_end = int(off[np.searchsorted(off, stop, "left")])
                while stop < row_end:
                    gap = np.flatnonzero(_SPACE[data[stop:min(stop + 65536, row_end)]])
                    if len(gap):
                        stop += int(gap[0])
                        break
                    stop = min(stop + 65536, row_end)
        b = data[at:stop]
        word = ~_SPACE[b]
        fresh = np.zeros(len(b) + 1, dtype=bool)
        edge = off[(off > at) & (off < stop)] - at
        fresh[edge] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | fresh[1:-1]
        finish = word.copy()
        finish[:-1] &= ~word[1:] | fresh[1:-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        if len(s):
            up, down = _powers(len(b))
            with np.errstate(over="ignore"):
                run = np.zeros(len(b) + 1, dtype=np.uint64)
                np.cumsum(_BYTE[b] * up[:len(b)], out=run[1:])
                h = _mix((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64))
            yield np.searchsorted(off, s + at, "right") - 1, s, e, h, b
        at = stop


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, fingerprint) of every word of a batch, in text order."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for r, _, _, h, _ in word_windows(texts):
        rows.append(r)
        hashes.append(h)
    return np.concatenate(rows), np.concatenate(hashes)


def small_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20):
    """Slices of a record batch whose ``column`` holds about ``max_bytes``."""
    _, off = text_buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + max_bytes, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


# --- connected components ---------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): root is the
    smallest node reachable.

    Alternates the large-star and small-star steps: each is one aggregation
    (partial minima first) and one join, so a node of any degree is spread by
    partial aggregation and adaptive skew splitting. Every round is written to
    the shared folder; rounds end when the edge set stays the same.
    """
    spark = links.sparkSession
    e = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    mark = None
    e = materialised(e, "links")
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialised(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "star")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))

"""Shared helpers of the training-data operators: scratch tables, sampling, byte-level numpy."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text is taken through numpy in slices of about this many bytes, so a batch's temporaries stay small.
SLICE_BYTES = 1 << 19
_scratch: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; deleted by free(), or when the driver's Python ends.

    Where the setting is missing, a local session, as in tests, is given a folder of this machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/quire-checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_clean)
    _scratch[path] = spark
    return path


def _delete(path: str, spark: SparkSession) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for path, spark in _scratch.items():
        try:
            _delete(path, spark)
        except Exception:  # noqa: BLE001, S110  the JVM may have gone first
            pass


def free(*tables: DataFrame) -> None:
    """Deletes materialize()'s tables, once all that was read from them has been written elsewhere."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path in _scratch:
            _delete(path, _scratch.pop(path))


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Holds what goes to Python at once to 4 MB, whatever the rows' length; a session's smaller bound stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    size = int(now.rstrip("kmg")) * unit
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: a Parquet table in the shared folder, read again."""
    spark = small_batches(df.sparkSession)
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def crc_mod(col: Column | str, m: int) -> Column:
    """crc32 of the id as text, modulo m; null ids count as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % m


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def give_back() -> None:
    """Memory that a task has freed goes back to the system, as Python workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """run, a function of a task's batches, with its freed memory given back at the end."""
    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def utf8(batch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """An Arrow batch's string column as one byte array and n + 1 offsets; nulls are empty."""
    import pyarrow as pa

    col = batch.column(name) if isinstance(name, (str, int)) else name
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and off[-1] > 0 else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer row is a range of its own."""
    out, i, n = [], 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        out.append((i, min(j, n)))
        i = min(j, n)
    return out


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: 64 bits in, 64 well mixed bits out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)
#: BASE * INVERSE = 1 modulo 2**64.
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_tables: dict[str, np.ndarray] = {}


def power_table(base: np.uint64, n: int) -> np.ndarray:
    key = str(int(base))
    if key not in _tables or len(_tables[key]) <= n:
        if n > 2 * SLICE_BYTES:  # a very long row's table isn't kept
            return powers(base, n)
        _tables[key] = powers(base, 1 << max(14, n.bit_length()))
    return _tables[key]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^ \\t-\\r]+ of each row's bytes, and n + 1 offsets into them; no word spans two rows."""
    gap = SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = True
        before[1:] = gap[:-1]
        before |= first[:-1]
    start = np.flatnonzero(before & ~gap)
    after = np.empty(len(data), bool)
    if len(data):
        after[-1] = True
        after[:-1] = gap[1:]
        after |= first[1:]
    end = np.flatnonzero(after & ~gap) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: polynomial sums by prefix, shifted to the word's start, mixed with its length."""
    up = power_table(BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    down = power_table(INVERSE, len(data))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive word hashes, by position; len(h) - k + 1 of them, across row borders too."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= GRAM_BASE
        out += h[i : i + n]
    return mix(out)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Characters at a word's ends that aren't part of it.
EDGE = np.zeros(256, bool)
EDGE[[*map(ord, ".,;:!?()[]\"'|*&%$#<>-_=+~`^/\\@{}")]] = True


def trimmed(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; starts and ends of words without punctuation at their ends; n + 1 offsets into the words."""
    low = LOWER[data]
    start, end, at = words(low, off)
    if not len(start):
        return low, start, end, at
    solid = ~EDGE[low]
    place = np.where(solid, np.arange(len(low)), len(low))
    following = np.minimum.accumulate(place[::-1])[::-1]
    place = np.where(solid, np.arange(len(low)), -1)
    preceding = np.maximum.accumulate(place)
    s, e = np.minimum(following[start], end), preceding[end - 1] + 1
    ok = s < e
    kept = np.concatenate([[0], np.cumsum(ok)])
    return low, s[ok], e[ok], kept[at]

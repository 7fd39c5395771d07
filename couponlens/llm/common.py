"""Helpers of the operators: stored intermediate tables, text in batches, connected components."""

from __future__ import annotations

import ctypes.util
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.session import shared_folder

_STORED: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Code points or bytes that a task handles at once; a longer single text is handled alone.
CHUNK = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers find this package where it is not installed but lies in the same place on every machine, as
    with a local master. A cluster without such a place gets it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back. What stands before it does not run again, also when an
    executor is lost. ``drop_stored`` deletes the tables of this session when their results have been written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    # shuffle files of a job whose result is stored serve nobody
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_tables() -> int:
    """How many tables this session holds in the shared folder."""
    return len(_STORED)


def drop_stored(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Deletes the tables stored from place ``since`` on, but the last ``keep``."""
    jvm = spark.sparkContext._jvm
    end = max(since, len(_STORED) - keep)
    for name in _STORED[since:end]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    del _STORED[since:end]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_only(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that an operator needs, whatever else the table holds; a null text becomes empty."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def chunks(lengths: list[int], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters in all; at least one row each."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total + n > limit and i > start:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], [*columns])


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of the rows (key, text), in chunks of about ``limit`` characters."""
    for batch in batches:
        for a, b in chunks(pc.utf8_length(batch.column(1)).to_pylist(), limit):
            yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_pylist()


@functools.cache
def _settle() -> None:
    """What a worker holds after its first task, above all its modules, need not be gone through after each later one."""
    gc.freeze()


def trim() -> None:
    """Hands the memory that a Python worker has freed back to the system. Workers outlive their tasks, so what one stage
    leaves behind would otherwise count against the next."""
    gc.collect()
    _settle()
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    if name and hasattr(library := ctypes.CDLL(name), "malloc_trim"):
        library.malloc_trim(0)


def trimmed(task: Callable) -> Callable:
    """The task, followed by `trim`."""

    def run(batches):
        yield from task(batches)
        trim()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values; by one sort, which numpy does many times faster than ``unique``."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


class RunHash:
    """64-bit polynomial hashes of runs of symbols, from prefix sums modulo 2^64 over random symbol values."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            step = np.full(n, self.BASE, np.uint64)
            step[0] = 1
            self.powers = np.cumprod(step)
            step[1:] = pow(self.BASE, -1, 1 << 64)
            self.inverses = np.cumprod(step)

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        """Prefix sums; ``symbols`` are any unsigned integers."""
        return self.premixed(mix64(symbols.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)))

    def premixed(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of symbols that are random 64-bit values already."""
        n = len(values)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        body = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix64(body ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def perhaps_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` can be in the column ``key`` of ``wanted``, by a bitmap of hashed keys that has at most 4 MB
    whatever the number of keys. Rows that are not wanted may remain, so that a join must follow; it spares that join most
    of the shuffle where few rows are wanted."""
    bits, word = 1 << 25, 1 << 15  # word: bits of one row of the bitmap, fixed by Spark

    def slot():
        return F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1

    held = wanted.select(slot().alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(word)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = df.withColumn("_bucket", F.bitmap_bucket_number(slot())).join(F.broadcast(held), "_bucket")
    return marked.where(F.getbit(byte, place.bitwiseAND(F.lit(7))) == 1).select(*df.columns)


_BITS = 1 << 25


def bits_of(wanted: DataFrame, key: str) -> np.ndarray:
    """A bitmap of the lowest bits of the hashes in the column ``key``, of 4 MB whatever their number, for `among_bits`."""
    slot = F.col(key).bitwiseAND(F.lit(_BITS - 1)) + 1
    held = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros((_BITS >> 15, 1 << 12), np.uint8)
    for bucket, bits in held.collect():
        out[bucket - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def among_bits(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether hashes can be among those of the bitmap; those that are not wanted may be, too."""
    slot = keys & (_BITS - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps: columns ``node`` and ``component`` (the
    smallest node reachable), one row for every node that has an edge to another node.

    Each step is one aggregation and one join on the node, so a hub with millions of neighbours is combined before the
    shuffle and split by the adaptive skew join; every round is stored in the shared folder.
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        u, v = F.col("u"), F.col("v")
        both = links.unionAll(links.select(v.alias("u"), u.alias("v"))) if large else links
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where(v > u).select(v.alias("u"), F.least(u, "m").alias("v"))
        else:
            out = joined.select(F.when(v == F.col("m"), u).otherwise(v).alias("u"), F.col("m").alias("v"))
        return out.where("u > v").distinct()

    first, second = F.col(a).cast("long"), F.col(b).cast("long")
    links = edges.where(first != second).select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).distinct()
    links = stored(links, "links")
    before = None
    while True:
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        links = stored(star(star(links, True), False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

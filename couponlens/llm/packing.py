"""Best-fit packing of token pieces into sequences, planned on the histogram of their lengths.

Patterns of up to four pieces that nearly fill a sequence are enumerated; non-negative least squares fits how often each
is used to the histogram; the counts are rounded down, and best fit places what remains, again by counts of equal
lengths. The plan says which ranks of each length go where, so the pieces themselves are only joined to it: the driver
sees a histogram of at most `capacity` rows, never the pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.bpe import drop_encoders, encoded, vocabulary
from couponlens.llm.common import partitions, rows, stored, texts_only


def pieces(docs: DataFrame, vocab_path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", release: bool = False) -> DataFrame:
    """The ids of each text and ``end_id``, cut into pieces of ``capacity`` where longer: doc_id, piece, start, length, ids_crc32."""
    packed = vocabulary(vocab_path)

    def run(batches):
        for keys, ids, begins in encoded(batches, packed):
            sizes = np.diff(begins) + 1
            ids = np.insert(ids, begins[1:], end_id).astype("<u4")
            at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            a = at[row] + start
            crcs = [zlib.crc32(ids[i:j]) for i, j in zip(a.tolist(), (a + length).tolist())]
            yield rows(doc_id=keys.take(pa.array(row)), piece=pa.array(piece, pa.int32()), start=start, length=length, ids_crc32=pa.array(crcs, pa.int64()))
        if release:
            drop_encoders()

    return texts_only(docs, key, text).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(histogram: dict[int, int], capacity: int, most: int = 40_000) -> list[tuple[int, ...]]:
    """Few-piece patterns over the lengths that occur, in descending order within a pattern: full single pieces; pairs
    whose second piece is the longest that still fits; the same with the rest filled by a third and a fourth piece; and
    k equal pieces. The number of lengths, hence of patterns, is bounded by the capacity."""
    lengths = sorted(histogram)

    def fitting(room: int) -> int | None:
        i = bisect.bisect_right(lengths, room)
        return lengths[i - 1] if i else None

    out = set()
    common = sorted(lengths, key=lambda x: (-histogram[x], x))[:8]
    for a in lengths:
        out.add((a,) * max(1, min(4, capacity // a)))
        b = fitting(capacity - a)
        if b is None:
            continue
        out.add(tuple(sorted((a, b), reverse=True)))
        for b in {*common, *(fitting(max(0, (capacity - a) // k)) for k in (2, 3)), fitting(capacity - a)} - {None}:
            if a + b > capacity:
                continue
            c = fitting(capacity - a - b)
            if c is None:
                continue
            out.add(tuple(sorted((a, b, c), reverse=True)))
            if d := fitting(capacity - a - b - c):
                out.add(tuple(sorted((a, b, c, d), reverse=True)))
    best = sorted(out, key=lambda p: (capacity - sum(p), len(p), p))
    return best[:most]


def fit_counts(choices: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 12) -> np.ndarray:
    """Non-negative least squares by coordinate descent: repeat counts whose pieces come nearest to the histogram."""
    rest = {a: float(n) for a, n in histogram.items()}
    columns = [tuple((a, p.count(a)) for a in dict.fromkeys(p)) for p in choices]
    norms = [sum(k * k for _, k in c) for c in columns]
    counts = [0.0] * len(choices)
    for _ in range(sweeps):
        moved = 0.0
        for i, column in enumerate(columns):
            step = sum(k * rest[a] for a, k in column) / norms[i]
            step = max(step, -counts[i])
            if step:
                counts[i] += step
                moved = max(moved, abs(step))
                for a, k in column:
                    rest[a] -= k * step
        if moved < 0.25:
            break
    return np.array(counts)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths of the pieces in their order, how many such sequences)."""
    left = {a: n for a, n in histogram.items() if n > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    if capacity in left:
        out.append(((capacity,), left.pop(capacity)))
    choices = patterns(left, capacity)
    counts = fit_counts(choices, left)
    for i in sorted(range(len(choices)), key=lambda i: (capacity - sum(choices[i]), -counts[i], choices[i])):
        p, need = choices[i], defaultdict(int)
        if capacity - sum(p) > capacity // 512:
            continue  # wide gaps are left to best fit
        for a in p:
            need[a] += 1
        n = min(int(counts[i]), *(left[a] // k for a, k in need.items()))
        if n > 0:
            out.append((p, n))
            for a, k in need.items():
                left[a] -= n * k
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # free space: open sequences of the same content
    free: list[int] = []

    def put(space: int, content: tuple[int, ...], n: int) -> None:
        if space not in room or not room[space]:
            bisect.insort(free, space)
        room[space][content] = room[space].get(content, 0) + n

    for a in sorted(left, reverse=True):
        n = left[a]
        while n:
            i = bisect.bisect_left(free, a)
            if i < len(free):
                space = free[i]
                content, m = next(iter(room[space].items()))
                take = min(n, m)
                if take == m:
                    del room[space][content]
                    if not room[space]:
                        free.pop(i)
                else:
                    room[space][content] = m - take
                put(space - a, content + (a,), take)
                n -= take
                continue
            each = capacity // a
            if n >= each:
                put(capacity - a * each, (a,) * each, n // each)
                n %= each
            else:
                put(capacity - a * n, (a,) * n, 1)
                n = 0
    out += [(content, n) for held in room.values() for content, n in held.items()]
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> list[np.ndarray]:
    """The plan as sorted runs of ranks: length, first rank of the run, first sequence, offset. Rank r of a run that
    begins at rank f is placed in sequence ``sequence + (r - f)``."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for content, n in planned:
        offset = 0
        for a in content:
            out.append((a, used[a], sequence, offset))
            used[a] += n
            offset += a
        sequence += n
    out.sort()
    return [np.array(x, np.int64) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def pack_documents(docs: DataFrame, vocab_path: str, end_id: int, capacity: int = 4096, key: str = "doc_id", text: str = "text", release: bool = False) -> DataFrame:
    """Places every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Rows with the same id are packed each; an empty table gives no rows. Ranks
    among equal lengths are counted within buckets of pieces and shifted by the totals of the buckets before, so one
    very common length is spread over many tasks. With ``release`` workers give up their encoders after each task, for
    jobs whose other stages need the memory.
    """
    spark = docs.sparkSession
    held = stored(pieces(docs, vocab_path, end_id, capacity, key, text, release), "pieces")
    buckets = max(64, partitions(spark))
    dealt = held.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    totals = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r.length: r.n for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = slots(plan(histogram, capacity))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(inside) - 1).join(bases, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches):
        sizes, firsts, sequences, offsets = runs
        keys = sizes << 44 | firsts
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            yield rows(
                doc_id=b.column(0), piece=b.column(1), start=b.column(2), length=b.column(3), ids_crc32=b.column(4),
                sequence_id=sequences[at] + rank - firsts[at], offset=offsets[at])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)

"""Near-duplicate lines: MinHash signatures of character shingles, banding, exact verification, one line per component."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from couponlens.llm.common import RunHash, among_bits, bits_of, chunks, distinct, mix64, rows, stored, text_chunks, trimmed
from couponlens.llm.groups import MARKS, dealt, distinct_parts, marks, similar_components

SHINGLE = 5  # characters
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8 ** 6) ** 27 = 0.9997, one of 0.15 with 0.0003.
BANDS, ROWS = 27, 6
#: The minima are taken after each of these multiplications, one upon the other.
_STEPS = {bits: (mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) >> np.uint64(64 - bits)).astype(f"u{bits // 8}") | 1 for bits in (16, 32)}
#: Minima of 16 bits tell sets of up to _NARROW apart, and those of 32 bits tell sets of more than _WIDE; similar sets
#: are both of one kind, since _WIDE is less than 0.8 of _NARROW.
_NARROW, _WIDE = 5120, 4000
_BLOCK = 1 << 17  # characters
_NO_ID = -(1 << 63)
_END = 10


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lines, each followed by a line feed; where each line begins, and the end."""
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    return codes, np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])]).astype(np.int64)


def _nodes(lines: list[str]) -> np.ndarray:
    """Identity of each line."""
    return np.fromiter(map(xxh3_64_intdigest, lines), np.uint64, len(lines)).view(np.int64)


def _inside(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At which places of ``codes``, but the last, a shingle of a line begins, and how many each line has."""
    inside = np.ones(len(codes), bool)
    for k in range(1, SHINGLE + 1):
        inside[np.maximum(begins[1:] - begins[0] - k, 0)] = False
    return inside[: 1 - SHINGLE], np.maximum(np.diff(begins) - SHINGLE, 0)


def _with_short(lines: list[str], hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adds the lines that are shorter than a shingle, each as the one member of its set."""
    if len(short := np.nonzero(sizes == 0)[0]):
        own = _nodes([lines[k] for k in short.tolist()]).view(np.uint64).astype(hashes.dtype)
        hashes = np.insert(hashes, (np.cumsum(sizes) - sizes)[short], own)
        sizes = np.maximum(sizes, 1)
    return hashes, sizes


def line_sets(bodies: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of lines in UTF-8."""
    out = []
    for a, b in chunks([len(x) for x in bodies]):
        lines = [x.decode() for x in bodies[a:b]]
        codes, begins = _codes(lines)
        at, sizes = _inside(codes, begins)
        values = mix64(codes.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
        n = max(len(codes) - SHINGLE + 1, 0)
        hashes = values[:n].copy()
        for j in range(1, SHINGLE):
            hashes *= np.uint64(RunHash.BASE)
            hashes += values[j : n + j]
        out += distinct_parts(*_with_short(lines, mix64(hashes[at]), sizes))
    return out


def line_marks(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Marks of lines in UTF-8 (see `groups`), and their number of shingles, repeated ones included."""
    packed, most = [np.zeros((0, MARKS // 8), np.uint8)], [np.zeros(0, np.int64)]
    for a, b in chunks([len(x) + MARKS for x in bodies]):
        lines = [x.decode() for x in bodies[a:b]]
        codes, begins = _codes(lines)
        at, sizes = _inside(codes, begins)
        hashes = _quick_hashes(codes)[at] if sizes.any() else np.zeros(0, np.uint32)
        hashes, sizes = _with_short(lines, hashes, sizes)
        packed.append(marks(hashes, sizes))
        most.append(sizes)
    return np.concatenate(packed), np.concatenate(most)


def _quick_hashes(codes: np.ndarray) -> np.ndarray:
    """32-bit hashes of the shingles at all places of ``codes``, for signatures."""
    mixed = codes * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    n = len(codes) - SHINGLE + 1
    out = mixed[:n].copy()
    for j in range(1, SHINGLE):
        out *= np.uint32(0x01000193)
        out += mixed[j : n + j]
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        out ^= out >> np.uint32(shift)
        out *= np.uint32(factor)
    out ^= out >> np.uint32(16)
    return out


def _bands(lines: list[str], node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Band keys and the line of each; none for a line that is shorter than a shingle, as it only equals itself."""
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    narrow, wide = length >= SHINGLE, length >= _WIDE + SHINGLE
    for k in np.nonzero(wide)[0].tolist():
        n = len(distinct(_quick_hashes(_codes([lines[k]])[0][:-1])))
        narrow[k], wide[k] = n <= _NARROW, n > _WIDE
    for bits, some in ((16, narrow), (32, wide)):
        if some.any():
            own = lines if some.all() else [x for x, ok in zip(lines, some.tolist()) if ok]
            yield _band_keys(own, bits).ravel(), np.repeat(node[some], BANDS)


def _band_keys(lines: list[str], bits: int) -> np.ndarray:
    """BANDS keys of each line, from the minima of its shingles under BANDS * ROWS multiplications. Lines are taken in blocks
    that stay in a processor's cache."""
    codes, begins = _codes(lines)
    minima = np.empty((BANDS * ROWS, len(lines)), f"u{bits // 8}")
    for a, b in chunks(np.diff(begins).tolist(), _BLOCK):
        part = codes[begins[a] : begins[b]]
        at, n = _inside(part, begins[a : b + 1])
        hashes = (_quick_hashes(part)[at] >> np.uint32(32 - bits)).astype(minima.dtype)
        np.maximum(hashes, 1, out=hashes)  # zero would stay the least
        first = np.cumsum(n) - n
        for step, least in zip(_STEPS[bits], minima):
            np.multiply(hashes, step, out=hashes)
            np.minimum.reduceat(hashes, first, out=least[a:b])
    keys = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), BANDS * bits + band, np.uint64)
        for r in range(ROWS):
            key *= np.uint64(RunHash.BASE)
            key += minima[band * ROWS + r]
            key ^= key >> np.uint64(29)
        keys[:, band] = mix64(key)
    return keys


def _lines(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines that are not blank, without outer white space; the text and the place in it of each."""
    split = [[(k, s) for k, x in enumerate(t.split("\n")) if (s := x.strip())] for t in texts]
    n = [len(x) for x in split]
    return [s for x in split for _, s in x], np.repeat(np.arange(len(texts)), n), np.array([k for x in split for k, _ in x], np.int64)


def _own_lines(batches) -> Iterator[tuple[list[str], np.ndarray]]:
    """The distinct lines of a partition, and their identities."""
    seen = np.zeros(0, np.int64)
    for _, texts in text_chunks(batches):
        lines = list(dict.fromkeys(_lines(texts)[0]))
        node = _nodes(lines)
        new = ~np.isin(node, seen)
        if new.any():
            lines, node = [x for x, ok in zip(lines, new.tolist()) if ok], node[new]
            seen = np.concatenate([seen, node])
            yield lines, node


def _banded(batches):
    return dealt(pair for lines, node in _own_lines(batches) for pair in _bands(lines, node))


def _placed(wanted: Callable[[], np.ndarray]):
    """Task over rows (doc, text, mark): a row for each line, with its body where it can be wanted, once in a partition.
    ``wanted`` gives the bits of `bits_of`."""

    def run(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            at = 0
            for keys, texts in text_chunks([batch]):
                lines, of, place = _lines(texts)
                if lines:
                    node, body = _nodes(lines), np.full(len(lines), None, object)
                    few = np.nonzero(among_bits(node, wanted()))[0]
                    few = few[np.unique(node[few], return_index=True)[1]]
                    few = few[~np.isin(node[few], seen)]
                    seen = np.concatenate([seen, node[few]])
                    for k in few.tolist():
                        body[k] = lines[k].encode()
                    mark = batch.column(2).slice(at, len(texts))
                    yield rows(node=node, doc=keys.take(pa.array(of)), mark=mark.take(pa.array(of)), line=place, body=pa.array(body, pa.binary()))
                at += len(texts)

    return run


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keeps one line of each group of lines that are linked, directly or through others, by a Jaccard similarity of 0.8
    or more of their five-character shingles: the one in the document of the smallest id, and there the first.

    Returns every row: ``text`` with the other lines cut out, ``n_lines``, ``n_removed``, and ``rest``, a struct of the
    row's other columns. Outer white space of a line does not count. Blank lines are no lines and stay; a line shorter
    than a shingle only equals itself; a null or empty text has no lines and comes back empty; a document may lose all its
    lines but stays as a row; a null id comes before all others; rows that repeat id and text are one document and get the
    same result; texts that share an id are told apart, and ordered, by their hashes; an empty table gives no rows.
    """
    whole = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("rest")).withColumn("mark", F.xxhash64("text"))
    plain = whole.select("doc", "text", "mark")
    index = plain.select("doc", "text").mapInArrow(trimmed(_banded), "bucket int, held binary")

    placed = plain  # until the wanted lines are known, whose bodies come in the same pass

    def bodies(wanted: DataFrame) -> DataFrame:
        nonlocal placed
        wanted = stored(wanted, "wanted")
        bits = wanted.sparkSession.sparkContext.broadcast(bits_of(wanted, "node"))
        every = plain.mapInArrow(trimmed(_placed(lambda: bits.value)), "node long, doc long, mark long, line long, body binary")
        placed = stored(every, "lines")
        return placed.select("node", "body").where("body is not null").join(wanted, "node").dropDuplicates(["node"])

    parts = similar_components(index, bodies, line_sets, line_marks)
    place = F.struct("doc", "mark", "line")
    twice = placed.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    several = twice.join(parts, "node", "full_outer").select("node", F.coalesce("component", "node").alias("component"))
    groups = stored(placed.select("node", "doc", "mark", "line").join(several, "node").drop("node"), "groups")
    kept = groups.groupBy("component").agg(F.min(place).alias("kept"))
    dropped = groups.join(kept, "component").where(place != F.col("kept"))
    dropped = dropped.groupBy("doc", "mark").agg(F.collect_set("line").alias("lines"))  # rows that repeat are one document

    def remove(batches):
        for batch in batches:
            out, n_lines, n_removed = [], [], []
            for t, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                gone, split = set(lines or ()), t.split("\n")
                real = [x != "" and not x.isspace() for x in split]
                out.append("\n".join([x for k, x in enumerate(split) if k not in gone]) if gone else t)
                n_lines.append(sum(real))
                n_removed.append(sum(k < len(real) and real[k] for k in gone))
            yield rows(
                text=pa.array(out, pa.string()), n_lines=pa.array(n_lines, pa.int64()), n_removed=pa.array(n_removed, pa.int64()), rest=batch.column(2))

    joined = whole.join(dropped, ["doc", "mark"], "left").select("text", "lines", "rest")
    rest = joined.schema["rest"].dataType.simpleString()
    return joined.mapInArrow(trimmed(remove), f"text string, n_lines long, n_removed long, rest {rest}")

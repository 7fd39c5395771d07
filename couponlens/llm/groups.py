"""Connected components of a set similarity of 0.8 or more, from inverted lists and without writing out a list's pairs.

Every list first links its members to one of them, its centre, the member made up of the most common values. A list is
settled when all of these links hold. The members of the other lists form families, one for each centre; two members
that are similar share a list and so a family. The members outside a family's largest component are compared, in blocks,
with each other and with that component: first by marks of fixed size that rule out most pairs and lose none, then on the
full sets; no more than spanning links leave a task. Within a pair, 48 bits of a hash stand for a member of a set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.common import chunks, components, rows, stored, trimmed

K = 48
#: Shared values that the union's bottom-k has at least where the similarity is 0.8: fewer than 20 of 48 have a
#: probability under 1e-8.
LEAST = 20
PAD = np.uint64(0xFFFFFFFFFFFFFFFF)
SLOTS = 1 << 18  # counters of how common a value is; the table has this size for any corpus
MARKS = 1024  # bits that stand for a set before its members are made
_REST, _MAIN = 512, 2048  # members of a family's smaller parts, and of its largest part, that a task compares
_SLICE = 1024  # values that a comparison holds as a matrix at once
_ROWS = 256  # members that are compared with all others at once
_DEALT = 12  # leading bits of a value that name its bucket
_HELD = 1 << 20  # pairs of value and node that a task holds before it deals or lists them


def sketch(values: np.ndarray) -> bytes:
    """The K smallest of a set's sorted hashes."""
    out = np.full(K, PAD, np.uint64)
    out[: min(K, len(values))] = values[:K]
    return out.tobytes()


def sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), K)


def union_estimate(sa: np.ndarray, na: np.ndarray, sb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether pairs can reach a similarity of 0.8, by the bottom-k sketch of their union; exact where it holds the union."""
    ok = np.zeros(len(sa), bool)
    for at in range(0, len(sa), 1 << 15):
        cut = slice(at, at + (1 << 15))
        both = np.sort(np.concatenate([sa[cut], sb[cut]], axis=1), axis=1)
        real = both != PAD
        shared = np.zeros(both.shape, bool)
        shared[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
        place = np.cumsum(real & ~shared, axis=1)
        whole = (na[cut] <= K) & (nb[cut] <= K)
        ok[cut] = np.where(whole, 100 * shared.sum(axis=1) >= 80 * place[:, -1], (shared & (place <= K)).sum(axis=1) >= LEAST)
    return ok


def how_common(values: DataFrame, column: int) -> np.ndarray:
    """How often values fall into each of SLOTS counters, for an order of rarity that all tasks share. ``column`` holds
    sets as bytes."""

    def count(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(column).to_pylist()), np.uint64)
            slot, n = np.unique(x[x != PAD] & np.uint64(SLOTS - 1), return_counts=True)
            yield rows(slot=slot.astype(np.int32), n=n.astype(np.int64))

    found = values.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 2").toPandas()
    out = np.zeros(SLOTS, np.int64)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return out


def _numbered(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """48 bits of each hash after the number of its part, for one sort of all parts; no more than 65,536 parts."""
    return np.repeat(np.arange(len(sizes), dtype=np.uint64) << np.uint64(48), sizes) | (hashes >> np.uint64(16))


def distinct_parts(hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of consecutive parts, of which the upper 48 bits count."""
    keys = hashes & ~np.uint64(0xFFFF)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    for a, b in zip(begins.tolist(), ends.tolist()):
        keys[a:b].sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new[begins[sizes > 0]] = True
    keys, ends = keys[new], np.concatenate([[0], np.cumsum(new)])[ends].tolist()
    return [keys[a:b] for a, b in zip([0, *ends], ends)]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes the sets of each pair have in common, of which the upper 48 bits count."""
    out = []
    for a, b in chunks([len(x) + len(y) + 64 for x, y in zip(left, right)]):  # at most 31,250 pairs
        pairs = left[a:b], right[a:b]
        keys = np.concatenate([_numbered(np.concatenate(side), np.array([len(x) for x in side])) for side in pairs])
        keys.sort(kind="stable")  # merges the two sorted sides
        both = keys[1:][keys[1:] == keys[:-1]]
        out.append(np.bincount((both >> np.uint64(48)).astype(np.int64), minlength=len(pairs[0])))
    return np.concatenate(out)


def dealt(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Pairs (value, node), both of 64 bits, as rows (bucket, held) that hold many pairs of one bucket each, so that the
    shuffle moves few rows."""

    def rows_of(held):
        value, node = (np.concatenate([x[k] for x in held]).view(np.int64) for k in (0, 1))
        bucket = (value.view(np.uint64) >> np.uint64(64 - _DEALT)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        n = np.bincount(bucket, minlength=1 << _DEALT)
        some = np.nonzero(n)[0].astype(np.int32)
        ends = np.concatenate([[0], 16 * np.cumsum(n[some])]).astype(np.int32)
        body = pa.py_buffer(np.stack([value[order], node[order]], axis=1))
        return rows(bucket=some, held=pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), body]))

    held, n = [], 0
    for value, node in pairs:
        held.append((value, node))
        n += len(value)
        if n >= _HELD:
            yield rows_of(held)
            held, n = [], 0
    if n:
        yield rows_of(held)


def _listed(batches):
    """Task over rows (bucket, held) ordered by bucket: rows (value, node, centre, larger) of the lists of two nodes and more."""
    held, n = [], 0
    for batch in (x.slice(k, 256) for x in batches for k in range(0, x.num_rows, 256)):
        bucket, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        if n >= _HELD and (new := bucket != held[-1][0]).any():
            at = int(new.argmax())  # all buckets before this row are whole
            yield _lists([*(x for _, x in held), *raw[:at]])
            held, n, bucket, raw = [], 0, bucket[at:], raw[at:]
        held += zip(bucket.tolist(), raw)
        n += sum(map(len, raw)) // 16
    if held:
        yield _lists([x for _, x in held])


def _lists(raw: list[bytes]) -> pa.RecordBatch:
    value, node = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2).T
    # one plain sort by the leading bits of each value, with its place in the others, finds those that may come twice
    bits = np.uint64(len(value).bit_length())
    keys = (value.view(np.uint64) >> bits << bits) | np.arange(len(value), dtype=np.uint64)
    keys.sort()
    same = keys[1:] >> bits == keys[:-1] >> bits
    keys = keys[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    order = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    order = order[np.lexsort((node[order], value[order]))]
    value, node = value[order], node[order]
    new = np.ones(len(value), bool)  # a node that comes twice counts once
    new[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
    value, node = value[new], node[new]
    begins = np.nonzero(np.concatenate([[True], value[1:] != value[:-1]])[: len(value)])[0]
    size = np.diff([*begins, len(value)])
    each = np.repeat(size, size)
    centre = np.repeat(node[begins + size - 1], size)
    listed = each > 1
    return rows(value=value[listed], node=node[listed], centre=centre[listed], larger=each[listed] > 2)


Sets = Callable[[list[bytes]], list[np.ndarray]]
#: Bodies to the packed bits of each one's members (MARKS / 8 bytes), and a bound on the number of its members.
Marks = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def marks(slots: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Packed bits of consecutive parts; ``slots`` are any hashes of their members."""
    out = np.zeros((len(sizes), MARKS), bool)
    out[np.repeat(np.arange(len(sizes)), sizes), slots & slots.dtype.type(MARKS - 1)] = True
    return np.packbits(out, axis=1)


def may_be_similar(differ: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether sets with so many different marks and at most so many members in all can reach a similarity of 0.8. Each
    different mark is a member of one set alone, and of s members in all s / 9 may be such; so no similar pair is lost."""
    return 9 * differ <= most


def stored_marks(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Marks of bodies that are the sorted hashes themselves, and their sizes."""
    sizes = np.array([len(x) // 8 for x in bodies], np.int64)
    parts = [marks(np.frombuffer(b"".join(bodies[a:b]), np.uint64) >> np.uint64(16), sizes[a:b]) for a, b in chunks((8 * sizes + MARKS).tolist())]
    return np.concatenate([np.zeros((0, MARKS // 8), np.uint8), *parts]), sizes


def exact_links(pairs: DataFrame, bodies: DataFrame, signs: DataFrame, sets_of: Sets) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of 0.8 or more. Bodies are brought to the pairs that their
    marks allow."""

    def allowed(batches):
        for batch in batches:
            packed = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (2, 3)]
            differ = np.bitwise_count(packed[0] ^ packed[1]).sum(axis=1, dtype=np.int64)
            yield batch.select([0, 1]).filter(pa.array(may_be_similar(differ, batch.column(4).to_numpy())))

    def exact(batches):
        for batch in (x.slice(i, 1000) for x in batches for i in range(0, x.num_rows, 1000)):
            body = dict(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())) | dict(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()))
            sets = dict(zip(body, sets_of([*body.values()])))  # a node comes in several pairs
            x, y = ([sets[node] for node in batch.column(k).to_pylist()] for k in (0, 1))
            shared = shared_counts(x, y)
            ok = 100 * shared >= 80 * (np.array([len(s) + len(t) for s, t in zip(x, y)]) - shared)
            yield batch.select([0, 1]).filter(pa.array(ok))

    def sides(table: DataFrame, *columns: str) -> list[DataFrame]:
        return [table.select(F.col("node").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in columns]) for k in "ab"]

    a, b = sides(signs, "marks", "most")
    pairs = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "marks_a", "marks_b", (F.col("most_a") + F.col("most_b")).alias("most"))
    pairs = pairs.mapInArrow(trimmed(allowed), "a long, b long")
    a, b = sides(bodies, "body")
    # by centre at last, so that a centre's set is made once for many pairs
    return pairs.join(b, "b").join(a, "a").select("a", "b", "body_a", "body_b").mapInArrow(trimmed(exact), "a long, b long")


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each component of n places under the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_between(part: np.ndarray, left: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets in different parts with a similarity of 0.8 or more, one of each pair in the left block and one in the
    right; ``left`` marks the left block. Overlaps are counted exactly, by products over the values that occur twice."""
    n, size = len(sets), np.array([len(s) for s in sets])
    parts, count = np.unique(part, return_counts=True)
    few = np.nonzero(part != parts[count.argmax()])[0]  # every pair of different parts has a member here
    which, different = pd.factorize(np.concatenate(sets))
    row = np.repeat(np.arange(n), size)
    often = np.bincount(which) > 1
    code = np.cumsum(often) - 1
    row, which = row[often[which]], code[which[often[which]]]
    order = np.argsort(which, kind="stable")
    row, which = row[order], which[order]
    overlap = np.zeros((len(few), n), np.float32)
    for low in range(0, int(often.sum()), _SLICE):
        a, b = np.searchsorted(which, [low, low + _SLICE])
        matrix = np.zeros((n, min(_SLICE, int(which[-1]) + 1 - low)), np.float32)
        matrix[row[a:b], which[a:b] - low] = 1
        overlap += matrix[few] @ matrix.T
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(few), _ROWS):
        own = few[at : at + _ROWS]
        both = size[own][:, None] + size[None, :]
        i, j = np.nonzero((180 * overlap[at : at + _ROWS].astype(np.int64) >= 80 * both) & _apart(part, left, own))
        found.append((own[i], j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _apart(part: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether sets ``own`` and all sets are in different parts, and in different blocks if there are two."""
    return (part[own][:, None] != part[None, :]) & ((left[own][:, None] != left[None, :]) | left.all())


def _meeting(part: np.ndarray, left: np.ndarray, packed: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Places of the sets that the marks allow to be similar to one in another part and in the other block."""
    parts, count = np.unique(part, return_counts=True)
    few = np.nonzero(part != parts[count.argmax()])[0]
    matrix = np.unpackbits(packed, axis=1).astype(np.float32)
    size = matrix.sum(axis=1)
    met = np.zeros(len(part), bool)
    for at in range(0, len(few), _ROWS):
        own = few[at : at + _ROWS]
        differ = size[own][:, None] + size[None, :] - 2 * (matrix[own] @ matrix.T)
        ok = may_be_similar(differ, (most[own][:, None] + most[None, :]).astype(np.float32)) & _apart(part, left, own)
        met |= ok.any(axis=0)
        met[own[ok.any(axis=1)]] = True
    return np.nonzero(met)[0]


def _whole_blocks(work):
    """Task over rows (centre, i, j, ...) ordered by these three: ``work`` gets tables of whole block pairs and where each
    begins, and the end."""

    def run(batches):
        held = None
        for batch in (x.slice(k, 2000) for x in batches for k in range(0, x.num_rows, 2000)):
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            edges = _edges(held)
            if len(edges) > 2:
                yield work(held, edges[:-1])
                held = held.slice(int(edges[-2]))
        if held is not None and held.num_rows:
            yield work(held, _edges(held))

    return trimmed(run)


def _edges(table: pa.Table) -> np.ndarray:
    centre, i, j = (table.column(c).to_numpy() for c in range(3))
    new = np.nonzero((centre[1:] != centre[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))[0] + 1
    return np.concatenate([[0], new, [len(centre)]]).astype(np.int64)


def _meetings(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
    """Rows (centre, i, j, block, node, part, marks, most) to those whose marks allow a link within their pair of blocks."""
    i, block, part, most = (table.column(c).to_numpy() for c in (1, 3, 5, 7))
    end = int(edges[-1])
    packed = np.frombuffer(b"".join(table.column(6).slice(0, end).to_pylist()), np.uint8).reshape(end, MARKS // 8)
    met = [np.zeros(0, np.int64)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a > 1 and (part[a:b] != part[a]).any():
            met.append(a + _meeting(part[a:b], block[a:b] == i[a], packed[a:b], most[a:b]))
    out = table.select(range(6)).take(pa.array(np.concatenate(met)))
    return rows(**{name: out.column(name).combine_chunks() for name in out.column_names})


def _spanning_links(sets_of: Sets):
    """Rows (centre, i, j, block, node, part, body) to spanning links (a, b)."""

    def work(table, edges):
        i, block, node, part = (table.column(c).to_numpy() for c in (1, 3, 4, 5))
        every = sets_of(table.column(6).slice(0, int(edges[-1])).to_pylist())
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > 1 and (part[a:b] != part[a]).any():
                x, y = links_between(part[a:b], block[a:b] == i[a], every[a:b])
                root = spanning(b - a, x, y)
                linked = np.nonzero(root != np.arange(b - a))[0]
                out_a.append(node[a:b][linked])
                out_b.append(node[a:b][root[linked]])
        return rows(a=np.concatenate(out_a), b=np.concatenate(out_b))

    return work


def _signs(bodies: DataFrame, sets_of: Sets, marks_of: Marks | None) -> DataFrame:
    """Marks of all bodies: node, marks, most. Without ``marks_of`` they are those of the sets, whose sketches (sig) come too."""

    def run(batches):
        for batch in (x.slice(k, 1000) for x in batches for k in range(0, x.num_rows, 1000)):
            own = batch.column(1).to_pylist()
            sets = None if marks_of else sets_of(own)
            packed, most = marks_of(own) if marks_of else stored_marks([s.tobytes() for s in sets])
            more = {} if marks_of else {"sig": pa.array([sketch(s) for s in sets], pa.binary())}
            yield rows(node=batch.column(0), marks=pa.array([x.tobytes() for x in packed], pa.binary()), most=pa.array(most, pa.int64()), **more)

    return bodies.select("node", "body").mapInArrow(trimmed(run), "node long, marks binary, most long" + ("" if marks_of else ", sig binary"))


def _likely(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches allow a similarity of 0.8."""

    def judge(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_numpy() for c in range(4))
            ok = union_estimate(sketches(batch.column(4)), na, sketches(batch.column(5)), nb)
            ok &= 100 * np.minimum(na, nb) >= 80 * np.maximum(na, nb)
            yield rows(a=a[ok], b=b[ok])

    left, right = (signs.select(F.col("node").alias(k), F.col("most").alias(f"n{k}"), F.col("sig").alias(f"s{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(judge, "a long, b long")


def similar_components(index: DataFrame, bodies_of: Callable[[DataFrame], DataFrame], sets_of: Sets, marks_of: Marks | None = None) -> DataFrame:
    """Components (node, component) over all pairs of nodes that share a list and whose sets are similar to 0.8 or more.

    ``index`` has rows (bucket, held) as `dealt` makes them of values and nodes, or (value, node, weight, need): the greatest
    member, or the one of the greatest weight, is a list's centre, and a node that has fewer than ``need`` lists with others
    has no similar one. ``bodies_of`` takes a table of nodes and returns (node, body), ``sets_of`` makes sorted 64-bit hashes
    of bodies and ``marks_of`` their marks; without it, these are made of the sets, and the sketches of the unions sort out
    pairs before the full sets meet. Nodes without a link are not in the result.
    """
    if "held" in index.columns:
        lists = index.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(_listed), "value long, node long, centre long, larger boolean")
        lists = stored(lists.select("value", "node", F.lit(1).alias("need"), "centre", "larger"), "lists")
    else:
        within = Window.partitionBy("value")
        ends = {"low": F.min("node").over(within), "high": F.max("node").over(within)}
        found = stored(index.withColumns(ends).where("low != high").drop("low", "high"), "found")
        enough = found.groupBy("node").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("node")
        lists = found.join(enough, "node", "left_semi").withColumns({**ends, "centre": F.max(F.struct("weight", "node")).over(within)["node"]})
        # the link to the centre settles a list of two
        larger = F.max((F.col("node") != F.col("low")) & (F.col("node") != F.col("high"))).over(within)
        lists = lists.where("low != high").withColumn("larger", larger)
        lists = stored(lists.select("value", "node", "need", "centre", "larger"), "lists")
    bodies = stored(bodies_of(lists.select("node").distinct()), "bodies")

    likely = lists.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    signs = stored(_signs(bodies, sets_of, marks_of), "signs")
    if not marks_of:
        likely = _likely(likely, signs)
    links = stored(exact_links(likely, bodies, signs, sets_of), "verified")
    parts = stored(components(links), "parts")

    linked = links.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.lit(True).alias("ok"))
    lists = lists.where("larger")
    unsettled = lists.where("node != centre").join(linked, ["centre", "node"], "left").where("ok is null").select("value").distinct()
    family = lists.join(unsettled, "value", "left_semi").groupBy("centre", "node").agg(F.count("*").alias("n"), F.max("need").alias("need"))
    # a pair that is similar has `need` lists in common, so either may leave the families of nearly half as many
    so_far = F.sum("n").over(Window.partitionBy("node").orderBy("n", "centre").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    family = family.withColumn("so_far", so_far).where("2 * so_far >= need").join(parts, "node", "left")
    family = family.select("centre", "node", F.coalesce("component", "node").alias("part"))
    of = Window.partitionBy("centre")
    counted = family.withColumn("n", F.count("*").over(Window.partitionBy("centre", "part")))
    counted = counted.withColumn("main", F.max(F.struct("n", "part")).over(of)["part"]).withColumn("rest", F.col("part") != F.col("main"))
    counted = counted.withColumn("any", F.max("rest").over(of)).where("any")
    nth = F.row_number().over(Window.partitionBy("centre", "rest").orderBy("part", "node")) - 1
    # blocks of the largest part are numbered -1, -2, ...; they meet the blocks of the rest, never each other
    numbered = counted.withColumn("nth", nth).withColumn("block", F.floor(F.when(F.col("rest"), F.col("nth") / _REST).otherwise(-1 - F.floor(F.col("nth") / _MAIN))).cast("int"))
    numbered = numbered.withColumn("top", F.max("block").over(of)).withColumn("bottom", F.min("block").over(of))
    others = F.when(F.col("rest"), F.sequence("bottom", "top")).otherwise(F.sequence(F.lit(0), "top"))
    place = ["centre", "i", "j"]
    dealt = numbered.withColumn("other", F.explode(others)).join(signs.select("node", "marks", "most"), "node")
    dealt = dealt.select("centre", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "part", "marks", "most")
    dealt = dealt.repartition(*place).sortWithinPartitions(*place)
    # only members that may be similar to another one bring their bodies
    met = stored(dealt.mapInArrow(_whole_blocks(_meetings), "centre long, i int, j int, block int, node long, part long"), "meetings")
    met = met.join(bodies, "node").select(*place, "block", "node", "part", "body").repartition(*place).sortWithinPartitions(*place)
    more = stored(met.mapInArrow(_whole_blocks(_spanning_links(sets_of)), "a long, b long"), "more")
    if more.isEmpty():
        return parts
    return _merged(parts, more)


def _merged(parts: DataFrame, more: DataFrame) -> DataFrame:
    """Components (node, component) that further links (a, b) make of those there are; the links between them are few."""
    ends = [parts.select(F.col("node").alias(k), F.col("component").alias(f"of_{k}")) for k in "ab"]
    between = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    new = stored(components(between), "merged")
    alone = new.join(parts, "node", "left_anti").select("node", F.col("node").alias("component"))
    new = new.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return parts.unionAll(alone).join(new, "component", "left").select("node", F.coalesce("least", "component").alias("component"))

"""Near-duplicate vectors by the epsilon grid order join.

Unit vectors are turned to principal axes and sorted by the cells of a grid of width epsilon on the leading ones. The
sorted sequence is cut into blocks, the blocks into a tree of intervals with bounding boxes. Pairs of intervals are
followed down the tree, level by level as joins, and dropped when their boxes are further apart than epsilon; inside a
task the pair of blocks is halved on in the same way before the vectors meet. Only counts and spanning links leave a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.common import components, partitions, rows, stored
from couponlens.llm.groups import spanning

AXES = 8  # leading axes of the grid
BOX = 16  # leading axes of the bounding boxes
BLOCK = 2048  # vectors in a block
LEAF = 256  # vectors that are compared with as many others without further halving
FAN = 8  # intervals that an interval one level up holds
SAMPLE = 20_000  # vectors that the principal axes are fitted on; they decide about speed, not about links


def _matrices(column: pa.Array):
    """(row numbers, matrix) for each length of vector, rows that hold null or non-finite numbers or only zeros left out."""
    sizes = np.array([-1 if x is None else x for x in column.value_lengths().to_pylist()])
    flat = column.flatten().to_numpy(zero_copy_only=False)  # null numbers become NaN; null rows hold none
    begins = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for n in np.unique(sizes[sizes > 0]):
        at = np.nonzero(sizes == n)[0]
        x = flat[begins[at][:, None] + np.arange(n)]
        norm = np.linalg.norm(x.astype(np.float64), axis=1)
        ok = np.isfinite(x).all(axis=1) & (norm > 0) & np.isfinite(norm)
        yield at[ok], x[ok]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _apart(lo_a, hi_a, lo_b, hi_b) -> float:
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float((gap * gap).sum())


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes by length of vector, from a bounded sample."""
    n = max(1, vectors.count())
    sample = vectors.sample(fraction=min(1.0, SAMPLE / n), seed=7).limit(SAMPLE).toArrow()
    out = {}
    for _, x in _matrices(sample.column(1).combine_chunks()) if sample.num_rows else ():
        u = _unit(x)
        _, basis = np.linalg.eigh(np.cov(u.T) if len(u) > 1 else np.eye(u.shape[1]))
        out[u.shape[1]] = np.atleast_2d(basis)[:, ::-1]
    return out


def _leaf_pairs(u, y, a, b, c, d, eps2, least, out):
    """Pairs (i, j), i in [a, b), j in [c, d), of at least the cosine ``least``; each pair once."""
    lo_a, hi_a, lo_c, hi_c = y[a:b].min(0), y[a:b].max(0), y[c:d].min(0), y[c:d].max(0)
    if _apart(lo_a, hi_a, lo_c, hi_c) > eps2:
        return
    if b - a <= LEAF and d - c <= LEAF:
        i, j = np.nonzero(u[a:b] @ u[c:d].T >= least)
        if a == c:
            i, j = i[i < j], j[i < j]
        out.append((i + a, j + c))
        return
    if a == c and b == d:
        m = (a + b) // 2
        for p, q, r, s in ((a, m, a, m), (a, m, m, b), (m, b, m, b)):
            _leaf_pairs(u, y, p, q, r, s, eps2, least, out)
    elif b - a >= d - c:
        m = (a + b) // 2
        _leaf_pairs(u, y, a, m, c, d, eps2, least, out)
        _leaf_pairs(u, y, m, b, c, d, eps2, least, out)
    else:
        m = (c + d) // 2
        _leaf_pairs(u, y, a, b, c, m, eps2, least, out)
        _leaf_pairs(u, y, a, b, m, d, eps2, least, out)


def near_vectors(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Links vectors whose cosine in double precision is ``least`` or more: vec_id, n_links, component_id, kept.

    One row for every row. Null and zero vectors, vectors with null or non-finite components, and vectors of different
    lengths link with nothing. Equal vectors are compared once and counted by their number; a null id counts as a vector
    but does not name a component; an empty table gives no rows.
    """
    if not 0 < least <= 1:
        raise ValueError("the cosine lies in (0, 1]")
    spark = vectors.sparkSession
    kind = vectors.schema[column].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    bits = np.float32 if kind == "array<float>" else np.float64
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast(kind).alias("v"))
    axes = _axes(given)
    eps2 = 2 - 2 * least + 1e-9

    def place(batches):
        for batch in batches:
            n = batch.num_rows
            node, size, cells, body = np.zeros(n, np.int64), np.zeros(n, np.int32), [None] * n, [None] * n
            for at, x in _matrices(batch.column(1)):
                turn = axes.get(x.shape[1], np.eye(x.shape[1]))[:, :AXES]
                cell = np.floor(_unit(x) @ turn / np.sqrt(eps2)).astype(np.int64) + (1 << 15)
                cell = np.pad(cell, ((0, 0), (0, AXES - cell.shape[1])))
                for k, r in enumerate(at.tolist()):
                    raw = x[k].tobytes()
                    body[r], cells[r], size[r] = raw, cell[k].astype(">u2").tobytes(), x.shape[1]
                    node[r] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
            null = np.array([b is None for b in body])
            yield rows(
                vec_id=batch.column(0), node=pa.array(node, mask=null), size=pa.array(size, pa.int32()),
                cells=pa.array(cells, pa.binary()), body=pa.array(body, pa.binary()))

    placed = stored(given.mapInArrow(place, "vec_id long, node long, size int, cells binary, body binary"), "vectors")
    alive = placed.where("node is not null")
    copies = alive.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    distinct = alive.select("node", "size", "cells", "body").dropDuplicates(["node"]).join(copies.select("node", "copies"), "node")

    def blocks(batches):
        part, number, held = TaskContext.get().partitionId(), 0, []

        def closed():
            size = held[0][1]
            x = np.frombuffer(b"".join([h[2] for h in held]), bits).reshape(-1, size)
            y = _unit(x) @ axes.get(size, np.eye(size))[:, :BOX]
            return rows(
                part=pa.array([part], pa.int32()), number=pa.array([number], pa.int32()), size=pa.array([size], pa.int32()),
                lo=pa.array([y.min(0).tolist()], pa.list_(pa.float64())), hi=pa.array([y.max(0).tolist()], pa.list_(pa.float64())),
                nodes=[np.array([h[0] for h in held], np.int64).tobytes()], copies=[np.array([h[3] for h in held], np.int64).tobytes()], body=[x.tobytes()])

        for batch in batches:
            for x in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if held and (len(held) == BLOCK or held[0][1] != x[1]):
                    yield closed()
                    number, held = number + 1, []
                held.append(x)
        if held:
            yield closed()

    shape = "part int, number int, size int, lo array<double>, hi array<double>, nodes binary, copies binary, body binary"
    ordered = distinct.select("node", "size", "cells", "body", "copies")
    n_parts = max(1, min(partitions(spark), distinct.count() // (4 * BLOCK)))
    ordered = ordered.repartitionByRange(n_parts, "size", "cells").sortWithinPartitions("size", "cells", "node")
    held = stored(ordered.mapInArrow(blocks, shape), "blocks")
    # blocks are numbered in the order of the sequence; there are BLOCK times fewer of them than vectors
    leaves = held.select("part", "number", "size", "lo", "hi")
    leaves = stored(leaves.withColumn("at", F.row_number().over(Window.orderBy("part", "number")).cast("long") - 1), "leaves")
    n_blocks, levels = leaves.count(), 0
    while FAN**levels < n_blocks:
        levels += 1

    def boxes(level: int) -> DataFrame:
        if level == 0:
            return leaves.select("at", "size", "lo", "hi", (F.col("at") / FAN).cast("long").alias("up"))
        return leaves.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("lo") - 1))).groupBy((F.col("at") / FAN**level).cast("long").alias("at"), "size", "k").agg(
            F.min(F.col("lo")[F.col("k")]).alias("l"), F.max(F.col("hi")[F.col("k")]).alias("h")).groupBy("at", "size").agg(
            F.array_sort(F.collect_list(F.struct("k", "l", "h"))).alias("b")).select(
            "at", "size", F.col("b.l").alias("lo"), F.col("b.h").alias("hi"), (F.col("at") / FAN).cast("long").alias("up"))

    gap = "aggregate(zip_with(zip_with(la, hb, (x, y) -> greatest(0D, x - y)), zip_with(lb, ha, (x, y) -> greatest(0D, x - y)), (p, q) -> p * p + q * q), 0D, (s, x) -> s + x)"
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in range(levels, -1, -1):
        if level == levels:
            continue  # one interval holds all
        box = boxes(level)
        left = box.select(F.col("up").alias("a"), F.col("at").alias("a2"), F.col("size").alias("sa"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
        right = box.select(F.col("up").alias("b"), F.col("at").alias("b2"), F.col("size").alias("sb"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        down = pairs.join(left, "a").join(right, "b").where("a2 <= b2 and sa = sb")
        pairs = stored(down.where(F.expr(gap) <= eps2).select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "intervals")
    payload = held.join(leaves.select("part", "number", "at"), ["part", "number"]).select("at", "size", "nodes", "copies", "body")
    left = payload.select(F.col("at").alias("a"), "size", *[F.col(c).alias(f"{c}_a") for c in ("nodes", "copies", "body")])
    right = payload.select(F.col("at").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("nodes", "copies", "body")])

    def compare(batches):
        for batch in (x.slice(i, 1) for x in batches for i in range(x.num_rows)):
            a, b, size, nodes_a, copies_a, body_a, nodes_b, copies_b, body_b = (batch.column(i)[0].as_py() for i in range(9))
            nodes, copies, body = (nodes_a, copies_a, body_a) if a == b else (nodes_a + nodes_b, copies_a + copies_b, body_a + body_b)
            nodes, copies = np.frombuffer(nodes, np.int64), np.frombuffer(copies, np.int64)
            u = _unit(np.frombuffer(body, bits).reshape(-1, size))
            y = u @ axes.get(size, np.eye(size))[:, :BOX]
            n, found = len(nodes_a) // 8, []
            _leaf_pairs(u, y, 0, n, 0 if a == b else n, n if a == b else len(nodes), eps2, least, found)
            i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            links = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
            at = np.nonzero(links)[0]
            root = spanning(len(nodes), i, j)
            yield rows(node=nodes[at], n=links[at].astype(np.int64), root=nodes[root[at]])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "size", "nodes_a", "copies_a", "body_a", "nodes_b", "copies_b", "body_b")
    met = stored(joined.mapInArrow(compare, "node long, n long, root long"), "links")
    links = met.groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = copies.join(links, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least_id = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    nodes = nodes.join(least_id, "component").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = placed.select("vec_id", "node").join(nodes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

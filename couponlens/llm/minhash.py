"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's sketch is the k smallest hashes of its word shingles. The inverted lists are over pairs of neighbouring
values of a sketch, which similar documents share and others hardly ever do, however common the single values are. In
the ordered union of two sketches at least four fifths of the values are shared if the documents are similar enough, and
so are many pairs of neighbours: .6 n - 1 of them at least where the sketches hold whole sets of n, and at least 7 (fewer
have a probability of 2e-8) where they are cut at k. Documents that have fewer of their pairs in common with any others,
as those that share only a passage, are left out at once. The sketch of the union estimates the similarity, and the full
shingle sets decide (see `groups`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import RunHash, chunks, distinct, mix64, perhaps_among, rows, stored, text_chunks, trimmed
from couponlens.llm.groups import K, PAD, SLOTS, how_common, similar_components, sketch, sketches

#: Sets of so many shingles and the sets similar to them are in their sketches as a whole.
WHOLE = 38
#: Least number of neighbour pairs that larger sets share with a similar one.
NEIGHBOURS = 7
_NO_ID = -(1 << 63)
_CHUNK = 500_000  # characters whose sets are made at once
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: list[str], words: int, tool: RunHash) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``words`` words. A-Z count as a-z, words are parted by
    ASCII white space; a text with fewer words is one shingle, one without words has none."""
    raw = [x.encode() for x in texts]
    data = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    white = _WHITE[data]
    before = np.concatenate([[True], white[:-1]])
    starts = np.nonzero(~white & before)[0]
    ends = np.nonzero(white & ~before)[0]
    hashes = tool.runs(tool.premixed(_VALUES[data]), starts, ends)
    bounds = np.searchsorted(starts, np.cumsum([0, *[len(x) + 1 for x in raw]]))
    joined = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        factor = mix64(np.array([j + 1], np.uint64))[0] | np.uint64(1)
        joined += hashes[j : j + len(joined)] * factor
    joined = mix64(joined)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(distinct(joined[a : b - words + 1]))
        elif b > a:
            short = hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(short, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def packed(text: str) -> bytes:
    """A text as a body: its length in UTF-8, then the compressed bytes, less than a third of its shingles' hashes."""
    raw = text.encode()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def packed_sets(bodies: list[bytes], words: int) -> list[np.ndarray]:
    """The shingle sets of packed texts."""
    out, tool, codec = [], RunHash(), pa.Codec("zstd")
    sizes = [int.from_bytes(x[:8], "little") for x in bodies]
    for a, b in chunks(sizes, _CHUNK):
        out += shingle_sets([codec.decompress(x[8:], n, asbytes=True).decode() for x, n in zip(bodies[a:b], sizes[a:b])], words, tool)
    return out


def _node(shingles: np.ndarray) -> int | None:
    """Identity of a set; equal sets are one node."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def near_components(docs: DataFrame, words: int = 5, key: str = "doc_id", text: str = "text", mark: bool = False) -> DataFrame:
    """Groups documents that are linked, directly or through others, by a Jaccard similarity of 0.8 or more of their
    distinct word shingles.

    Returns a row for every row: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable), ``kept`` (the
    row's id is that). Null and empty texts have no shingles and are alone;
    equal sets are one node whatever their number; a null id comes before all others; rows that repeat an id are linked
    by their own texts; an empty table gives no rows.
    """
    whole = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def measure(batches):
        tool = RunHash()
        for whole_batch in batches:
            at = 0
            for keys, texts in text_chunks([whole_batch], _CHUNK):
                sets = shingle_sets(texts, words, tool)
                yield rows(
                    doc=keys, n_shingles=pa.array([len(s) for s in sets], pa.int64()), node=pa.array([_node(s) for s in sets], pa.int64()),
                    sig=pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()), mark=whole_batch.column(2).slice(at, len(texts)))
                at += len(texts)

    marked = whole.withColumn("mark", F.xxhash64("text"))
    measured = stored(marked.mapInArrow(trimmed(measure), "doc long, n_shingles long, node long, sig binary, mark long"), "sketches")
    nodes = measured.where("node is not null")
    firsts = nodes.groupBy("node").agg(F.min("doc").alias("first"))
    signatures = nodes.select("node", F.col("n_shingles").alias("size"), "sig").dropDuplicates(["node"])

    common = how_common(signatures, 2)

    def neighbours(batches):
        for batch in batches:
            size, sig = batch.column(1).to_numpy(), sketches(batch.column(2))
            rarity = common[(sig & np.uint64(SLOTS - 1)).astype(np.int64)]
            weight = np.where(sig == PAD, 0, rarity).sum(axis=1)
            value = mix64((mix64(sig[:, :-1]) + sig[:, 1:]).ravel()).reshape(len(sig), K - 1)
            chosen = sig[:, 1:] != PAD
            n = chosen.sum(axis=1)
            need = np.where(size <= WHOLE, np.maximum(-(-size * 60 // 100) - 1, 1), NEIGHBOURS)
            yield rows(
                value=value[chosen].view(np.int64), node=np.repeat(batch.column(0).to_numpy(), n),
                weight=np.repeat(weight, n), need=np.repeat(need, n))

    index = signatures.mapInArrow(neighbours, "value long, node long, weight long, need long")

    def full(batches):
        tool = RunHash()
        for keys, texts in text_chunks(batches, _CHUNK):
            nodes = [_node(s) for s in shingle_sets(texts, words, tool)]
            yield rows(node=pa.array(nodes, pa.int64()), first=keys, body=pa.array([packed(x) for x in texts], pa.binary()))

    def bodies(wanted: DataFrame) -> DataFrame:
        of = stored(wanted.join(firsts, "node"), "wanted")
        # one shuffle of texts serves the rows that repeat and the join
        every = perhaps_among(whole, "doc", of.select(F.col("first").alias("doc"))).select("doc", "text")
        every = every.mapInArrow(trimmed(full), "node long, first long, body binary").dropDuplicates(["node", "first"])
        return every.join(of, ["node", "first"]).select("node", "body")

    parts = similar_components(index, bodies, lambda own: packed_sets(own, words))
    ids = firsts.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = ids.join(least, "component").select("node", "component_id")
    more = ["doc", "mark"] if mark else []
    return measured.select("doc", "n_shingles", "node", "mark").join(ids, "node", "left").select(
        *more, F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "n_shingles",
        F.when(F.coalesce("component_id", "doc") != _NO_ID, F.coalesce("component_id", "doc")).alias("component_id"),
        (F.coalesce("component_id", "doc") == F.col("doc")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that `near_components` keeps, with all their columns. Rows that repeat an id are told apart by their texts,
    and rows that repeat both are kept or dropped together; rows with a null id stay if their group names no id."""
    kept = near_components(docs, words, key, text, mark=True).where("kept").select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).distinct()
    own = F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return docs.join(kept, (own[0] == kept["_doc"]) & (own[1] == kept["_mark"]), "left_semi")

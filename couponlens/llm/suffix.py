"""Removal of byte strings that also start earlier, by suffix arrays per shard, and by hashes of windows beyond them.

1. *Where to look.* Of each window of ``size`` bytes, the k-gram with the least hash (the leftmost of equal ones) is its
   anchor. Equal windows have equal anchors at the same place, so windows whose anchors differ need no comparison. The
   consecutive windows with one anchor form a piece; about one byte in forty starts a piece.
2. *Copies.* Pieces that are equal as a whole are the same windows again: all but the first are covered, and one copy
   goes on. A task drops its own repeats before the shuffle.
3. *Shards.* Where one anchor stands in different pieces, these are gathered into shards of some megabytes. A shard's
   suffix array is made by Larsson-Sadakane refinement, its common prefixes by Kasai's rule; suffixes that share
   ``size`` bytes are one class, and all but the first member are covered.
4. *Large anchors.* An anchor with more pieces than a shard holds, such as one at the edge of a passage that much of the
   corpus begins or ends with, is dealt out further: each window of its pieces goes by the hash of its own bytes, and
   all but the first of equal ones are covered.
5. *Removal.* The covered ranges of a document are put together and cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.common import RunHash, drop_stored, mix64, rows, stored, stored_tables, trimmed

_CHUNK = 500_000  # bytes that a task scans at once
_GATHERED = 500_000  # bytes of the anchors that share a suffix array
_SHARD = 1_500_000  # bytes of one anchor's suffix array
_NO_ID = -(1 << 63)
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours, from running minima within blocks of w from either side."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchored_pieces(data: np.ndarray, bounds: np.ndarray, size: int, k: int, tool: RunHash):
    """Pieces of the documents ``data[bounds[i]:bounds[i+1]]``: first window, number of windows, place of the anchor
    within the first window, hash of the anchor, hash of the whole piece."""
    empty = np.zeros(0, np.int64)
    if len(data) < size:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = tool.premixed(_BYTE_VALUES[data])
    at = np.arange(len(data) - k + 1)
    grams = mix64((sums[k:] - sums[:-k]) * tool.inverses[: len(at)])
    keyed = (grams & ~np.uint64(0xFFFFFFF)) | at.astype(np.uint64)
    anchor = (sliding_min(keyed, size - k + 1) & np.uint64(0xFFFFFFF)).astype(np.int64)
    del keyed
    valid = np.zeros(len(data) + 1, np.int32)
    lengths = np.diff(bounds)
    long_enough = lengths >= size
    np.add.at(valid, bounds[:-1][long_enough], 1)
    np.add.at(valid, (bounds[1:] - size + 1)[long_enough], -1)
    valid = np.cumsum(valid)[: len(anchor)] > 0
    change = valid.copy()
    change[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    edge = np.nonzero(change | ~valid)[0]
    ends = np.concatenate([edge[1:], [len(anchor)]])
    keep = valid[edge]
    first, n = edge[keep], (ends - edge)[keep]
    place = anchor[first] - first
    whole = mix64(tool.runs(sums, first, first + n + size - 1) + place.astype(np.uint64))
    return first, n, place, grams[anchor[first]], whole


def big_endian_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as a number that orders like them; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes or more. Larsson and Sadakane's refinement: groups of
    suffixes that agree on h bytes are ordered by the rank of the suffix h further on, and only groups that still hold
    several suffixes are worked on."""
    n = len(data)
    words = big_endian_words(data) if words is None else words
    # the true end of the data sorts before a zero byte
    sa = np.argsort(words, kind="stable")
    tail = np.minimum(n - sa, 8)
    ordered = words[sa]
    same = (ordered[1:] == ordered[:-1]) & (tail[1:] == 8) & (tail[:-1] == 8)
    if n and not same.all():
        fix = np.lexsort((tail, ordered)) if (tail < 8).any() else None
        if fix is not None:
            sa, tail, ordered = sa[fix], tail[fix], ordered[fix]
            same = (ordered[1:] == ordered[:-1]) & (tail[1:] == tail[:-1])
    new = np.concatenate([[True], ~same]) if n else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[sa] = head
    h = 8
    open_at = np.nonzero(~new | np.concatenate([~new[1:], [False]]))[0] if n else np.zeros(0, np.int64)
    while len(open_at) and h < depth:
        suffix = sa[open_at]
        ahead = suffix + h
        key = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[suffix]
        order = np.lexsort((key, group)) if n >= 1 << 31 else np.argsort(group << 32 | key, kind="stable")
        suffix, key, group = suffix[order], key[order], group[order]
        sa[open_at] = suffix
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        rank[suffix] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(suffix)), 0))]
        open_at = open_at[~new | np.concatenate([~new[1:], [False]])]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, depth: int, words: np.ndarray, lane: int = 64) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in the array, counted up to ``depth``. Kasai's rule, that
    the next suffix shares at most one byte less, is followed along many stretches of the text side by side. It holds
    where the suffixes differ within the depth to which they are ordered; after an equality to that depth, which leaves
    their order open, counting begins anew. So ``depth`` is at most the depth of the order."""
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    previous = np.full(n, -1, np.int64)
    previous[sa[1:]] = sa[:-1]
    padded = np.concatenate([words, np.zeros(depth + 16, np.uint64)])
    shared = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    have = np.zeros(len(starts), np.int64)
    for d in range(lane):
        i = starts + d
        live = i < n
        i = i[live]
        have = have[live]
        have = np.where(have < depth, np.maximum(have - 1, 0), 0)
        starts = starts[live]
        j = previous[i]
        have[j < 0] = 0
        todo = np.nonzero((j >= 0) & (have < depth))[0]
        while len(todo):
            differ = padded[i[todo] + have[todo]] ^ padded[j[todo] + have[todo]]
            equal = differ == 0
            some = todo[~equal]
            if len(some):
                x = differ[~equal]
                extra = np.zeros(len(some), np.int64)
                for b in range(1, 8):
                    extra += x < np.uint64(1 << (64 - 8 * b))
                have[some] += extra
            todo = todo[equal]
            have[todo] += 8
            todo = todo[have[todo] < depth]
        have = np.minimum(have, np.where(j >= 0, np.minimum(n - i, n - j), 0))
        shared[i] = np.minimum(have, depth)
    out[:] = shared[sa]
    return out


def covered_windows(data: np.ndarray, windows: np.ndarray, size: int) -> np.ndarray:
    """For windows in ascending order: whether an equal one stands earlier in the data."""
    depth = 8
    while depth < size:
        depth *= 2
    words = big_endian_words(data)
    sa = suffix_array(data, depth, words)
    shared = common_prefixes(data, sa, depth, words)
    is_window = np.zeros(len(data), bool)
    is_window[windows] = True
    heads = np.nonzero(np.concatenate([[True], shared[1:] < size]))[0]
    first = np.minimum.reduceat(np.where(is_window[sa], sa, len(data)), heads)
    leader = np.zeros(len(data), bool)
    leader[first[first < len(data)]] = True
    return ~leader[windows]


def _runs(flags: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the runs of neighbouring places that are flagged; places ascend."""
    x = places[flags]
    if not len(x):
        return x, x
    cut = np.nonzero(np.diff(x) != 1)[0]
    return x[np.concatenate([[0], cut + 1])], x[np.concatenate([cut, [len(x) - 1]])]


def _scan(size: int, k: int):
    """Task: rows (doc, text, mark) to pieces (h1, h2, doc, mark, loc) and to ranges that the task found covered itself.

    ``loc`` is first window << 16 | place of the anchor << 8 | number of windows; 0 windows mark a covered range, whose
    end is in h2.
    """

    def run(batches):
        tool = RunHash()
        for batch in (x.slice(i, 1000) for x in batches for i in range(0, x.num_rows, 1000)):
            texts = [x.encode() for x in batch.column(1).to_pylist()]
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            marks = np.asarray(batch.column(2).to_numpy(), np.int64)
            order = np.lexsort((marks, ids))
            at = 0
            while at < len(order):
                to, total = at, 0
                while to < len(order) and (to == at or total + len(texts[order[to]]) <= _CHUNK):
                    total += len(texts[order[to]])
                    to += 1
                part = order[at:to]
                at = to
                data = np.frombuffer(b"".join([texts[i] for i in part]), np.uint8)
                bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in part])])
                first, n, place, h1, h2 = anchored_pieces(data, bounds, size, k, tool)
                if not len(first):
                    continue
                doc_at = np.searchsorted(bounds, first, side="right") - 1
                doc, mark, local = ids[part][doc_at], marks[part][doc_at], first - bounds[doc_at]
                by = np.lexsort((first, h2, h1))
                same = np.zeros(len(by), bool)
                same[1:] = (h1[by][1:] == h1[by][:-1]) & (h2[by][1:] == h2[by][:-1])
                leader = by[np.maximum.accumulate(np.where(~same, np.arange(len(by)), 0))]
                repeat = np.zeros(len(by), bool)
                repeat[by] = same
                again = np.zeros(len(by), bool)  # the same document once more: neither a new piece nor a repeat
                again[by] = same & (doc[by] == doc[leader]) & (mark[by] == mark[leader]) & (local[by] == local[leader])
                keep = ~repeat
                loc = local << 16 | place << 8 | n
                yield rows(h1=h1[keep].view(np.int64), h2=h2[keep].view(np.int64), doc=doc[keep], mark=mark[keep], loc=loc[keep])
                repeat &= ~again
                if repeat.any():
                    d, m, s, e = doc[repeat], mark[repeat], local[repeat], (local + n + size - 1)[repeat]
                    new = np.concatenate([[True], (d[1:] != d[:-1]) | (m[1:] != m[:-1]) | (s[1:] > e[:-1])])
                    heads = np.nonzero(new)[0]
                    d, m, s, e = d[heads], m[heads], s[heads], e[np.concatenate([heads[1:] - 1, [len(e) - 1]])]
                    spread = mix64(mix64(d.view(np.uint64)) + s.astype(np.uint64)).view(np.int64)
                    yield rows(h1=spread, h2=e, doc=d, mark=m, loc=s << 16)

    return run


def _cut_out(size: int):
    """Task: documents with their pieces to (h1, doc, mark, loc, bytes of the piece)."""

    def run(batches):
        for batch in (x.slice(i, 500) for x in batches for i in range(0, x.num_rows, 500)):
            h1, doc, mark, loc, body = [], [], [], [], []
            for key, text, own, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                for x in found:
                    first, n = x["loc"] >> 16, x["loc"] & 255
                    if first + n + size - 1 <= len(raw):
                        h1.append(x["h1"])
                        doc.append(key)
                        mark.append(own)
                        loc.append(x["loc"])
                        body.append(raw[first : first + n + size - 1])
            yield rows(h1=pa.array(h1, pa.int64()), doc=pa.array(doc, pa.int64()), mark=pa.array(mark, pa.int64()), loc=pa.array(loc, pa.int64()), body=pa.array(body, pa.binary()))

    return run


def _shards(size: int, limit: int):
    """Task: pieces ordered by (h1, doc, mark, loc) to covered ranges (doc, mark, start, end). A piece that comes again
    from a row that repeats id and text is the same one. No anchor has more than ``limit`` bytes, so none goes on in the
    next shard."""

    def run(batches):
        h1, doc, mark, loc, body, total = [], [], [], [], [], 0

        def work(final: bool):
            nonlocal h1, doc, mark, loc, body, total
            stop = len(h1)
            if not final:  # the last anchor may go on: keep it for the next shard
                while stop and h1[stop - 1] == h1[-1]:
                    stop -= 1
            if not stop:
                return
            data = np.frombuffer(b"".join(body[:stop]), np.uint8)
            at = np.cumsum([0, *map(len, body[:stop])])[:-1]
            where = np.array(loc[:stop])
            n = where & 255
            begins = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(begins, n)
            flags = covered_windows(data, np.repeat(at, n) + step, size)
            for_run = np.repeat(np.arange(stop), n) * (1 << 20) + step  # neighbours within a piece only
            low, high = _runs(flags, for_run)
            who = low >> 20
            first = where[who] >> 16
            out = rows(doc=np.array(doc[:stop])[who], mark=np.array(mark[:stop])[who], start=first + (low & 0xFFFFF), end=first + (high & 0xFFFFF) + size)
            h1, doc, mark, loc, body = h1[stop:], doc[stop:], mark[stop:], loc[stop:], body[stop:]
            total = sum(map(len, body))
            yield out

        before = None

        for batch in (x.slice(i, 1000) for x in batches for i in range(0, x.num_rows, 1000)):
            for x in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if x[:4] == before:
                    continue
                before = x[:4]
                for held, value in zip((h1, doc, mark, loc, body), x):
                    held.append(value)
                total += len(x[4])
                if total >= min(limit, _GATHERED):
                    yield from work(False)
        if h1:
            yield from work(True)

    return run


def _windows(size: int):
    """Task: pieces (doc, mark, loc, body) to a row for each of their windows (hash, doc, mark, start)."""

    def run(batches):
        tool = RunHash()
        for batch in (x.slice(i, 1000) for x in batches for i in range(0, x.num_rows, 1000)):
            body = batch.column(3).to_pylist()
            loc = batch.column(2).to_numpy()
            n = loc & 255
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(np.cumsum([0, *map(len, body)])[:-1], n) + step
            sums = tool.premixed(_BYTE_VALUES[np.frombuffer(b"".join(body), np.uint8)])
            of = pa.array(np.repeat(np.arange(len(body)), n))
            yield rows(
                window=tool.runs(sums, at, at + size).view(np.int64), doc=batch.column(0).take(of), mark=batch.column(1).take(of),
                start=np.repeat(loc >> 16, n) + step)

    return run


def _remove(as_text: bool):
    def run(batches):
        for batch in (x.slice(i, 500) for x in batches for i in range(0, x.num_rows, 500)):
            n_bytes, kept, spans = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                n_bytes.append(len(raw))
                out, merged, at = [], [], 0
                for x in sorted(found or [], key=lambda x: x["start"]):
                    a, b = x["start"], min(x["end"], len(raw))
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(b, merged[-1]["end"])
                    elif a < b:
                        merged.append({"start": a, "end": b})
                for x in merged:
                    out.append(raw[at : x["start"]])
                    at = x["end"]
                kept.append(b"".join([*out, raw[at:]]))
                spans.append(merged)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            more = {"kept_text": pa.array([x.decode(errors="ignore") for x in kept], pa.string())} if as_text else {}
            yield rows(doc_id=batch.column(0), rest=batch.column(3), n_bytes=pa.array(n_bytes, pa.int64()), kept=pa.array(kept, pa.binary()), spans=pa.array(spans, span), **more)

    return run


def remove_repeats(docs: DataFrame, size: int = 100, key: str = "doc_id", text: str = "text", shard_bytes: int = _SHARD, as_text: bool = False) -> DataFrame:
    """Cuts out every byte covered by a string of ``size`` bytes that also starts earlier: in a document with a smaller
    id, or earlier in the same one. Strings do not cross documents and are judged on the input.

    Returns every row with ``n_bytes``, ``kept`` (binary: a cut may fall inside a character) and ``spans`` (start and
    end of the maximal removed runs), and ``rest``, a struct of the row's other columns; with ``as_text`` also
    ``kept_text``, without characters that a cut went through. A null or empty text, or one
    shorter than ``size``, has no spans; a null id comes before all others; rows that repeat id and text are one document
    and get the same result; texts that share an id are told apart, and ordered, by their hashes; an empty table gives no
    rows.
    """
    if not 16 <= size <= 200:
        raise ValueError("size is from 16 to 200 bytes")
    k = min(24, size // 4)
    whole = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("rest")).withColumn("mark", F.xxhash64("text"))
    found = whole.select("doc", "text", "mark").mapInArrow(trimmed(_scan(size, k)), "h1 long, h2 long, doc long, mark long, loc long")
    is_range = F.col("loc").bitwiseAND(255) == 0
    by_piece = Window.partitionBy("h1", "h2").orderBy("doc", "mark", "loc")
    by_anchor = Window.partitionBy("h1")
    judged = (
        found.repartition("h1")
        .withColumn("lead", F.first(F.struct("doc", "mark", "loc")).over(by_piece))
        .withColumn("several", F.min("h2").over(by_anchor) != F.max("h2").over(by_anchor))
        .withColumn("own", F.struct("doc", "mark", "loc"))
    )
    bytes_of = F.col("loc").bitwiseAND(255) + (size - 1)
    large = F.sum(F.when(F.col("lead") == F.col("own"), bytes_of)).over(by_anchor) > shard_bytes
    judged = judged.withColumn("large", large)
    state = F.when(is_range, 1).when(F.col("lead") < F.col("own"), 2).when(F.col("several"), F.when(F.col("large"), 4).otherwise(3))
    judged = stored(judged.select("h1", "h2", "doc", "mark", "loc", state.alias("state")).where("state is not null").distinct(), "pieces")
    start = F.shiftright("loc", 16)
    ranges = judged.where("state < 3").select(
        "doc", "mark", start.alias("start"), F.when(is_range, F.col("h2")).otherwise(start + bytes_of).alias("end"))

    def cut(state: int) -> DataFrame:
        wanted = judged.where(F.col("state") == state).groupBy("doc", "mark").agg(F.collect_list(F.struct("h1", "loc")).alias("found"))
        return whole.join(wanted, ["doc", "mark"]).select("doc", "text", "mark", "found").mapInArrow(trimmed(_cut_out(size)), "h1 long, doc long, mark long, loc long, body binary")
    dealt = cut(3).repartition("h1").sortWithinPartitions("h1", "doc", "mark", "loc")
    # stored, as are those of large anchors, so that texts and pieces are not kept in shuffle files at the same time
    more = stored(dealt.mapInArrow(trimmed(_shards(size, shard_bytes)), "doc long, mark long, start long, end long"), "covered")
    ranges = ranges.unionAll(more)
    if judged.where("state = 4").limit(1).count():
        begin = stored_tables()
        pieces = stored(cut(4).select("doc", "mark", "loc", "body"), "large")
        windows = pieces.mapInArrow(trimmed(_windows(size)), "window long, doc long, mark long, start long")
        own = F.struct("doc", "mark", "start")
        firsts = windows.groupBy("window").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first < last")
        again = windows.join(firsts.drop("last"), "window").where(own != F.col("first"))
        again = stored(again.select("doc", "mark", "start", (F.col("start") + size).alias("end")), "again")
        drop_stored(whole.sparkSession, since=begin, keep=1)
        ranges = ranges.unionAll(again)
    spans = ranges.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = whole.join(spans, ["doc", "mark"], "left").select("doc", "text", "found", "rest")
    rest = joined.schema["rest"].dataType.simpleString()
    out = joined.mapInArrow(trimmed(_remove(as_text)), f"doc_id long, rest {rest}, n_bytes long, kept binary, spans array<struct<start:long,end:long>>" + ", kept_text string" * as_text)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

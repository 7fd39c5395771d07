"""Benchmark decontamination by a distributed positional inverted index.

Every task turns runs of training documents into segments: the sorted distinct words and, for each, the ascending
list of its places. Segments are rows of a stored table and hold whole documents, so any executor can search them again
and no word's list lies in one place, however common it is. Test phrases go to the segments in blocks of bounded size. In a segment a phrase
starts from the list of its rarest word, moved back by the word's offset, and is intersected with the moved lists of
the other words by rising length. Words are compared as bytes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import rows, stored, text_chunks, texts_only, trim
from couponlens.llm.words import BLOCK_CHARS, numbered, numbering, query_blocks, words

WINDOW = 10
_SEGMENT_CHARS = 1_000_000
_SHIFT = np.int64(32)  # a key is a word's rank in the segment, then its place in the segment
_SEGMENT = "part int, number int, doc_ids array<long>, begins binary, terms binary, lists binary, places binary"
_FOUND = "part int, number int, nth int, doc_id long, n_words long, starts array<long>, ends array<long>, items array<long>"


def write_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores the positional index of all words of all texts; one row per segment of about a million characters.

    A null text has no words, rows that share an id or a text stay apart, a longer text is a segment of its own, an empty
    table gives no row.
    """

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        for keys, texts in text_chunks(batches, _SEGMENT_CHARS):
            number = numbering()
            found, begins = numbered(texts, number)
            by_bytes = sorted(number)
            rank = np.empty(len(number), np.int64)
            rank[np.fromiter((number[t] for t in by_bytes), np.int64, len(number))] = np.arange(len(number))
            found = rank[found]
            places = np.argsort(found, kind="stable")
            lists = np.concatenate([[0], np.cumsum(np.bincount(found, minlength=len(number)))])
            yield rows(
                part=pa.array([part], pa.int32()), number=pa.array([nth], pa.int32()), doc_ids=pa.array([keys.to_pylist()], pa.list_(pa.int64())),
                begins=[begins.astype("<u4").tobytes()], terms=[b" ".join(by_bytes)], lists=[lists.astype("<u4").tobytes()],
                places=[places.astype("<u4").tobytes()])
            nth += 1
        trim()

    return stored(texts_only(docs, key, text).mapInArrow(run, _SEGMENT), "postings")


class Segment:
    """One row of the index: ``doc_ids``, where documents begin, and the lists of ascending places of sorted words."""

    def __init__(self, doc_ids: list[int | None], begins: bytes, terms: bytes, lists: bytes, places: bytes) -> None:
        self.doc_ids = doc_ids
        self.begins = np.frombuffer(begins, "<u4").astype(np.int64)
        self.rank = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
        self.lists = np.frombuffer(lists, "<u4").astype(np.int64)
        self.places = np.frombuffer(places, "<u4").astype(np.int64)
        self.keys = np.repeat(np.arange(len(self.rank), dtype=np.int64) << _SHIFT, np.diff(self.lists)) + self.places

    def ranks(self, terms: list[bytes]) -> np.ndarray:
        """Where the lists of words are; -1 for a word that the segment does not hold."""
        return np.fromiter((self.rank.get(t, -1) for t in terms), np.int64, len(terms))

    def holds(self, rank: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether words stand at places, by binary search in their lists."""
        key = (rank << _SHIFT) + place
        at = np.searchsorted(self.keys, key)
        return self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), bool)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, place, "right") - 1

    def phrases(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (phrase, first place) of phrases of one length, given as rows of ranks, within documents."""
        which = np.nonzero((phrases >= 0).all(axis=1))[0]
        phrases = phrases[which]
        n = phrases.shape[1]
        length = np.diff(self.lists)[phrases]
        order = np.argsort(length, axis=1, kind="stable")  # offsets from the rarest word on
        first = order[:, 0]
        rare = phrases[np.arange(len(phrases)), first]
        count = length[np.arange(len(phrases)), first]
        row = np.repeat(np.arange(len(phrases)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = self.places[self.lists[rare][row] + nth] - first[row]
        inside = start >= 0
        row, start = row[inside], start[inside]
        for k in range(1, n):
            offset = order[row, k]
            ok = self.holds(phrases[row, offset], start + offset)
            row, start = row[ok], start[ok]
        ok = self.document(start) == self.document(start + n - 1)
        return which[row[ok]], start[ok]

    def near(self, ranks: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Shortest spans (first, last place) of no more than ``within`` words of a document that hold all of the words."""
        ranks = np.unique(ranks)
        if not len(ranks) or ranks[0] < 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = sorted((self.places[self.lists[r] : self.lists[r + 1]] for r in ranks), key=len)
        ends = np.unique(np.concatenate(lists))
        at = np.minimum(np.searchsorted(lists[0], ends - within + 1), len(lists[0]) - 1)
        ends = ends[(lists[0][at] > ends - within) & (lists[0][at] <= ends)]  # the rarest word is in reach
        first = ends.copy()
        for one in lists:
            at = np.searchsorted(one, ends, "right") - 1
            first = np.where((at < 0) | (first < 0), -1, np.minimum(first, one[np.maximum(at, 0)]))
        ok = (first >= 0) & (ends - first < within)
        first, ends = first[ok], ends[ok]
        ok = (self.document(first) == self.document(ends)) & np.concatenate([[True], first[1:] > first[:-1]])[: len(first)]
        return first[ok], ends[ok]


def segments(batches):
    """The segments of Arrow batches of the index, one at a time, with their part and number."""
    for batch in batches:
        for i in range(batch.num_rows):
            (row,) = batch.slice(i, 1).to_pylist()
            yield row["part"], row["number"], Segment(row["doc_ids"], row["begins"], row["terms"], row["lists"], row["places"])
    trim()


def _windows(block: list[tuple[int | None, str]], size: int):
    """The words of a block of items, and by length the distinct windows as rows of word numbers with the items of each."""
    number, owners = numbering(), defaultdict(set)
    for item, text in block:
        ids = [number[w] for some in words(text) for w in some]
        for at in range(max(1, len(ids) - size + 1) if ids else 0):
            owners[tuple(ids[at : at + size])].add(item)
    by_length = defaultdict(list)
    for window, items in owners.items():
        by_length[len(window)].append((window, items))
    return list(number), {n: (np.array([w for w, _ in held], np.int64), [list(i) for _, i in held]) for n, held in by_length.items()}


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unites spans [start, end) that touch or overlap."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.nonzero(new)[0][1:] - 1, [len(reach) - 1]])]


def phrase_hits(
    index: DataFrame, items: DataFrame, size: int = WINDOW, key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Exact matches of every window of ``size`` consecutive words of the items; a shorter item is one window.

    Per document: part, number, nth (its place in the index), doc_id, n_words, starts and ends (its hit words as united
    spans, counted from 0), items (ids of the items with a window in it; null stands for a null id). Items that share an id are
    one item; an item without words, or an empty set, matches nothing.
    """
    spark = index.sparkSession

    def search(sent):
        def run(batches):
            terms, by_length = sent.value
            for part, number, segment in segments(batches):
                n_docs, rank = len(segment.doc_ids), segment.ranks(terms)
                first, last, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], defaultdict(set)
                for n, (windows, owners) in by_length.items():
                    which, start = segment.phrases(rank[windows])
                    doc = segment.document(start)
                    first.append(start + doc)  # a place is left free after each document, so that no span reaches the next
                    last.append(start + doc + n)
                    for pair in np.unique(doc * len(windows) + which).tolist():
                        found[pair // len(windows)].update(owners[pair % len(windows)])
                start, end = _spans(np.concatenate(first), np.concatenate(last))
                base = segment.begins[:-1] + np.arange(n_docs)
                edge = np.searchsorted(start, np.append(base, segment.begins[-1] + n_docs))
                base = np.repeat(base, np.diff(edge))
                yield rows(
                    part=pa.array([part] * n_docs, pa.int32()), number=pa.array([number] * n_docs, pa.int32()), nth=np.arange(n_docs, dtype=np.int32),
                    doc_id=pa.array(segment.doc_ids, pa.int64()), n_words=np.diff(segment.begins),
                    starts=pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(start - base)),
                    ends=pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(end - base)),
                    items=pa.array([list(found[i]) if i in found else [] for i in range(n_docs)], pa.list_(pa.int64())))

        return run

    def only(block):
        return index.mapInArrow(search(spark.sparkContext.broadcast(_windows(block, size))), _FOUND)

    blocks = iter(query_blocks(items, key, text, block_chars))
    out = only(next(blocks, []))
    for block in blocks:
        more = only(block).where("size(items) > 0")
        out = out.unionAll(more)
    return out


def _united(batches):
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("n_words", "starts", "ends", "items")}
        n_hit, n_items, digest = [], [], []
        for starts, ends, items in zip(columns["starts"], columns["ends"], columns["items"]):
            start, end = _spans(np.array([x for s in starts for x in s], np.int64), np.array([x for e in ends for x in e], np.int64))
            n_hit.append(int((end - start).sum()))
            named = sorted({"" if i is None else str(i) for held in items for i in held})
            n_items.append(len(named))
            digest.append(hashlib.sha256(",".join(named).encode()).hexdigest())
        yield rows(
            doc_id=batch.column("doc_id"), n_words=batch.column("n_words"), n_hit=pa.array(n_hit, pa.int64()), n_items=pa.array(n_items, pa.int64()),
            items_sha256=pa.array(digest, pa.string()), contaminated=pa.array([n > 0 for n in n_hit], pa.bool_()))


def contamination(hits: DataFrame) -> DataFrame:
    """One row per document from the rows of ``phrase_hits``: doc_id, n_words, n_hit, n_items, items_sha256 (the ids as
    sorted strings, comma-joined; a null id as an empty string), contaminated."""
    whole = hits.groupBy("part", "number", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *[F.collect_list(c).alias(c) for c in ("starts", "ends", "items")])
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return whole.select("doc_id", "n_words", "starts", "ends", "items").mapInArrow(_united, schema)


def proximity_hits(
    index: DataFrame, items: DataFrame, within: int, key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Shortest spans of no more than ``within`` words of a document that hold all distinct words of an item in any order:
    item_id, doc_id, first and last (places of words in the document, counted from 0). Rows of items that share an id give
    spans of their own; an item without words gives none."""
    spark = index.sparkSession

    def search(sent):
        def run(batches):
            number, block = sent.value
            for _, _, segment in segments(batches):
                rank, out = segment.ranks(number), [[], [], [], []]
                for item, ids in block:
                    first, last = segment.near(rank[ids], within)
                    doc = segment.document(first)
                    out[0] += [item] * len(first)
                    out[1] += [segment.doc_ids[d] for d in doc.tolist()]
                    out[2] += (first - segment.begins[doc]).tolist()
                    out[3] += (last - segment.begins[doc]).tolist()
                yield rows(**{c: pa.array(x, pa.int64()) for c, x in zip(("item_id", "doc_id", "first", "last"), out)})

        return run

    def only(block):
        number = numbering()
        held = [(item, np.array([number[w] for some in words(t) for w in some], np.int64)) for item, t in block]
        sent = spark.sparkContext.broadcast((list(number), [(i, ids) for i, ids in held if len(ids)]))
        return index.mapInArrow(search(sent), "item_id long, doc_id long, first long, last long")

    blocks = iter(query_blocks(items, key, text, block_chars))
    out = only(next(blocks, []))
    for block in blocks:
        out = out.unionAll(only(block))
    return out


def oracle_sql(size: int = WINDOW) -> str:
    """The contract in DuckDB SQL."""
    split = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({split}, []) AS ws FROM documents),
        i AS (SELECT item_id, {split} AS ws FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, len(w) AS n, array_to_string(w, ' ') AS w FROM (
                SELECT item_id, unnest([ws[a:a + {size} - 1] FOR a IN range(1, greatest(2, len(ws) - {size} + 2))]) AS w FROM i WHERE len(ws) > 0)),
        lengths AS (SELECT DISTINCT n FROM windows),
        runs AS (
            SELECT k, n, unnest(range(1, len(ws) - n + 2)) AS a, unnest([array_to_string(ws[b:b + n - 1], ' ') FOR b IN range(1, len(ws) - n + 2)]) AS w
            FROM d, lengths WHERE len(ws) >= n),
        found AS (SELECT k, a, n, item_id FROM runs JOIN windows USING (n, w)),
        hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(a, a + n)) AS p FROM found) GROUP BY k),
        items AS (
            SELECT k, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
            FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM found) GROUP BY k)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (k) LEFT JOIN items USING (k)"""

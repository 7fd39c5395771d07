"""Ranked lexical search over classes of documents that look alike to the queries.

Every document is cut down to its bag: the frequencies of the words that the queries use. Documents with the same bag and
the same length norm have the same score for every query. They are brought together by a hash and told apart by the bag
itself, each class is scored once for all queries, and the best classes hand out their documents by ascending id.
Queries come in blocks of bounded size; all documents are scored against each block.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.common import chunks, rows, stored, text_chunks, texts_only
from couponlens.llm.words import BLOCK_CHARS, query_blocks, words

TOP = 10
_B = 90  # share of the length in the norm, in hundredths
_BAG = np.dtype([("term", "<u4"), ("tf", "<u4")])
_PAIRS = 2_000_000  # (word of a class, query) pairs that are summed at once


def _vocabulary(block: list[tuple[int | None, str]]) -> tuple[dict[bytes, int], list[list[int]]]:
    """Numbers of all words of a block, and the distinct numbers of each query's words."""
    number: dict[bytes, int] = {}
    return number, [sorted({number.setdefault(w, len(number)) for some in words(t) for w in some}) for _, t in block]


def bags(docs: DataFrame, vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (words of the whole text, with repeats) and bag (numbers and frequencies of the words in the vocabulary, by
    ascending number). ``vocabulary`` is a broadcast dictionary. A null text has no words."""

    def run(batches):
        number = vocabulary.value
        for keys, texts in text_chunks(batches):
            sizes, out = [], []
            for one in texts:
                n, seen = 0, []
                for some in words(one):
                    n += len(some)
                    seen += [x for x in map(number.get, some) if x is not None]
                term, tf = np.unique(np.array(seen, np.uint32), return_counts=True)
                bag = np.empty(len(term), _BAG)
                bag["term"], bag["tf"] = term, tf
                sizes.append(n)
                out.append(bag.tobytes())
            yield rows(doc_id=keys, n=pa.array(sizes, pa.int64()), bag=pa.array(out, pa.binary()))

    return texts_only(docs, key, text).mapInArrow(run, "doc_id long, n long, bag binary")


def frequencies(held: DataFrame, size: int) -> np.ndarray:
    """In how many bags each word of a vocabulary of ``size`` occurs."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total[np.frombuffer(raw, _BAG)["term"]] += 1
        used = np.nonzero(total)[0]
        yield rows(term=used, df=total[used])

    out = np.zeros(size, np.int64)
    found = held.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def _postings(queries: list[list[int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The queries of each word, one list after the other, and where the lists begin."""
    term = np.array([t for q in queries for t in q], np.int64)
    query = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    order = np.argsort(term, kind="stable")
    return query[order], np.concatenate([[0], np.cumsum(np.bincount(term, minlength=size))])


def _best(top: int, sent):
    """Task: classes (class, m, least, bag) to the task's ``top`` best for each query (query, score, class, m, least, bag), by
    descending score and ascending least id, nulls last."""

    def run(batches):
        weight, query_of, begins, n_queries = sent.value
        kept, least_score = None, np.ones(n_queries, np.int64)
        for batch in batches:
            bag = [np.frombuffer(x, _BAG) for x in batch.column(3).to_pylist()]
            m, least = batch.column(1).to_numpy(), batch.column(2)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in bag])])
            term, tf = (np.concatenate([x[c] for x in bag]).astype(np.int64) for c in ("term", "tf"))
            of = np.repeat(np.arange(len(bag)), np.diff(ends))
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
            fan = np.diff(begins)[term]
            pairs = np.bincount(of, fan, len(bag)).astype(np.int64)
            for a, b in chunks(np.maximum(pairs, n_queries).tolist(), _PAIRS):
                x = slice(ends[a], ends[b])
                n = fan[x]
                nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                score = np.zeros((b - a, n_queries), np.int64)
                np.add.at(score, (np.repeat(of[x] - a, n), query_of[np.repeat(begins[term[x]], n) + nth]), np.repeat(part[x], n))
                at, query = np.nonzero(score >= least_score)
                if not len(at):
                    continue
                # the slice's best go on; only they need their bags
                ids = pa.table({"at": at + a, "query": query, "score": score[at, query], "least": least.take(pa.array(at + a))})
                ids = _first(ids, top)
                found = pa.Table.from_batches([batch]).take(ids.column("at"))
                found = found.append_column("query", ids.column("query")).append_column("score", ids.column("score"))
                kept = _first(found if kept is None else pa.concat_tables([kept, found]), top)
                query, score = kept.column("query").to_numpy(), kept.column("score").to_numpy()
                full = np.nonzero(np.arange(len(query)) - np.searchsorted(query, query) == top - 1)[0]
                least_score[query[full]] = score[full]
        if kept is not None:
            yield from kept.select(["query", "score", "class", "m", "least", "bag"]).to_batches()

    return run


def _first(found: pa.Table, top: int) -> pa.Table:
    found = found.sort_by([("query", "ascending"), ("score", "descending"), ("least", "ascending")])
    query = found.column("query").to_numpy()
    return found.filter(pa.array(np.arange(len(query)) - np.searchsorted(query, query) < top))


def _ranked(docs: DataFrame, block: list[tuple[int | None, str]], top: int) -> DataFrame:
    spark = docs.sparkSession
    number, queries = _vocabulary(block)
    held = stored(bags(docs, spark.sparkContext.broadcast(number)), "bags")
    documents, total = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequencies(held, len(number))]
    sent = spark.sparkContext.broadcast((np.array(weight, np.int64), *_postings(queries, len(number)), len(queries)))

    norm = F.expr(f"{100 - _B} + ((CAST({_B} AS DECIMAL(38, 0)) * n * {documents}L) DIV {max(total, 1)}L)").cast("long")
    members = held.where("length(bag) > 0").select("doc_id", norm.alias("m"), "bag").withColumn("class", F.xxhash64("m", "bag"))
    identity = ["class", "m", "bag"]  # the hash brings equal bags together, norm and bag decide
    classes = members.groupBy(identity).agg(F.min("doc_id").alias("least")).select("class", "m", "least", "bag")
    found = classes.mapInArrow(_best(top, sent), "query long, score long, class long, m long, least long, bag binary")
    # a document among the first `top` is in one of the first `top` classes by score and least id
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("least"), "class", "bag")
    best = stored(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top).drop("nth"), "best")
    own = Window.partitionBy(identity).orderBy(F.asc_nulls_last("doc_id"))
    expanded = members.join(best.select(identity).distinct(), identity, "left_semi")
    expanded = expanded.withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= top).drop("nth")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "class", "bag")
    ranked = best.join(expanded, identity).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "query long, item_id long")
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The ``top`` documents of the highest score above 0 for each item: item_id, rank (from 1), doc_id, score.

    Equal scores come by ascending doc_id, a null id last; rows that share an id are ranked apart. A null text has no
    words; an item without words, and every item of an empty table of documents, gives no row. Items that share an id give
    the rows of each.
    """
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = [_ranked(chosen, block, top) for block in query_blocks(items, item_key, item_text, block_chars)]
    empty = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts) if parts else empty


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def oracle_sql(top: int = TOP) -> str:
    """The contract in DuckDB SQL."""
    return f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
        held AS (SELECT row_number() OVER () AS k, doc_id, ws, len(ws) AS n FROM d WHERE len(ws) > 0),
        total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM held),
        tf AS (SELECT k, w, count(*) AS tf FROM (SELECT k, unnest(ws) AS w FROM held) GROUP BY k, w),
        i AS (SELECT item_id, row_number() OVER () AS q, {_WORDS} AS ws FROM benchmark),
        used AS (SELECT DISTINCT q, item_id, w FROM (SELECT q, item_id, unnest(ws) AS w FROM i)),
        weight AS (
            SELECT w, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
            FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), total),
        score AS (
            SELECT q, item_id, doc_id, k,
                sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - _B} + ({_B} * n * n_docs) // n_words))))::BIGINT AS score
            FROM used JOIN weight USING (w) JOIN tf USING (w) JOIN held USING (k), total
            GROUP BY q, item_id, doc_id, k)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
            FROM score WHERE score > 0)
        WHERE rank <= {top}"""

"""Toxicity by weak supervision.

1. *Lexicon.* Word beginnings and whole words that stand mostly in toxic documents, chosen on a bounded sample of labelled
   documents.
2. *Voters.* Each entry votes on its own; further voters look at patterns: how many hits a text has, their rate, shouting,
   exclamation marks and runs of symbols.
3. *Label model.* A generative model of the votes, fitted without labels by expectation maximisation: each class has its
   rate per voter (the voters' accuracies), and the voters' covariance within the classes (their correlations) weighs
   them, so that voters that repeat each other do not count twice. It gives every document a posterior label.
4. *Classifier.* A logistic regression on counts is trained on the posteriors; one scale and shift, fitted on the labels,
   make its score a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import RunHash, rows, text_chunks, trim, trimmed
from couponlens.llm.langid import letter_table

SAMPLE = 12_000  # labelled documents that everything is fitted on
LEXICON = 256  # entries at most
SHORTEST, LONGEST = 4, 8  # characters of a word beginning
_WHOLE = np.uint64(0xA24BAED4963EE407)  # told apart from a beginning of the same letters
_END = 0xD800
_CHUNK = 500_000  # characters that are scored at once
_TABLES: dict[str, object] = {}


def _tools() -> tuple[np.ndarray, RunHash]:
    if not _TABLES:
        _TABLES["letters"], _TABLES["hash"] = letter_table(), RunHash()
    return _TABLES["letters"], _TABLES["hash"]


def entry_hash(entry: str) -> int:
    """Identity of a lexicon entry: a beginning ends with ``*``."""
    body = entry.removesuffix("*")
    codes = np.array([ord(c) for c in body], np.uint32)
    tool = RunHash()
    key = tool.runs(tool.sums(codes), np.array([0]), np.array([len(codes)]))[0]
    return int(key if entry.endswith("*") else key ^ _WHOLE)


def _words(texts: list[str]):
    """Code points of the lower-cased texts; starts and ends of the words (runs of letters); the text of each word; what
    the pattern voters look at, per text: characters, capitals, exclamation marks, symbols, words."""
    is_letter, tool = _tools()
    raw = chr(_END).join(texts) + chr(_END)
    sizes = np.array([len(x) for x in texts])
    given = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), "<u4")
    stops = np.nonzero(given == _END)[0]
    capital = (given >= 65) & (given <= 90)
    mark, symbol = given == 33, ((given >= 35) & (given <= 38)) | (given == 42) | (given == 64)
    begins = np.concatenate([[0], stops[:-1] + 1])
    per_text = [np.add.reduceat(x.astype(np.int64), begins) for x in (capital, mark, symbol)]
    codes = given
    if not raw.islower():
        low = raw.lower()
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
        stops = np.nonzero(codes == _END)[0]
    letter = is_letter[codes]
    before, after = np.concatenate([[False], letter[:-1]]), np.concatenate([letter[1:], [False]])
    starts, ends = np.nonzero(letter & ~before)[0], np.nonzero(letter & ~after)[0] + 1
    of = np.searchsorted(stops, starts)
    n_words = np.bincount(of, minlength=len(texts))
    return codes, starts, ends, of, np.stack([sizes, *per_text, n_words], axis=1).astype(np.float64), tool


def _count_entries(batches):
    """Task: rows (toxic, text) to (entry, toxic, n): in how many documents a beginning or word stands."""
    held: dict[str, list[int]] = {}
    for toxic, texts in text_chunks(batches):
        for label, text in zip(toxic.to_pylist(), texts):
            clean = "".join(c if c.isalpha() else " " for c in text.lower())
            found = set()
            for w in set(clean.split()):
                found.add(w)
                for n in range(SHORTEST, min(len(w), LONGEST) + 1):
                    found.add(w[:n] + "*")
            for x in found:
                held.setdefault(x, [0, 0])[label] += 1
    yield rows(
        entry=pa.array(held.keys(), pa.string()), clean=pa.array([x[0] for x in held.values()], pa.int64()), toxic=pa.array([x[1] for x in held.values()], pa.int64()))


def features(texts: list[str], keys: np.ndarray) -> np.ndarray:
    """Per text: hits of each entry, then characters, capitals, exclamation marks, symbols, words."""
    codes, starts, ends, of, patterns, tool = _words(texts)
    out = np.zeros((len(texts), len(keys)))
    order = np.argsort(keys)
    ordered = keys[order]
    sums = tool.sums(codes)

    def hit(hashes, which):
        at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
        ok = ordered[at] == hashes
        np.add.at(out, (of[which[ok]], order[at[ok]]), 1)

    if len(keys):
        every = np.arange(len(starts))
        hit(tool.runs(sums, starts, ends) ^ _WHOLE, every)
        for n in range(SHORTEST, LONGEST + 1):
            long_enough = every[ends - starts >= n]
            hit(tool.runs(sums, starts[long_enough], starts[long_enough] + n), long_enough)
    return np.concatenate([out, patterns], axis=1)


def votes(x: np.ndarray) -> np.ndarray:
    """Votes of all voters, 1 or 0: one per entry, then the pattern voters."""
    n = x.shape[1] - 5
    hits, (size, capital, mark, symbol, words) = x[:, :n], x[:, n:].T
    total, size, words = hits.sum(axis=1), np.maximum(size, 1), np.maximum(words, 1)
    kinds = (hits > 0).sum(axis=1)
    patterns = [total >= 1, total >= 2, total >= 4, kinds >= 2, total / words >= 0.002, total / words >= 0.01, capital / size >= 0.3, mark / words >= 0.1, symbol / words >= 0.3]
    return np.concatenate([hits > 0, np.stack(patterns, axis=1)], axis=1).astype(np.float64)


class LabelModel:
    """Two classes of documents, each with its rate of every voter, and the voters' covariance within classes."""

    def __init__(self, v: np.ndarray, rounds: int = 30) -> None:
        n = v.shape[1]
        p = np.clip((v.sum(axis=1) / max(1.0, np.sort(v.sum(axis=1))[-max(1, len(v) // 20)])), 0.02, 0.98)  # more votes, likelier toxic
        for _ in range(rounds):
            share = np.clip(p.mean(), 0.005, 0.5)
            toxic = (p @ v + 0.5) / (p.sum() + 1)
            clean = ((1 - p) @ v + 0.5) / ((1 - p).sum() + 1)
            centre = p[:, None] * (v - toxic) ** 2 + (1 - p)[:, None] * (v - clean) ** 2
            residual = v - (p[:, None] * toxic + (1 - p)[:, None] * clean)
            spread = residual.T @ residual / len(v)
            spread[np.diag_indices(n)] = centre.mean(axis=0) + 1e-4
            spread = 0.7 * spread + 0.3 * np.diag(np.diag(spread))
            self.weights = np.linalg.solve(spread, toxic - clean)
            self.bias = np.log(share / (1 - share)) - 0.5 * (toxic + clean) @ self.weights
            new = self.posterior(v)
            done = np.abs(new - p).max() < 1e-4
            p = new
            if done:
                break
        self.accuracy, self.correlation = (toxic, clean), spread

    def posterior(self, v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v @ self.weights + self.bias, -30, 30)))


def inputs(x: np.ndarray) -> np.ndarray:
    """What the classifier sees: logarithms of hits and of the patterns' rates, and a constant."""
    n = x.shape[1] - 5
    hits, (size, capital, mark, symbol, words) = x[:, :n], x[:, n:].T
    size, words = np.maximum(size, 1), np.maximum(words, 1)
    total = hits.sum(axis=1)
    more = [np.log1p(total), np.log1p(1000 * total / words), np.log1p((hits > 0).sum(axis=1)), capital / size, mark / words, symbol / words, np.ones(len(x))]
    return np.concatenate([np.log1p(hits), np.stack(more, axis=1)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Logistic regression on labels between 0 and 1, by Newton's method."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], penalty)
    keep[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(keep)
        step = np.linalg.solve(curve, x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(labelled: DataFrame):
    """Lexicon keys, weights, scale and shift, learned from rows (id, text, toxic); None without labels of both kinds."""
    ids = labelled.select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    sample = labelled.join(F.broadcast(ids.distinct()), "id", "left_semi")  # SAMPLE ids at most
    counts = sample.select("toxic", "text").mapInArrow(trimmed(_count_entries), "entry string, clean long, toxic long")
    counts = counts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 4 and toxic > 3 * clean")
    strength = F.log((F.col("toxic") + 0.1) / (F.col("clean") + 0.5))
    top = counts.orderBy(F.desc(F.col("toxic") * strength), "entry").limit(LEXICON).toPandas()
    keys = np.array([entry_hash(x) for x in top["entry"]], np.uint64)

    def measure(batches):
        for toxic, texts in text_chunks(batches):
            x = features(texts, keys)
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * x.shape[1], pa.int32())
            yield rows(toxic=toxic, x=pa.ListArray.from_arrays(ends, pa.array(x.ravel())))

    table = sample.select("toxic", "text").mapInArrow(trimmed(measure), "toxic int, x array<double>").limit(2 * SAMPLE).toArrow()
    if not table.num_rows:
        return None
    y = table.column(0).to_numpy().astype(np.float64)
    if y.min() == y.max():
        return None
    x = table.column(1).combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    del table
    model = LabelModel(votes(x))
    w = logistic(inputs(x), model.posterior(votes(x)), 1.0)
    raw = inputs(x) @ w
    scale = logistic(np.stack([raw, np.ones(len(raw))], axis=1), y, 1e-3)
    del x, raw
    trim()
    return keys, w, scale


def score(docs: DataFrame, labels: DataFrame, learn, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Scores every document: doc_id, score (0 to 1; 0.5 and more means toxic), predicted; with ``carry`` also ``rest``, a
    struct of all columns of the row.

    ``labels`` has (doc_id, toxic); only rows for which ``learn`` holds are learned from. Null and empty texts are scored
    like texts without any hit; without labels of both kinds every score is 0; a label or id that is null teaches
    nothing; rows that repeat are scored each; other columns are ignored; an empty table gives no rows.
    """
    extra = [F.struct(*[F.col(c) for c in docs.columns]).alias("rest")] if carry else []
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *extra)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(learn).where("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE)  # some labels belong to no document
    fitted = train(given.join(F.broadcast(ids), "doc_id").select(F.col("doc_id").alias("id"), "text", "toxic"))

    def scores(texts: pa.Array) -> pa.Array:
        p = [np.zeros(0)]
        for _, some in text_chunks([rows(key=texts, text=texts)], _CHUNK):
            if fitted is None:
                p.append(np.zeros(len(some)))
            else:
                entries, w, (scale, shift) = fitted
                p.append(1 / (1 + np.exp(-np.clip(scale * (inputs(features(some, entries)) @ w) + shift, -30, 30))))
        return pa.array(np.concatenate(p))

    @F.arrow_udf("double")
    def judged(given: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(scores, given)
        trim()

    def scored(batches):
        for batch in batches:
            yield rows(doc_id=batch.column(0), score=scores(batch.column(1)))

    if carry:
        # only the texts go to Python; each is judged once, also where rows are picked by what comes out
        found = given.withColumn("score", judged.asNondeterministic()("text"))
    else:
        found = given.mapInArrow(trimmed(scored), "doc_id long, score double")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *[F.col("rest")] * carry)

"""Language identification by interpolated Kneser-Ney models of characters.

Texts become lower-case letters with single spaces between runs of them. Spark counts the four-character runs of every
language over all documents to learn from, and smooths all counts order by order. The log-probability of a run is a sum of
terms, which become sorted arrays of hashes, in parts of bounded size dealt by hash. Every text is looked up in every part;
it gets the language of the least cross-entropy per character. The confidence and the limits of rejection are set by all
documents to learn from, too.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import RunHash, chunks, mix64, rows, stored, text_chunks

ORDER = 4
CELLS = 1 << 24  # numbers of the model that a task holds at once; a larger model is looked up in several parts
DISCOUNT = 0.75
SHARPNESS = tuple(2.0 ** np.arange(-2, 8))
COMMON = 0.999  # share of a language's texts to learn from that are like it
_TASK_GRAMS = 1_000_000  # different runs that a task counts before it hands them on
_END = 0xD800


def letters(texts: list[str], is_letter: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string of letters and single spaces; where the runs of ORDER characters begin; how many runs each
    text has. A text is preceded by spaces and followed by one."""
    gap = " " * (ORDER - 1)
    joined = (chr(_END).join(texts) + chr(_END)).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    stop = codes == _END
    clean = np.where(is_letter[codes], codes, 32).astype(np.uint32)
    clean[stop] = _END
    before = np.concatenate([[_END], clean[:-1]])
    after = np.concatenate([clean[1:], [_END]])
    keep = (clean != 32) | ((before != 32) & (before != _END) & (after != _END))
    clean = clean[keep]
    ends = np.nonzero(clean == _END)[0]
    sizes = np.diff(np.concatenate([[-1], ends])) - 1
    begins = np.concatenate([[0], np.cumsum(np.where(sizes, sizes + ORDER, 0))])
    out = np.full(begins[-1], 32, np.uint32)
    body = clean != _END
    text = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[begins[:-1][text] + len(gap) + offset] = clean[body]
    runs = np.where(sizes, sizes + 1, 0)
    where = np.repeat(begins[:-1], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return out.tobytes().decode("utf-32-le"), where, runs


def letter_table() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


_TABLES: dict[str, object] = {}


def _tools() -> tuple[np.ndarray, RunHash]:
    if not _TABLES:
        _TABLES["letters"], _TABLES["hash"] = letter_table(), RunHash()
    return _TABLES["letters"], _TABLES["hash"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows (lang, text) to (lang, gram, n)."""
    is_letter, tool = _tools()
    held: dict[str, pd.DataFrame] = {}

    def handed_on():
        for lang, frame in held.items():
            yield rows(lang=[lang] * len(frame), gram=pa.array(frame["gram"].tolist(), pa.string()), n=frame["n"].to_numpy(np.int64))

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in chunks([len(x) for x in texts]):
            by: dict[str, list[str]] = {}
            for lang, text in zip(langs[a:b], texts[a:b]):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                joined, where, _ = letters(own, is_letter)
                if not len(where):
                    continue
                codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
                which, different = pd.factorize(tool.runs(tool.sums(codes), where, where + ORDER))
                first = np.empty(len(different), np.int64)
                first[which[::-1]] = where[::-1]
                frame = pd.DataFrame({"gram": [joined[i : i + ORDER] for i in first.tolist()], "n": np.bincount(which)}, index=different)
                if lang in held:
                    both = pd.concat([held[lang], frame])
                    frame = both.groupby(level=0, sort=False).agg(gram=("gram", "first"), n=("n", "sum"))
                held[lang] = frame
        if sum(map(len, held.values())) > _TASK_GRAMS:
            yield from handed_on()
            held = {}
    yield from handed_on()


def _history(hashes: np.ndarray) -> np.ndarray:
    """Keys of histories, which differ from those of the same characters as a run."""
    return mix64(hashes + np.uint64(0x632BE59BD9B4E019))


class Part:
    """Terms of some runs and histories: sorted keys, and a number for each language."""

    def __init__(self, keys: np.ndarray, lang_of: np.ndarray, values: np.ndarray, n: int) -> None:
        self.keys, at = np.unique(keys, return_inverse=True)
        self.table = np.zeros((len(self.keys), n))
        self.table[at, lang_of] = values

    def terms(self, codes: np.ndarray, where: np.ndarray, tool: RunHash) -> np.ndarray:
        """For the run of ORDER characters at each place the sum of the terms that this part holds, for each language."""
        out = np.zeros((len(where), self.table.shape[1]))
        if not len(self.keys):
            return out
        sums, end = tool.sums(codes), where + ORDER
        for order in range(1, ORDER + 1):
            for wanted in (tool.runs(sums, end - order, end), _history(tool.runs(sums, end - order, end - 1))):
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                hit = self.keys[at] == wanted
                out[hit] += self.table[at[hit]]
        return out

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the terms of all runs of each text under each language; number of runs (0: no letter)."""
        is_letter, tool = _tools()
        joined, where, runs = letters(texts, is_letter)
        out = np.zeros((len(texts), self.table.shape[1]))
        if len(where):
            codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            which, different = pd.factorize(tool.runs(tool.sums(codes), where, where + ORDER))
            first = np.empty(len(different), np.int64)
            first[which[::-1]] = where[::-1]
            terms = self.terms(codes, first, tool)
            some = runs > 0
            begins = (np.cumsum(runs) - runs)[some]
            for k in range(out.shape[1]):
                out[some, k] = np.add.reduceat(terms[:, k][which], begins)
        return out, runs


class Model:
    """A run's log-probability under a language is the floor's, plus the logarithms of the weights of its histories, plus
    for each order that holds the run what it gains there over the next lower order. The languages that lack a run or a
    history gain 0, so ``terms`` holds a row (key, lang, value) for what a language has, and nothing else."""

    def __init__(self, langs: list[str], floor: float, terms: DataFrame) -> None:
        self.langs, self.floor, self._terms = langs, floor, terms
        self.parts = max(1, -(-terms.count() * len(langs) // CELLS))
        self._only: Part | None = None

    def part(self, r: int) -> Part:
        if self._only is None:
            held = self._terms.where(F.pmod("key", F.lit(self.parts)) == r).toArrow()
            found = Part(held["key"].to_numpy().view(np.uint64), held["lang"].to_numpy(), held["value"].to_numpy(), len(self.langs))
            if self.parts > 1:
                return found
            self._only = found
        return self._only

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text under each language; number of characters (0: no letter)."""
        total, runs = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for r in range(self.parts):
            part = self.part(r)
            for a, b in chunks([len(x) for x in texts]):
                more, runs[a:b] = part.totals(texts[a:b])
                total[a:b] += more
        return entropy(total, runs, self.floor), runs


def entropy(total: np.ndarray, runs: np.ndarray, floor: float) -> np.ndarray:
    return np.where(runs[:, None] > 0, -(total / np.maximum(runs, 1)[:, None] + np.log(floor)), 0.0)


def _keyed(langs: list[str]):
    """Task: rows (lang, run, history, value) to (key, lang, value)."""
    place = {x: i for i, x in enumerate(langs)}

    def run(batches):
        _, tool = _tools()
        for batch in batches:
            runs = batch.column(1).to_pylist()
            ends = np.cumsum([len(x) for x in runs], dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            hashes = tool.runs(tool.sums(np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")), starts, ends)
            key = np.where(batch.column(2).to_numpy(zero_copy_only=False), _history(hashes), hashes)
            yield rows(key=key.view(np.int64), lang=pa.array([place[x] for x in batch.column(0).to_pylist()], pa.int32()), value=batch.column(3))

    return run


def train(labelled: DataFrame) -> Model | None:
    """Learns from rows (lang, text); rows without a language are left out. None if there is nothing to learn. All runs
    of all languages count, and each language is smoothed on its own."""
    known = labelled.where("lang is not null and text is not null")
    counts = known.select("lang", "text").mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "runs")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    floor = 1.0 / (counts.select(F.substring("gram", ORDER, 1)).distinct().count() + 1)
    levels = [counts.select("lang", F.col("gram").alias("run"), F.col("n").cast("double").alias("c"))]
    for order in range(ORDER - 1, 0, -1):  # in how many different contexts the shorter run occurs
        levels.insert(0, levels[0].groupBy("lang", F.substring("run", 2, order).alias("run")).agg(F.count(F.lit(1)).cast("double").alias("c")))
    below, terms = None, []
    for order, level in enumerate(levels, start=1):
        level = level.select("lang", "run", "c", F.substring("run", 1, order - 1).alias("history"), F.substring("run", 2, order - 1).alias("lower"))
        weights = level.groupBy("lang", "history").agg(F.sum("c").alias("total"), (DISCOUNT * F.count(F.lit(1)) / F.sum("c")).alias("weight"))
        level = level.join(weights, ["lang", "history"])
        level = level.join(below, ["lang", "lower"]) if below is not None else level.withColumn("below", F.lit(floor))
        backed_off = F.col("weight") * F.col("below")
        p = (F.col("c") - DISCOUNT) / F.col("total") + backed_off
        level = stored(level.select("lang", "run", p.alias("p"), F.log(p / backed_off).alias("value")), "order")
        below = level.select("lang", F.col("run").alias("lower"), F.col("p").alias("below"))
        terms.append(level.select("lang", "run", F.lit(False).alias("history"), "value"))
        terms.append(weights.select("lang", F.col("history").alias("run"), F.lit(True).alias("history"), F.log("weight").alias("value")))
    every = terms[0]
    for more in terms[1:]:
        every = every.unionAll(more)
    return Model(langs, floor, stored(every.mapInArrow(_keyed(langs), "key long, lang int, value double"), "terms"))


def quantiles(values: DataFrame, q: float) -> dict[int, float]:
    """For each language of the rows (own, bits, n) the quantile q, as numpy has it. ``bits`` are those of numbers that are
    not negative, which have the same order; ``n`` rows hold them. The two numbers beside the quantile are found by four
    counts, each by the next 16 bits of the rows that share what is known of one; so a count returns 65,536 rows for each
    of them at most, whatever the number of rows."""
    asked: dict[int, list[tuple[int, int]]] = {}  # bits known so far, and the place among the rows that begin with them
    share: dict[int, float] = {}
    for shift in (48, 32, 16, 0):
        heads = sorted({(own, head) for own, places in asked.items() for head, _ in places})
        among = [(F.col("own") == own) & (F.shiftright("bits", shift + 16) == head) for own, head in heads]
        counts = (values.where(reduce(or_, among)) if among else values).groupBy("own", F.shiftright("bits", shift).alias("cell")).agg(F.sum("n").alias("n")).toPandas()
        if not among:
            for own, n in counts.groupby("own")["n"].sum().items():
                low = int(q * (n - 1))
                asked[own], share[own] = [(0, low), (0, min(low + 1, n - 1))], q * (n - 1) - low
        for own, mine in counts.sort_values("cell").groupby("own"):
            cells, n = mine["cell"].to_numpy(), mine["n"].to_numpy()
            for i, (head, place) in enumerate(asked[own]):
                inside = cells >> 16 == head if among else np.ones(len(cells), bool)
                ends = np.cumsum(n[inside])
                at = int(np.searchsorted(ends, place, side="right"))
                asked[own][i] = int(cells[inside][at]), int(place - ends[at] + n[inside][at])
    ends = {own: np.array([bits for bits, _ in places], np.int64).view(np.float64) for own, places in asked.items()}
    return {own: float(low + (high - low) * share[own]) for own, (low, high) in ends.items()}


def calibrate(scored: DataFrame, n_langs: int, floor: float) -> tuple[float, np.ndarray]:
    """Sharpness of the confidence, by the likelihood of the right language, and the entropy per language above which a
    text is rejected (that of one in a thousand texts of the language), from all rows whose right language ``own`` is
    known. Rows are (own, copies, runs, t0, t1, ...), with the terms' total for each language."""

    def measure(batches):
        for batch in batches:
            own, n, runs = (batch.column(c).to_numpy() for c in range(3))
            found = entropy(np.stack([batch.column(3 + k).to_numpy() for k in range(n_langs)], axis=1), runs, floor)
            right = found[np.arange(len(own)), own]
            losses = {}
            for i, s in enumerate(SHARPNESS):
                x = s * (right[:, None] - found)
                top = x.max(axis=1)
                losses[f"s{i}"] = n * (top + np.log(np.exp(x - top[:, None]).sum(axis=1)))
            yield rows(own=own, bits=np.maximum(right, 0.0).view(np.int64), n=n, **losses)

    sums = [f"s{i}" for i in range(len(SHARPNESS))]
    known = scored.where("own is not null and runs > 0").select("own", F.col("copies").cast("long"), "runs", *[f"t{k}" for k in range(n_langs)])
    measured = known.mapInArrow(measure, ", ".join(["own int, bits long, n long", *[f"{x} double" for x in sums]]))
    losses = measured.agg(*[F.sum(x).alias(x) for x in sums]).first()
    limits = np.full(n_langs, np.inf)
    if losses[0] is None:
        return 1.0, limits
    for own, limit in quantiles(measured.select("own", "bits", "n"), COMMON).items():
        limits[own] = limit
    return SHARPNESS[int(np.argmin(losses))], limits


def identify(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predicts the language of every text: doc_id, lang_pred, score (0 to 1), rejected.

    Learns from rows where ``learn`` holds and the language is known. Null texts and texts without a letter are ``und``
    with score 0; so is everything when there is nothing to learn. ``rejected`` marks texts unlike any language learned
    (the best entropy is above nearly all texts of that language); their prediction is still the best. Repeated rows are
    judged each; other columns are ignored; an empty table gives no rows.
    """
    body, known = F.col(text).cast("string"), F.col(lang).cast("string")
    model = train(docs.where(learn).select(known.alias("lang"), body.alias("text")))
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(body, F.lit("")).alias("text"), F.when(learn & body.isNotNull(), known).alias("own"))
    if model is None:
        return given.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))

    langs, floor = model.langs, model.floor
    number = {x: i for i, x in enumerate(langs)}
    sums = [f"t{k}" for k in range(len(langs))]

    def look_up(part):
        def run(batches):
            for batch in batches:
                at = 0
                for keys, texts in text_chunks([batch]):
                    total, runs = part.value.totals(texts)
                    own = pa.array([number.get(x) for x in batch.column(2).slice(at, len(texts)).to_pylist()], pa.int32())
                    mark = batch.column(3).slice(at, len(texts))
                    yield rows(doc_id=keys, own=own, mark=mark, runs=runs, **{t: total[:, k] for k, t in enumerate(sums)})
                    at += len(texts)

        return run

    share = docs.sparkSession.sparkContext.broadcast
    schema = ", ".join(["doc_id long, own int, mark long, runs long", *[f"{t} double" for t in sums]])
    marked = given.withColumn("mark", F.xxhash64("text"))
    every = reduce(DataFrame.unionAll, [marked.mapInArrow(look_up(share(model.part(r))), schema) for r in range(model.parts)])
    copies = F.count(F.lit(1)) / model.parts  # rows that repeat id, text and language
    if model.parts > 1:
        every = every.groupBy("doc_id", "own", "mark").agg(copies.cast("int").alias("copies"), F.max("runs").alias("runs"), *[(F.sum(t) / copies).alias(t) for t in sums])
    else:
        every = every.withColumn("copies", F.lit(1))
    scored = stored(every.select("doc_id", "own", "copies", "runs", *sums), "totals")
    sharp, limits = calibrate(scored, len(langs), floor)

    def judge(batches):
        for batch in batches:
            runs, n = batch.column(2).to_numpy(), batch.num_rows
            own = entropy(np.stack([batch.column(3 + k).to_numpy() for k in range(len(langs))], axis=1), runs, floor)
            best = own.argmin(axis=1)
            low = own[np.arange(n), best]
            score = np.where(runs > 0, 1 / np.exp(-sharp * (own - low[:, None])).sum(axis=1), 0.0)
            pred = [langs[k] if r else "und" for k, r in zip(best.tolist(), runs.tolist())]
            yield rows(doc_id=batch.column(0), copies=batch.column(1), lang_pred=pred, score=score, rejected=(low > limits[best]) | (runs == 0))

    found = scored.select("doc_id", "copies", "runs", *sums).mapInArrow(judge, "doc_id long, copies int, lang_pred string, score double, rejected boolean")
    if model.parts > 1:
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return found.select("doc_id", "lang_pred", "score", "rejected")

"""Registered queries and the whole pipeline against plain versions, and odd or empty tables."""

from __future__ import annotations

import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from couponlens.llm import common, langid, queries, tokenfile, toxicity  # noqa: E402

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "z"), (2, None), (3, ""), (4, long), (None, "a b"), (None, None), (6, "ééé 中"), (7, "\n\n")]
    schema = "doc_id long, text string, lang string, rest string, toxic string, score string, predicted int, part int, number int, n_ids long, file string"
    return spark.createDataFrame([(k, t, "en", "r", "t", "s", 5, 6, 7, 8, "f") for k, t in rows], schema).repartition(3)


def pieces(docs, capacity=4096):
    library, out = Tokenizer.from_file(WORD), set()
    for k, text in docs.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out |= {(k, i, a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes())) for i, a in enumerate(range(0, len(ids), capacity))}
    return out


def sequences(rows, capacity=4096):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing_query(spark, data, documents):
    rows = queries.QUERIES["op5_packing"](spark, data).collect()
    want = pieces(documents)
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows} == want and len(rows) == len(want)
    assert sequences(rows) <= -(-sum(x[3] for x in want) // 4096) + 1


def test_near_copies_query(spark, data, documents):
    """Every link of the brute force is found: recall 1 on this table."""
    got = queries.QUERIES["op6_minhash"](spark, data).collect()
    want = brute.near(documents, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert sum(not kept for _, _, kept in want.values()) > 50


def test_repeats_query(spark, data, documents):
    got = queries.QUERIES["op2_suffix"](spark, data).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats(documents, 100)


def test_vectors_query(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.QUERIES["op9_ego_join"](spark, data).collect()} == brute.vectors(rows)


def test_token_files_of_odd_rows(spark, odd):
    library, at, want = Tokenizer.from_file(BYTE), 0, []
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    for k, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((k, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = tokenfile.read_token_files(tokenfile.write_token_files(odd, BYTE, end_id=0))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    empty = tokenfile.write_token_files(odd.limit(0), BYTE, end_id=0)
    assert empty.count() == 0 and tokenfile.read_token_files(empty).count() == 0


def test_languages_of_an_empty_table(odd):
    assert langid.identify(odd.limit(0), learn=F.lit(True)).count() == 0


def plain_toxic(i):
    return i % 5 == 0


def small_corpus(seed: int, n: int):
    """Documents of lines; every fifth is toxic and says so in words of its own. Copies, near copies, shared lines and passages."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("aeioubcdlmnrst", k=rnd.randint(3, 9))) for _ in range(400)]
    lines = [" ".join(rnd.choices(words, k=rnd.randint(8, 14))) for _ in range(40)]
    passage = "".join(rnd.choices("abcdefgh", k=160))
    out = {}
    for i in range(n):
        own = [rnd.choice(lines) if rnd.random() < 0.15 else " ".join(rnd.choices(words, k=rnd.randint(8, 14))) for _ in range(rnd.randint(3, 9))]
        if i % 7 == 1:
            own[rnd.randrange(len(own))] += " " + passage[: rnd.randint(120, 160)] + " é" + str(i)
        if plain_toxic(i):
            own = [f"{x} {' '.join(rnd.choices(['zorblat', 'kragfen', 'mulvex', 'dratnik'], k=4))}!" for x in own]
        out[i] = "\n".join(own)
    for i in range(0, 40, 3):
        if not plain_toxic(i):
            w = out[i].split()  # the same words in other lines
            out[1000 + i] = "\n".join(" ".join(w[max(0, a) : a + 17]) for a in range(-9, len(w), 17))
    return {**out, 2000: "", 2001: None, 2002: " \n "}


def cut(docs, size):
    """The texts without the bytes that stand earlier, and without characters that a cut goes through."""
    seen, out = set(), {}
    for k in sorted(docs):
        raw = (docs[k] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - size + 1):
            if raw[i : i + size] in seen:
                gone[i : i + size] = True
            seen.add(raw[i : i + size])
        out[k] = bytes(np.frombuffer(raw, np.uint8)[~gone]).decode(errors="ignore")
    return out


def test_toxicity_of_odd_rows(spark, odd):
    corpus = small_corpus(3, 200)
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in corpus.items()], SCHEMA)
    # a document with contradicting labels counts as toxic; unknown ids, null ids and other values teach nothing
    marks = [(k, int(plain_toxic(k)), 9) for k in range(200)] + [(5, 0, 9), (None, 1, 9), (999_999, 1, 9), (1, None, 9), (2, 7, 9)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    got = toxicity.score(both, labels, learn=F.lit(True)).collect()
    assert len(got) == len(corpus) + odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, []).append(r.score)
    assert scores[2001] == scores[2000]
    assert {r.doc_id for r in got if r.predicted} >= {k for k in range(10, 200) if plain_toxic(k)}
    assert toxicity.score(both.limit(0), labels, learn=F.lit(True)).count() == 0


def test_pipeline_run(spark, tmp_path):
    """All five stages one after the other, against the plain versions of each."""
    corpus = small_corpus(11, 160)
    rows = [(k, t, "en", "s", len(t or "")) for k, t in corpus.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int(plain_toxic(k))) for k in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    left = {k: t for k, t in corpus.items() if not re.search("zorblat|kragfen|mulvex|dratnik", t or "")}
    assert len(left) < len(corpus) - 30
    left = {k: t for k, (_, _, t) in brute.lines(left).items()}
    copies = brute.near(left, 5)
    left = {k: t for k, t in left.items() if copies[k][2]}
    assert len(copies) > len(left)
    before = sum(len(t) for t in left.values())
    left = cut(left, corpus_pipeline.MIN_REPEAT)
    assert sum(len(t) for t in left.values()) < before
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got} == pieces(left)
    sequences(got)


def test_stored_tables_can_be_dropped(spark):
    kept = common.stored(spark.range(5).toDF("x"), "kept")
    path = kept.inputFiles()[0]
    common.drop_stored(spark)
    assert not Path(re.sub("^file:(//)?", "", path)).exists()

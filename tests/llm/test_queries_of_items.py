"""Search and decontamination: benchmark items against all documents."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

from couponlens.llm import postings, queries, search  # noqa: E402
from couponlens.llm.words import numbered, numbering, words  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def documents(spark, docs, parts=3):
    rows = [(k, t, "x", 1, 2, "y", 3, "z") for k, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, bag string, n long, m long, part string, nth long, class string").repartition(parts)


def benchmark(spark, items):
    return spark.createDataFrame([(k, t, 5, "q") for k, t in items], "item_id long, text string, k long, t string")


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(4)
    vocabulary = [*"abcdefgh", "É1", "é1", "ß", "x2", "Zz"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 9, 10, 11, 25])))) for i in range(25)]
    items += [(3, "a b c"), (None, "É1 É1 ß"), (40, None), (41, ""), (42, " -!- "), (43, items[5][1])]
    docs = []
    for i in range(150):
        parts = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))]
        if rnd.random() < 0.6:
            parts.insert(rnd.randint(0, len(parts)), (rnd.choice(items)[1] or "").upper() if rnd.random() < 0.3 else rnd.choice(items)[1] or "")
        docs.append((7 * i - 300, rnd.choice([" ", "-", "\n"]).join(parts)))
    docs += [(5000 + i, "a b c d e") for i in range(30)] + [(1, "a b"), (1, "a b"), (1, "b a c"), (None, "a b c"), (None, None), (2, None), (3, ""), (4, "?!")]
    docs += [(9000, " ".join(vocabulary[i * i % 13] for i in range(60_000)) + " " + items[7][1])]
    return docs, items


def test_words():
    rnd = random.Random(0)
    bits = ["A", "z", "é", "É", "İ", "0", "9", "/", ":", "@", "[", "`", "{", "\x7f", "\x80", "\x00", " ", "中", "😀", "_"]
    for _ in range(2000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
        assert [w.decode() for some in words(text) for w in some] == split(text)
    long = "ab é " * 500_000
    assert len(numbered(["", long, "x"], numbering())[0]) == 1_000_001


def contaminated(docs, items, size):
    windows = {}
    for item, text in items:
        w = split(text)
        for a in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if (x := tuple(w[a : a + n])) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[x]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [postings.BLOCK_CHARS, 60])
def test_contamination(spark, case, block):
    docs, items = case
    index = postings.write_index(documents(spark, docs))
    found = postings.contamination(postings.phrase_hits(index, benchmark(spark, items), size=10, block_chars=block)).collect()
    assert sorted((tuple(r) for r in found), key=str) == contaminated(docs, items, 10)


def test_empty_sides(spark, case):
    docs, items = case
    some, none = documents(spark, docs), benchmark(spark, items).limit(0)
    index = postings.write_index(some)
    assert {r.n_hit for r in postings.contamination(postings.phrase_hits(index, none)).collect()} == {0}
    assert postings.phrase_hits(postings.write_index(some.limit(0)), benchmark(spark, items)).count() == 0
    assert postings.proximity_hits(index, none, 5).count() == 0
    assert search.rank_documents(some, none).count() == 0 and search.rank_documents(some.limit(0), benchmark(spark, items)).count() == 0
    blank = documents(spark, [(1, None), (2, "..")])
    assert search.rank_documents(blank, benchmark(spark, items)).count() == 0
    assert postings.contamination(postings.phrase_hits(postings.write_index(blank), benchmark(spark, items))).where("n_words > 0 or contaminated").count() == 0


@pytest.mark.parametrize("within", [1, 4, 12])
def test_proximity(spark, case, within):
    docs, items = [d for d in case[0] if d[0] != 9000], case[1]
    want = []
    for item, text in items:
        need = set(split(text))
        for doc, body in docs:
            w = split(body)
            spans = [(a, b) for a in range(len(w)) for b in range(a, min(len(w), a + within)) if need and need <= set(w[a : b + 1])]
            want += [(item, doc, a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)]
    found = postings.proximity_hits(postings.write_index(documents(spark, docs)), benchmark(spark, items), within, block_chars=200).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(want, key=str)


def ranked(docs, items, top):
    bags = [(k, Counter(split(t))) for k, t in docs]
    bags = [(k, b, b.total()) for k, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for k, b, n in bags:
            m = 10 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 8 * m)) for w in set(split(text)) & set(b))
            scores.append((-s, k is None, k or 0)) if s else None
        out += [(item, i + 1, None if null else k, -s) for i, (s, null, k) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("top, block", [(10, search.BLOCK_CHARS), (3, 80)])
def test_ranking(spark, case, top, block, monkeypatch):
    docs, items = case
    monkeypatch.setattr(search, "_PAIRS", 500)
    found = search.rank_documents(documents(spark, docs), benchmark(spark, items), top=top, block_chars=block).collect()
    assert sorted((tuple(r) for r in found), key=str) == ranked(docs, items, top)


def test_classes_of_one_hash(spark, case, monkeypatch):
    """Bags that share a hash stay apart."""
    docs, items = case
    real = search.F.xxhash64
    monkeypatch.setattr(search.F, "xxhash64", lambda *c: real(*c) % 2)
    found = search.rank_documents(documents(spark, docs), benchmark(spark, items)).collect()
    assert sorted((tuple(r) for r in found), key=str) == ranked(docs, items, 10)


@pytest.mark.parametrize("key", ["op12_bag_search", "op13_postings"])
def test_registered_queries(spark, data, key, monkeypatch):
    monkeypatch.setattr(oracle, "TABLES", (*oracle.TABLES, "documents", "benchmark"))
    assert oracle.difference(queries.QUERIES[key](spark, data), oracle.connect(data), queries.ORACLES[key]) is None

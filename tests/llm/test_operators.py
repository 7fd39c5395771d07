from __future__ import annotations

import hashlib
import random
import sys
import tracemalloc
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
import oracle  # noqa: E402

import corpus_pipeline  # noqa: E402
from couponlens.llm import bpe, common, egojoin, groups, imatch, langid, lines, minhash, packing, queries, suffix, tokenfile, toxicity  # noqa: E402
from couponlens.llm.common import perhaps_among, stored_tables  # noqa: E402

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, node long, rest string"


def table(spark, docs, parts=4):
    """Documents with columns that clash with the operators' own names."""
    rows = [(k, t, "en", "s", len(t or ""), "x", 7, "y") for k, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ties."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    return table(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (4, long), (5, long + " end"), (None, "a b c d e f g"), (None, None), (6, "x"), (7, "X"), (8, "\n\n")])


def edited(seed: int, n: int):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 9, 25, 45, 60, 150]))] for _ in range(12)]
    out = {}
    for i in range(n):
        b = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, max(1, len(b) // 8))):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        out[7 * i - 50] = " ".join(b[: len(b) // 2]) + "\n" + " ".join(b[len(b) // 2 :])
    return {**out, -900: "", -901: None, -902: " ", 99_999: "solo"}


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_tokens_equal_the_library(path):
    rnd = random.Random(1)
    bits = ["'", "s", "'re", "ll", " ", "  ", "\n", "a", "É", "é", "1", "22", "½", "!", "Σ", "İ", "中", "<|endoftext|>", "the", "\x00", "😀", "\x85", "Ᲊ", "_"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 60))) for _ in range(2000)] + ["a" * k for k in range(80)] + ["ab" * 3000]
    tool, library = bpe.Encoder(bpe.vocabulary(path)), Tokenizer.from_file(path)
    ids, begins = tool.encode(texts)
    for i, x in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[begins[i] : begins[i + 1]]
        assert own.tolist() == x.ids
        assert tool.decode(own).decode() == library.decode(x.ids, skip_special_tokens=False)


def test_encode_decode_tables(spark, odd, rows):
    ids = bpe.encode_tokens(odd, WORD)
    assert ids.count() == odd.count() and {len(r["ids"]) for r in rows(ids) if r["doc_id"] in (2, 3)} == {0}
    assert bpe.decode_tokens(ids, WORD).count() == odd.count()
    assert bpe.token_digest(odd.limit(0), WORD).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000)
    assert (tokenfile.unpack(tokenfile.pack(ids, bits), 1000, bits) == ids).all()
    file = tokenfile.TokenFile(tokenfile.write_file([5, None], np.array([0, 400]), ids, bits, block=64))
    assert file.doc_ids.to_pylist() == [5, None] and (file.ids(333, 777) == ids[333:777]).all()


def test_token_files(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    library, at = Tokenizer.from_file(BYTE), 0
    got = {r.doc_id: r for r in queries.QUERIES["op8_token_files"](spark, data).collect()}
    for k in sorted(docs):
        ids = np.array([*library.encode(docs[k], add_special_tokens=False).ids, 0], "<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_packing(spark, odd):
    found, sequences = packing.pack_documents(odd, WORD, end_id=1, capacity=256).collect(), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 256
    total = sum(r.length for r in found)
    assert len(sequences) <= -(-total // 256) + 1
    assert packing.pack_documents(odd.limit(0), WORD, end_id=1).count() == 0


@pytest.mark.parametrize("size, shard", [(100, 1 << 20), (20, 3000)])
def test_repeats(spark, size, shard):
    rnd = random.Random(3)
    bits = ["ab", "cd ", "é", "xyz", ". "]
    base = ["".join(rnd.choice(bits) for _ in range(300)) for _ in range(5)]
    docs = {}
    for i in range(120):
        x = rnd.choice(base)
        a = rnd.randint(0, len(x))
        docs[3 * i - 50] = x[a:] + "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) + rnd.choice(base)[: rnd.randint(0, 300)] + "q" * rnd.randint(0, 250)
    docs[9999] = None
    got = suffix.digest(suffix.remove_repeats(table(spark, docs.items()), size, shard_bytes=shard)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats(docs, size)


def test_passage_at_the_head_of_many_documents(spark, monkeypatch):
    """Its edge makes a different piece in each document under few anchors; no task gets more of them than a shard holds."""
    rnd = random.Random(12)
    head = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    docs = {i: head + "".join(rnd.choice("abcdefgh ") for _ in range(150)) + head[:130] * (i % 7 == 0) for i in range(300)}
    limit, seen = 6000, spark.sparkContext.accumulator(0)
    plain = suffix._shards

    def watched(size, limit):
        def run(batches):
            held: dict = {}
            for batch in batches:
                for h1, body in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                    held[h1] = held.get(h1, 0) + len(body)
                seen.add(sum(x > limit for x in held.values()))
                yield from plain(size, limit)([batch])

        return run

    monkeypatch.setattr(suffix, "_shards", watched)
    got = suffix.digest(suffix.remove_repeats(table(spark, docs.items()), 100, shard_bytes=limit)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats(docs, 100)
    assert seen.value == 0


def shared_ids(spark, texts):
    """Texts under three ids, one of them null, and the same by (id, hash), as the operators order them."""
    docs = [([None, 4, 9][i % 3], x) for i, x in enumerate(texts)]
    df = table(spark, [*docs, docs[0], docs[1]])
    plain = df.select(F.coalesce("doc_id", F.lit(-(1 << 63))), F.xxhash64(F.coalesce("text", F.lit(""))), "text")
    return df, {(k, h): t for k, h, t in plain.collect()}


def as_id(key):
    return None if key[0] == -(1 << 63) else key[0]


def test_repeats_of_texts_that_share_an_id(spark):
    rnd = random.Random(8)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(300)) for _ in range(4)]
    texts = [rnd.choice(base)[rnd.randint(0, 150) :] + str(i) + rnd.choice(base)[: rnd.randint(0, 300)] for i in range(40)]
    df, docs = shared_ids(spark, [*texts, None])
    want = {(as_id(k), *v) for k, v in brute.repeats(docs, 100).items()}
    got = suffix.digest(suffix.remove_repeats(df, 100)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(texts) + 3


def test_lines_of_texts_that_share_an_id(spark):
    two = spark.createDataFrame([(None, "x\ny"), (None, "y\nz")], "doc_id long, text string")
    assert sorted("".join(r.text for r in lines.dedup_lines(two).collect()).replace("\n", "")) == ["x", "y", "z"]
    df, docs = shared_ids(spark, list(edited(11, 60).values()))
    want = {(as_id(k), *v) for k, v in brute.lines(docs).items()}
    assert {(r.rest.doc_id, r.n_lines, r.n_removed, r.text) for r in lines.dedup_lines(df).collect()} == want


@pytest.mark.parametrize("words", [2, 5])
def test_near_documents(spark, words):
    docs = edited(5, 300)
    got = minhash.near_components(table(spark, docs.items()), words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near(docs, words)


def test_links_between_counts_exactly():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, rng.integers(5, 30)).astype(np.uint64)) for _ in range(60)]
    part, left = rng.integers(0, 4, 60), np.arange(60) < 25
    i, j = groups.links_between(part, left, sets)
    want = {(a, b) for a in range(60) for b in range(60) if a < b and part[a] != part[b] and left[a] != left[b] and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want


def test_lines(spark):
    docs = edited(9, 120)
    got = lines.dedup_lines(table(spark, docs.items())).collect()
    assert {r.rest.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == brute.lines(docs)


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(egojoin, "LEAF", 20)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(20, 5))
    rows = [(i, (base[rng.integers(20)] + rng.normal(size=5) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]
    rows += [(2000, None), (2001, [0.0] * 5), (2002, [1.0, None]), (2003, [float("nan")] * 5), (2004, [1.0, 2.0]), (2005, [2.0, 4.0]), (2006, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = egojoin.near_vectors(df.repartition(4)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute.vectors(rows)
    assert egojoin.near_vectors(df.limit(0)).count() == 0


def test_languages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = queries.QUERIES["op10_langid"](spark, data).where("held_out").join(docs, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert held.where("score < 0 or score > 1").count() == 0


def test_languages_of_odd_texts(odd):
    got = langid.identify(odd, learn=F.lit(True)).collect()
    assert len(got) == odd.count() and {r.lang_pred for r in got if r.doc_id in (2, 3, 8)} == {"und"}
    assert {r.lang_pred for r in langid.identify(odd, learn=F.lit(False)).collect()} == {"und"}


def test_small_language_beside_a_large_one(spark):
    """More than a million different runs of one language, all more frequent than those of the other."""
    rng = np.random.default_rng(4)
    big = ["".join(map(chr, 0x4E00 + rng.integers(0, 2000, 300_000))) for _ in range(4)]
    rows = [(i, x, "big") for i, x in enumerate(big * 2)] + [(100, "ene mene miste", "small"), (101, "ene mene", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, learn=F.lit(True)).collect()}
    assert got == {**dict.fromkeys(range(8), "big"), 100: "small", 101: "small"}


def test_language_model(spark, monkeypatch):
    rnd = random.Random(6)
    own = {"a": "abc ", "b": "bcd ", "c": "xyzaé "}
    texts = [(i, " ".join("".join(rnd.choice(own[x]) for _ in range(rnd.randint(1, 60))).split()), x) for i, x in enumerate("aaabbc" * 20)]
    texts += [texts[0], (None, "abc", "a"), (None, None, "b"), (500, "!", "c")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(docs)
    log = brute.kneser_ney([(t, x) for _, t, x in texts])
    probe = ["abc xyz", "ééé", "bcd", "q"]
    entropy, _ = model.entropies(probe)
    assert np.allclose(entropy, [[-log(x, lang) for lang in "abc"] for x in probe])
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = order(langid.identify(docs, learn=F.lit(True)))
    monkeypatch.setattr(langid, "CELLS", 200)
    assert langid.train(docs).parts > 3
    got = order(langid.identify(docs, learn=F.lit(True)))
    assert len(got) == len(texts) and [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


def test_all_documents_calibrate_languages(spark, monkeypatch):
    """The confidence and the limits are those of all 9,000 texts to learn from, repeated ones counted each."""
    rnd = random.Random(8)
    own = {"a": "abc ", "b": "bcd ", "c": "cde "}
    rows = [(i, "".join(rnd.choice(own[x]) for _ in range(rnd.randint(1, 9))), x) for i, x in enumerate("abc" * 2900)]
    rows += [*rows[:300], (None, "abc", "a"), (5, None, "a"), (6, "!", "b"), (7, "dab", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    entropy, runs = langid.train(docs).entropies([t or "" for _, t, _ in rows])
    right = np.array(["abc".find(x) if x and t is not None and n else -1 for (_, t, x), n in zip(rows, runs)])
    limits = np.array([np.quantile(entropy[right == k, k], 0.999) for k in range(3)]) + 1e-9
    known = entropy[right >= 0]
    loss = [np.log(np.exp(s * (known[np.arange(len(known)), right[right >= 0]][:, None] - known)).sum(axis=1)).sum() for s in 2.0 ** np.arange(-2, 8)]
    sharp, low = 2.0 ** (np.argmin(loss) - 2), entropy.min(axis=1)
    score = np.where(runs > 0, 1 / np.exp(sharp * (low[:, None] - entropy)).sum(axis=1), 0)
    rejected = (low > limits[entropy.argmin(axis=1)]) | (runs == 0)
    for cells in (langid.CELLS, 200):
        monkeypatch.setattr(langid, "CELLS", cells)
        got = langid.identify(docs, learn=F.lit(True)).collect()
        assert np.allclose(sorted(r.score for r in got), sorted(score)) and sum(r.rejected for r in got) == rejected.sum()


def test_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(3)
    values = {0: np.round(rng.gamma(2.0, size=5000), 2), 3: rng.random(1001) * 1e-9, 7: np.array([0.0]), 9: np.array([2.5] * 40 + [1.0])}
    given = spark.createDataFrame([(k, int(b), 1) for k, v in values.items() for b in v.view(np.int64)], "own int, bits long, n long")
    for q in (0.37, 0.999, 1.0):
        got = langid.quantiles(given, q)
        assert got.keys() == values.keys() and all(np.isclose(got[k], np.quantile(v, q), rtol=1e-12, atol=0) for k, v in values.items())


def test_comparison_of_a_family_stays_small():
    """A full pair of blocks takes some 100 MB at once."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 4000, 200).astype(np.uint64)) for _ in range(2560)]
    part, left = np.arange(2560), np.ones(2560, bool)
    packed, most = groups.stored_marks([x.tobytes() for x in sets])
    tracemalloc.start()
    try:
        i, _ = groups.links_between(part, left, sets)
        met = groups._meeting(part, left, packed, most)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert not len(i) and len(met) <= 2560 and peak < 120e6


def test_suffix_stages_leave_no_texts_behind(spark):
    """Ranges of each kind are stored on their own, so the texts' shuffle files go; pieces of large anchors do not stay."""
    passage = "".join(random.Random(3).choices("abcdefgh", k=150))
    docs = table(spark, [(i, f"{i} {passage} {i * 7}") for i in range(40)] + [(99, "none")])
    begin = stored_tables()
    got = suffix.remove_repeats(docs, size=100, shard_bytes=100)
    names = [x.rsplit("/", 1)[1].split("-")[1] for x in common._STORED[begin:]]
    assert names == ["pieces", "covered", "again"] and got.where("size(spans) > 0").count() == 39


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = queries.QUERIES["op4_toxicity"](spark, folder).where("held_out").join(labels, "doc_id")
    assert held.where("predicted = toxic").count() >= 0.97 * held.count()


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(odd, none, learn=F.lit(True)).collect()} == {0.0}


def test_fingerprints(spark, data, odd):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    assert oracle.difference(queries.QUERIES["op1_imatch"](spark, data), con, queries.ORACLES["op1_imatch"]) is None
    assert imatch.edited_fingerprints(odd).count() == odd.count()
    assert imatch.edited_fingerprints(odd.limit(0)).count() == 0


def test_odd_rows(odd):
    n = odd.count()
    assert suffix.remove_repeats(odd).count() == lines.dedup_lines(odd).count() == minhash.near_components(odd).count() == n
    empty = odd.limit(0)
    assert suffix.remove_repeats(empty).count() == lines.dedup_lines(empty).count() == minhash.near_components(empty).count() == 0


def test_pipeline_cuts_passages_of_100_bytes(spark, data):
    passage = "".join(random.Random(2).choices("abcdefgh", k=120))
    docs = table(spark, [(1, "x1 " + passage + " one"), (2, "y2 " + passage + " two")])
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, data).collect()}
    assert passage in got[1][0] and passage[5:-5] not in got[2][0] and got[2][1] == len(got[2][0])


def test_pipeline_stages(spark, data, odd):
    labels = f"{data}"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, labels).columns == odd.columns
    assert hashlib.sha256(b"").hexdigest() == brute.repeats({1: None}, 100)[1][3]


def test_marks_lose_no_pair():
    rnd = random.Random(5)
    texts = ["", "a", "abcd", "abcde", "ééééé ñ"] + ["".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    texts += [x[:-2] for x in texts[40:]] + ["x" * 5000, "x" * 4999]
    bodies = [x.encode() for x in texts]
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in texts]
    assert [len(x) for x in lines.line_sets(bodies)] == [len(x) for x in sets]
    for packed, most in (lines.line_marks(bodies), groups.stored_marks([x.tobytes() for x in lines.line_sets(bodies)])):
        for i, s in enumerate(sets):
            may = groups.may_be_similar(np.bitwise_count(packed[i] ^ packed).sum(axis=1, dtype=np.int64), most[i] + most)
            assert all(ok or 100 * len(s & t) < 80 * len(s | t) for ok, t in zip(may, sets))
    assert groups.stored_marks([])[0].shape == lines.line_marks([])[0].shape == (0, groups.MARKS // 8)


def test_perhaps_among_keeps_all_wanted(spark):
    table = spark.range(-500, 20000).select(F.col("id").alias("doc"), F.lit("x").alias("t"))
    wanted = table.where("doc % 9 = 0").select("doc")
    found = perhaps_among(table, "doc", wanted)
    assert found.columns == ["doc", "t"] and found.join(wanted, "doc").count() == wanted.count()
    assert found.count() < 1.1 * wanted.count() and perhaps_among(table, "doc", wanted.limit(0)).count() == 0


def test_dealt_pairs_give_the_lists(monkeypatch):
    rng = np.random.default_rng(4)
    value = np.concatenate([rng.integers(0, 1 << 64, 3000, np.uint64), np.repeat(rng.integers(0, 1 << 64, 200, np.uint64), 5), [np.uint64(7)] * 400])
    value = np.concatenate([value, value[:500] ^ np.uint64(1)])  # values that differ in their last bit alone
    node = rng.integers(-60, 60, len(value))
    want = {}
    for v, n in zip(value.view(np.int64).tolist(), node.tolist()):
        want.setdefault(v, set()).add(n)
    want = {(v, n, max(s), len(s) > 2) for v, s in want.items() if len(s) > 1 for n in s}
    for held in (50, 1 << 20):
        monkeypatch.setattr(groups, "_HELD", held)
        packed = [r for b in groups.dealt((value[i : i + 700], node[i : i + 700]) for i in range(0, len(value), 700)) for r in b.to_pylist()]
        assert sum(len(r["held"]) for r in packed) == 16 * len(value)
        packed.sort(key=lambda r: r["bucket"])
        got = [tuple(r.values()) for b in groups._listed([pa.RecordBatch.from_pylist(packed)]) for r in b.to_pylist()]
        assert set(got) == want and len(got) == len(want)
    assert not list(groups.dealt(iter([]))) and not list(groups._listed(iter([])))


def test_band_keys_leave_a_task_in_few_rows():
    texts = ["\n".join(f"line {i} {k} of many words" for k in range(100)) for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(300)), "text": texts})
    assert sum(b.num_rows for b in lines._banded([batch])) <= 1 << groups._DEALT < 300 * 100 * lines.BANDS


def test_similar_lines_of_any_length_share_a_band_key():
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefghijklmnop") for _ in range(6500))
    base = [long[:n] for n in (5, 6, 40, 350, 3990, 4004, 4005, 4200, 5000, 5124, 5125, 5300, 6500)] + ["abcdefgh" * 2, "abcdefgh" * 2000]
    texts = base + [x + "z" for x in base if len(x) > 5] + [x[: len(x) - len(x) // 8] for x in base] + ["", "a", "abcd", "wxyz"]
    texts = list(dict.fromkeys(texts))
    node = np.arange(len(texts))
    held = defaultdict(set)
    for value, at in lines._bands(texts, node):
        assert len(value) == len(at)
        for v, k in zip(value.tolist(), at.tolist()):
            held[k].add(v)
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in texts]
    for i, s in enumerate(sets):
        # lines shorter than a shingle have no key, and both kinds of minima are kept where either may be needed
        assert len(held[i]) == lines.BANDS * ((0 < len(s) <= 5120) + (len(s) > 4000))
        assert all(held[i] & held[j] for j, t in enumerate(sets) if s and 100 * len(s & t) >= 85 * len(s | t))
    assert sum(len(s & t) > 4000 and s != t and 100 * len(s & t) >= 80 * len(s | t) for s in sets for t in sets) > 20


def test_only_wanted_lines_send_their_bodies(spark):
    texts = [f"some line {k}\n common line \n\n{'é' * (k % 3)}" for k in range(60)]
    wanted = ["common line", "some line 7", "é", "not there"]
    bits = common.bits_of(spark.createDataFrame([(int(k),) for k in lines._nodes(wanted)], "node long"), "node")
    assert bits.nbytes == 1 << 22 and int(np.bitwise_count(bits).sum()) == len(wanted) and not common.among_bits(np.arange(9), 0 * bits).any()
    batch = pa.RecordBatch.from_pydict({"doc": list(range(60)), "text": texts, "mark": list(range(100, 160))})
    got = [r for b in lines._placed(lambda: bits)([batch, batch]) for r in b.to_pylist()]
    assert len(got) == 2 * (60 + 60 + 40) and all(r["mark"] == r["doc"] + 100 for r in got)
    assert sorted(r["body"].decode() for r in got if r["body"] is not None) == ["common line", "some line 7", "é"]
    assert {r["line"] for r in got if r["node"] == int(lines._nodes(["common line"])[0])} == {1}


def test_merged_components_equal_those_of_all_links(spark):
    rnd = random.Random(9)
    for some, few in ((80, 12), (80, 0), (0, 9)):
        links, more = ([(rnd.randrange(-60, 60), rnd.randrange(-60, 90)) for _ in range(n)] for n in (some, few))
        of = [spark.createDataFrame(x, "a long, b long") for x in (links, more)]
        want = {tuple(r) for r in common.components(of[0].unionAll(of[1])).collect()}
        got = [tuple(r) for r in groups._merged(common.components(of[0]), of[1]).collect()]
        assert set(got) == want and len(got) == len(want)


def test_toxicity_sends_only_texts_to_python(spark):
    docs = table(spark, [(k, ("vile zorblat " if k % 2 else "fine day ") * 3 + str(k)) for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels, learn=F.lit(True), carry=True).where("predicted = 1").select("rest.*")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    assert {r.doc_id for r in found.collect()} == set(range(1, 40, 2)) and found.columns == docs.columns


def test_toxicity_scores_are_the_same_with_carried_rows(spark):
    docs = table(spark, [(k, ("vile zorblat " if k % 3 else "fine day ") * (k % 4) + str(k)) for k in range(60)] + [(None, None), (3, ""), (3, ""), (7, None)])
    for toxic in (lambda k: int(k % 3 > 0), lambda k: 1):
        labels = spark.createDataFrame([(k, toxic(k)) for k in range(60)], "doc_id long, toxic int")
        plain, carried = (toxicity.score(docs, labels, learn=F.lit(True), carry=c) for c in (False, True))
        assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()
        got, want = (sorted(((r.doc_id is None, r.doc_id, r.score, r.predicted) for r in x.collect()), key=str) for x in (plain, carried))
        assert got == want and len(got) == 64


def test_bodies_of_documents_are_smaller_than_their_hashes(spark):
    rnd = random.Random(3)
    texts = ["", "Ünï çödé", "a\x00b\nc", " ".join(rnd.choice(["The", "market", "of", "Größe", "x"]) + str(rnd.randrange(40)) for _ in range(500))]
    packed = [minhash.packed(t) for t in texts]
    whole = minhash.shingle_sets(texts, 2, common.RunHash())
    assert [s.tolist() for s in minhash.packed_sets(packed, 2)] == [s.tolist() for s in whole]
    assert len(packed[-1]) < whole[-1].nbytes / 2
    base = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(base)), (1, "  ".join(base).upper()), (1, " ".join([*base, "z"])), (1, "else"), (2, " ".join([*base, "y"])), (2, " ".join([*base, "y"])), (None, " ".join(["v", *base]))]
    got = minhash.near_components(table(spark, docs), 2).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == [(0, 40, None), (1, 1, 1), (1, 39, None), (1, 39, None), (1, 40, None), (2, 40, None), (2, 40, None)]


def test_fingerprints_from_codes_of_terms(spark):
    rnd = random.Random(8)
    words = ["Über", "über", "ÜBER", "Zeta", "zeta", "ß", "😀", "￮", *(f"W{i}" for i in range(60))]
    docs = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))) for k in range(60)]
    low = {k: {"".join(c.lower() if c.isascii() else c for c in w) for w in t.split(" ")} for k, t in docs}
    df = defaultdict(int)
    for own in low.values():
        for w in own:
            df[w] += 1
    known = {w for w, n in df.items() if imatch.LOW * 60 <= n <= imatch.HIGH * 60}
    want = {}
    for k, t in docs:
        found = sorted(low[k] & known, key=str.encode)
        subsets = [[w for w in found if hashlib.md5(w.encode()).digest()[i] < b] for i, b in enumerate(imatch.BOUNDS)]
        want[k] = [hashlib.md5(" ".join(own).encode()).hexdigest()[:8] if own else imatch.EMPTY for own in subsets] if found else ["text:" + hashlib.md5(t.encode()).hexdigest()]
    frame = table(spark, docs)
    assert {r.doc_id: r.fingerprint for r in imatch.fingerprints(frame).collect()} == want
    lookup = spark.range(1).select(imatch._lookup(imatch.lexicon(frame)).alias("l")).first().l
    assert set(lookup.words) == known and lookup.words == sorted(known, key=str.encode)
    for terms, codes in zip(lookup.terms, lookup.codes):
        assert [lookup.words[c >> 16] for c in codes] == terms
        assert [c & 0xFFFF for c in codes] == [sum(1 << i for i, b in enumerate(imatch.BOUNDS) if hashlib.md5(w.encode()).digest()[i] < b) for w in terms]

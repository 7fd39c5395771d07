"""I-Match fingerprints of documents, in DataFrame and SQL functions only.

Terms whose document frequency lies in a band form the lexicon. Each of sixteen subsets of it keeps the terms for which
one byte of their MD5 is below the subset's bound; a document's distinct terms in a subset, sorted, are hashed, and the
sixteen hashes are its fingerprint. Small subsets survive edits of long documents, large ones tell short ones apart.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.common import partitions, stored

#: Bounds of the byte that decides about a subset, of 256: shares from 1/8 to 1/256 of the lexicon.
BOUNDS = (32, 32, 16, 16, 8, 8, 8, 4, 4, 4, 2, 2, 2, 1, 1, 1)
#: Share of the documents that hold a lexicon term. As a document holds a few hundred different terms on average, the
#: lexicon has at most a few hundred / LOW terms, however many documents there are.
LOW, HIGH = 0.002, 0.2
EMPTY = "-" * 8  # a subset of which the document has no term
_BUCKETS = 1 << 13
_NO_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """Distinct runs of characters other than ASCII white space; A-Z count as a-z."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(low)  # the same for ASCII alone, and faster
    return F.array_remove(F.array_distinct(F.split(low, "[\\x20\\x09-\\x0D]+")), "")


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Terms (term) that stand in at least ``low`` and at most ``high`` of all documents."""
    n = texts.agg(F.count("*").alias("n")).scalar()
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counts.where((F.col("df") >= F.lit(low) * n) & (F.col("df") <= F.lit(high) * n)).select("term")


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(_BUCKETS)).cast("int")


def _lookup(words: DataFrame) -> Column:
    """The lexicon as one constant; its size is bounded as the lexicon's is. ``words`` has the terms in their order,
    ``terms`` those of each bucket and ``codes`` theirs: the place in ``words`` before a bit for each subset."""
    md5 = F.md5("term")
    bits = [F.when(F.substring(md5, 2 * k + 1, 2) < f"{b:02x}", 1 << k).otherwise(0) for k, b in enumerate(BOUNDS)]
    lookup = {"words": [], "terms": [[] for _ in range(_BUCKETS)], "codes": [[] for _ in range(_BUCKETS)]}
    for row in words.select(_bucket(F.col("term")).alias("b"), "term", sum(bits, F.lit(0)).alias("bits")).orderBy("term").toLocalIterator():
        lookup["terms"][row.b].append(row.term)
        lookup["codes"][row.b].append(len(lookup["words"]) << len(BOUNDS) | row.bits)
        lookup["words"].append(row.term)
    return F.from_json(F.lit(json.dumps(lookup)), "words array<string>, terms array<array<string>>, codes array<array<bigint>>")


def fingerprint(text: Column, lookup: Column) -> Column:
    """Fingerprint of a text as an array of hashes; a text without any lexicon term has one hash of its whole text."""

    def code(term: Column) -> Column:
        place = F.array_position(F.get(lookup["terms"], _bucket(term)), term)
        return F.get(F.get(lookup["codes"], _bucket(term)), (place - 1).cast("int"))

    inside = F.filter(terms(text), lambda t: F.array_contains(F.get(lookup["terms"], _bucket(t)), t))
    codes = F.sort_array(F.transform(inside, code))  # numbers in the order of their terms
    bits = F.array(*[F.lit(1 << k).cast("long") for k in range(len(BOUNDS))])

    def subsets(found: Column) -> Column:
        def one(bit: Column) -> Column:
            own = F.filter(found, lambda c: c.bitwiseAND(bit) != 0)
            joined = F.array_join(F.transform(own, lambda c: F.get(lookup["words"], F.shiftright(c, len(BOUNDS)).cast("int"))), " ")
            return F.when(F.size(own) > 0, F.substring(F.md5(joined), 1, 8)).otherwise(F.lit(EMPTY))

        return F.transform(bits, one)

    def hashed(found: Column) -> Column:
        chosen = F.filter(found, lambda c: c.bitwiseAND(F.lit((1 << len(BOUNDS)) - 1).cast("long")) != 0)
        return F.when(F.size(found) > 0, F.transform(F.array(chosen), subsets)[0]).otherwise(F.array(F.concat(F.lit("text:"), F.md5(text))))

    return F.transform(F.array(codes), hashed)[0]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that either fingerprint has; 1 for equal fingerprints, 0 if neither has any."""
    used = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x["a"] != EMPTY) | (x["b"] != EMPTY)))
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x["a"] == x["b"]) & (x["a"] != EMPTY)))
    return F.when(a == b, F.lit(1.0)).when((F.size(a) != F.size(b)) | (used == 0), F.lit(0.0)).otherwise(same / used)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, fingerprint (array of strings). Null texts count as empty and, as all texts without lexicon
    terms, are told apart by their whole text; equal texts have equal fingerprints; an empty table gives no rows."""
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = stored(lexicon(given.select("text")), "lexicon")
    return given.select("doc_id", fingerprint(F.col("text"), _lookup(words)).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, and of the text whose last third is replaced by as many characters of the beginning of
    the next document, in descending order of the ids (after the last: the first).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null ids come last;
    rows that repeat id and text are one document in that order and get the same result; rows that only share an id are
    ordered by a hash of their texts; a single document is its own next one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = stored(lexicon(given.select("text")), "lexicon")
    lookup = _lookup(words)
    given = given.withColumn("th", F.xxhash64("text")).withColumn("fp", fingerprint(F.col("text"), lookup))
    # the order: ranges of ids, then places within a range, then the ranges' first rows
    ids = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ids = ids.select("doc", F.xxhash64("text").alias("th"), F.char_length("text").alias("n")).distinct()
    ids = ids.repartitionByRange(partitions(spark), F.desc("doc"), F.desc("th")).withColumn("part", F.spark_partition_id())
    ids = stored(ids, "order")
    inside = Window.partitionBy("part").orderBy(F.desc("doc"), F.desc("th"))
    me = F.struct("doc", "th")
    heads = ids.groupBy("part").agg(F.max(me).alias("head"))
    over = Window.orderBy("part")  # one row for each range
    first = F.first("head").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(over), first).alias("after"))
    order = ids.withColumn("next", F.lead(me).over(inside)).join(heads, "part")
    order = order.select(F.col("doc").alias("of"), F.col("th").alias("of_th"), "n", F.coalesce("next", "after").alias("next"))
    order = order.select("of", "of_th", F.floor(F.col("n") / 3).cast("int").alias("need"), F.col("next.doc").alias("doc"), F.col("next.th").alias("th"))
    # both joins are on the same key of the same rows, so texts and fingerprints are made and shuffled once
    begun = given.join(order, ["doc", "th"]).select(F.col("of").alias("doc"), F.col("of_th").alias("th"), F.expr("substring(text, 1, need)").alias("head"), F.col("fp").alias("next_fp"))
    begun = begun.dropDuplicates(["doc", "th"])
    n = F.char_length("text")
    joined = given.join(begun, ["doc", "th"]).withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"), "head"))
    joined = joined.withColumn("edited_fp", fingerprint(F.col("edited"), lookup))
    return joined.select(
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("fp", "").alias("fingerprint"), F.array_join("edited_fp", "").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def oracle_sql() -> str:
    """The same in DuckDB SQL over ``documents``, for unique ids that are not null."""
    bounds = " UNION ALL ".join(f"SELECT {k} AS k, {2 * k + 1} AS pos, '{b:02x}' AS below" for k, b in enumerate(BOUNDS))
    return f"""
WITH given AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ordered AS (
  SELECT doc_id, text, length(text) AS n,
    coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM given WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (SELECT doc_id, n, next_id, left(text, n - n // 3) || left(next_text, n // 3) AS edited FROM ordered),
texts AS (SELECT doc_id, 0 AS kind, text FROM given UNION ALL SELECT doc_id, 1, edited FROM edits),
words AS (
  SELECT DISTINCT doc_id, kind, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS term
  FROM texts),
lexicon AS (
  SELECT term FROM words WHERE kind = 0 GROUP BY term
  HAVING count(*) >= {LOW}::DOUBLE * (SELECT count(*) FROM given) AND count(*) <= {HIGH}::DOUBLE * (SELECT count(*) FROM given)),
inside AS (SELECT doc_id, kind, term, md5(term) AS m FROM words JOIN lexicon USING (term)),
bounds AS ({bounds}),
having_any AS (SELECT DISTINCT doc_id, kind FROM inside),
hashes AS (
  SELECT doc_id, kind, k, left(md5(string_agg(term, ' ' ORDER BY term)), 8) AS h
  FROM inside JOIN bounds ON substr(m, pos, 2) < below GROUP BY doc_id, kind, k),
filled AS (
  SELECT a.doc_id, a.kind, list(coalesce(h, '{EMPTY}') ORDER BY b.k) AS fp
  FROM having_any a JOIN bounds b ON true LEFT JOIN hashes h ON h.doc_id = a.doc_id AND h.kind = a.kind AND h.k = b.k GROUP BY a.doc_id, a.kind),
prints AS (SELECT t.doc_id, t.kind, coalesce(fp, ['text:' || md5(text)]) AS fp FROM texts t LEFT JOIN filled f ON f.doc_id = t.doc_id AND f.kind = t.kind),
paired AS (
  SELECT e.doc_id, e.n, e.edited, a.fp AS fp, b.fp AS efp, c.fp AS nfp FROM edits e
  JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1 JOIN prints c ON c.doc_id = e.next_id AND c.kind = 0),
near AS (
  SELECT *, list_zip(fp, efp) AS ze, list_zip(fp, nfp) AS zn FROM paired)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(fp, '') AS fingerprint, array_to_string(efp, '') AS edited_fingerprint,
  {_sql_likeness('fp', 'efp', 'ze')} AS near_edited, {_sql_likeness('fp', 'nfp', 'zn')} AS near_next
FROM near"""


def _sql_likeness(a: str, b: str, pairs: str) -> str:
    used = f"len(list_filter({pairs}, lambda x: x[1] <> '{EMPTY}' OR x[2] <> '{EMPTY}'))"
    same = f"len(list_filter({pairs}, lambda x: x[1] = x[2] AND x[1] <> '{EMPTY}'))"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN len({a}) <> len({b}) OR {used} = 0 THEN 0.0::DOUBLE ELSE {same}::DOUBLE / {used} END"

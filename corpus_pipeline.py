"""The corpus pipeline: stages that are applied to ``documents`` in turn, each written as Parquet and read again.

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text. Rows may hold nulls, repeat or
be empty; each operator's docstring says what then happens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.llm import lines, minhash, packing, suffix, toxicity
from couponlens.llm.common import drop_stored, ship, stored, stored_tables, table

MIN_REPEAT = 100  # bytes of a passage that the suffix stage cuts where it repeats


def _with_text(docs: DataFrame, result: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` in their order, taken from a result's struct ``rest``, with a new text and its length."""
    given = {"text": text.alias("text"), "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType if "n_chars" in docs.columns else "long").alias("n_chars")}
    return result.select(*[given[c] if c in given else F.col("rest")[c].alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity classifier rejects go; all others stay as they are."""
    ship(spark)
    found = toxicity.score(docs, table(spark, sf_dir, "labels"), learn=F.lit(True), carry=True)
    return found.where("predicted = 0").select(*[F.col("rest")[c].alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate lines one stays; a document that loses all its lines stays as an empty one."""
    ship(spark)
    return _with_text(docs, lines.dedup_lines(docs), F.col("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents (five-word shingles, similarity 0.8) the one with the smallest id stays; empty ones stay."""
    ship(spark)
    return minhash.drop_near_copies(docs, words=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``MIN_REPEAT`` bytes or more that start earlier in the corpus are cut. A cut inside a character takes the
    rest of that character too."""
    ship(spark)
    result = suffix.remove_repeats(docs, size=MIN_REPEAT, as_text=True)
    return _with_text(docs, result, F.col("kept_text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts and their places in sequences of 4096 tokens; a null or empty text is the end id alone,
    rows that repeat are packed each."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, release=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]
ORACLE_SQL = None  # the stages learn, hash and encode; SQL cannot say that


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all that the stages leave of ``documents``, as ``pack`` returns them; an empty table gives no row. Once a stage
    has written its result, the tables it worked on are deleted."""
    begin, docs = stored_tables(), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
        drop_stored(spark, since=begin, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)

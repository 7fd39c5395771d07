"""The operators applied to the driver tables under production parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.llm import bpe, egojoin, imatch, langid, lines, minhash, packing, postings, repair, search, suffix, tokenfile, toxicity
from couponlens.llm.common import ship, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def id_fold(n: int) -> Column:
    """crc32 of the document id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


@query
def op1_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, folder, "documents"))


ORACLES["op1_imatch"] = imatch.oracle_sql()


@query
def op2_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.digest(suffix.remove_repeats(table(spark, folder, "documents"), size=100))


@query
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digest(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_components(table(spark, folder, "documents"), words=2)


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = tokenfile.write_token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return tokenfile.read_token_files(files)


@query
def op9_ego_join(spark: SparkSession, folder: str) -> DataFrame:
    return egojoin.near_vectors(table(spark, folder, "embeddings"), least=0.9)


@query
def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    found = langid.identify(table(spark, folder, "documents"), learn=id_fold(4) != 2)
    return found.select("doc_id", (id_fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_lines(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, folder, "documents"))
    return out.select(F.col("rest.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"), learn=id_fold(5) != 0)
    return found.select("doc_id", (id_fold(5) == 0).alias("held_out"), "score", "predicted")


@query
def op12_bag_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_bag_search"] = search.oracle_sql()


@query
def op13_postings(spark: SparkSession, folder: str) -> DataFrame:
    index = postings.write_index(table(spark, folder, "documents"))
    return postings.contamination(postings.phrase_hits(index, table(spark, folder, "benchmark")))


ORACLES["op13_postings"] = postings.oracle_sql()


@query
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.repair(repair.damage(conversations), conversations)

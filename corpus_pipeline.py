"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestead.llm.common import BROADCAST_ROWS, materialize, unused
from orestead.llm.language import UNKNOWN, identify, learn
from orestead.llm.minhash import near_duplicates
from orestead.llm.mixing import mixed_documents
from orestead.llm.packing import pack_documents
from orestead.llm.queries import tokenizer_file
from orestead.llm.substring import remove_repeats

#: Documents less like every language's profile than this are rejected: lists of codes, symbols and the like.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those unlike every language that the labelled ones teach.

    Null and empty texts have no letters. Without any labelled document all that have letters stay. Rows count one by
    one, also where they or their ids repeat or the id is null; long texts are read whole; no rows give none. All columns
    stay as they are, whatever their names.
    """
    profiles = learn(docs)
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    pred, score = unused(docs, "lang_pred", "score")
    found = identify(docs, profiles, carry=tuple(docs.columns), names=(pred, score))
    return found.where((F.col(pred) != UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the smallest doc_id (null last), once.

    Every row is a document: different texts that share a doc_id, or have none, are told apart by the text, and of equal
    rows one stays. Null and empty texts are like nothing and stay, each of them. Long texts are compared whole; no rows
    give none. All columns stay as they are, whatever their names.
    """
    found = near_duplicates(docs, k=5, percent=80).where("group_node is not null")
    place = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"]
    copies = materialize(found.select("group_node", *place).groupBy("group_node", "none", "id", "text_hash").agg(F.count("*").alias("n")), "pipe-copies")
    best = copies.groupBy("group_node").agg(F.min(F.struct("none", "id", "text_hash")).alias("best"), F.sum("n").alias("rows")).where("rows > 1").select("group_node", "best")
    marked = copies.join(best, "group_node").select("none", "id", "text_hash", (F.struct("none", "id", "text_hash") == F.col("best")).alias("stays"))
    key = unused(docs, "none", "id", "text_hash")
    marked = materialize(marked.toDF(*key, "stays"), "pipe-marked")
    keyed = docs.withColumns(dict(zip(key, (F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text")), strict=True)))
    few = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    others = keyed.join(few(marked.select(*key)), key, "left_anti")
    once = keyed.join(few(marked.where("stays").select(*key)), key, "left_semi").dropDuplicates(key)
    return others.unionByName(once).select(*docs.columns)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of 35 words and more that occur again out of the texts; all rows stay.

    Rows are cut one by one by their own texts, also where they or their ids repeat or the id is null. Null texts stay null,
    empty ones empty; long texts are read whole; no rows give none. n_chars follows the text (null for null); other
    columns stay as they are, whatever their names.
    """
    out = remove_repeats(docs, window=35)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by their sources' target weights, some of them twice.

    A null source is a source of its own, the last; null and empty texts have no words and are taken as often as their
    source's threshold has it. Equal rows are taken one by one; no rows give none. All columns stay as they are.
    """
    return mixed_documents(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token sequences of what is left: a row per piece, as op2 has them.

    Null and empty texts are one end token. Every row is packed, also where rows or ids repeat or the id is null; texts longer
    than a sequence are cut into several; no rows give none.
    """
    return pack_documents(docs, tokenizer_file(), capacity=4096, end_id=1)


STAGES = [("language", language), ("near_duplicates", near_duplicate), ("substring", substring), ("mixing", mixing), ("packing", packing)]

#: SQL can't express tokenization, MinHash or the language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs

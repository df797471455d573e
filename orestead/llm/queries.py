"""The queries op1 to op10: each applies its operator to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import fit as fit_chat
from .chat import recover_roles, training_turns
from .fingerprint import fingerprint_neighbours
from .hnsw import nearest
from .language import held_out, identify, learn
from .minhash import near_duplicates
from .mixing import mix_sources
from .packing import pack_documents
from .shard import kd_shards
from .substring import remove_repeats_digest
from .urls import judge

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_file() -> str:
    """The public tokenizer's file; it is read in place and never copied."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(_read(spark, sf_dir, "documents"), shards=40)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_file(), capacity=4096, end_id=1)


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(_read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).drop("times")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations")
    return recover_roles(turns, fit_chat(training_turns(turns)))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats_digest(_read(spark, sf_dir, "documents"), window=35)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_read(spark, sf_dir, "pages"), URL_RULES)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), k=3, percent=85).drop("text_hash", "group_node")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


SQL_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: DuckDB SQL of the queries that it can express; texts are read whole.
SQL = {
    "op7_substring": f"""WITH d AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
 win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM d, unnest(range(1, len(w) - 33)) t(i)),
 hit AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
 gone AS (SELECT DISTINCT doc_id, p FROM hit, unnest(range(i, i + 35)) t(p)),
 flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM flat ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
 SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_minhash": f"""WITH RECURSIVE d AS (SELECT doc_id, {SQL_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 1, 2))) t(i) WHERE len(w) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
 link AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
 edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
 reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
 low AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
 SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, m) AS component_id, doc_id = least(doc_id, m) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

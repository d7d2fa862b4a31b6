"""Corpus preparation in five stages: language ID, near-duplicates, secrets, mixing, packing.

Every stage takes all documents its predecessor kept and returns the columns of ``documents``; the last returns packed
pieces with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respira.llm.common import fresh, lookup, row_key, store
from respira.llm.language_id import UNKNOWN, held_out, predictions, train
from respira.llm.minhash_dedup import near_duplicates
from respira.llm.packing import pack
from respira.llm.secret_scan import redact
from respira.llm.source_mixing import mix

#: A language must have at least this share of a document's score.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or no language with half of the score."""
    model = train(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    p = fresh(docs, "_p")
    d = docs.withColumn(p, predictions(spark, model)(F.col("text")))
    return d.filter((F.col(p)["lang_pred"] != UNKNOWN) & (F.col(p)["score"] >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (five-word shingles, similarity 0.8); of repeated rows one stays."""
    key, rows, who = (fresh(docs, c) for c in ("_key", "_rows", "_who"))
    d = docs.withColumn(key, row_key("doc_id", "text"))
    # A row's own name, as ids may be null or repeated; of a group the smallest stays, rows with an id first.
    named = d.withColumn(who, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key")))
    kept = near_duplicates(named, id_col=who).filter("kept").groupBy(F.col("doc_id.key").alias(key)).agg(F.count(F.lit(1)).alias(rows))
    d = lookup(d, store(kept), key, "inner")
    once, again = d.filter(F.col(rows) == 1), d.filter(F.col(rows) > 1).dropDuplicates([key])
    return once.unionByName(again).select(*docs.columns)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a placeholder; every document stays, with its new length."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that every source's words come to its target."""
    key, n, times = (fresh(docs, c) for c in ("_key", "_n", "_times"))
    d = docs.withColumn(key, row_key("doc_id", "text", "source"))
    taken = mix(d, id_col=key).groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias(n), F.sum("times").alias(times))
    d = lookup(d, store(taken.filter(F.col(times) > 0)), key, "inner")
    d = d.filter(F.col(n) == 1).unionByName(d.filter(F.col(n) > 1).dropDuplicates([key]))
    return d.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one row a piece."""
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", remove_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models, signatures, balanced draws and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The queries over these operators, each on its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm import (
    chat_format,
    exact_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    packing,
    quality_rules,
    spelling,
    token_counts,
    vector_groups,
)
from paritas.llm.common import crc_bucket, read
from paritas.llm.twins import TWINS

__all__ = ["QUERIES", "TWINS"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("learns"))
    rows = lm_scoring.score(docs, "learns")
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(read(spark, sf_dir, "documents"))


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], given.schema)
    turns = given.unionAll(planted).select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts"))
    return chat_format.digest(turns)


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(read(spark, sf_dir, "documents"))


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows, (size, source_size, target, copies) = mixing.joined(
        docs, mixing.allocate(docs), "size", "source_size", "target", "copies")
    return rows.select("doc_id", F.col(size).alias("size"), F.col(source_size).alias("source_size"), F.col(target).alias("target"),
                       (F.col(copies) * F.col(size)).alias("taken"), F.col(copies).alias("copies"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 0)
    content = language_id.dictionaries(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), content)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), report=("n_removed_lines",))
    return rows.select("doc_id", "n_removed_lines", F.col("n_chars").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


@query
def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.counts(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dedup.near_groups(read(spark, sf_dir, "documents"), width=4, percent=80)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_groups.near_vectors(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(read(spark, sf_dir, "documents"))
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % 199 == 0, dropped).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= 6).groupBy("word").agg(F.count("*").alias("n")).where("n >= 5")
    return spelling.variants(counts)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)

"""The operators over the whole driver tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    common, contamination, exact_copies, hard_negatives, language, mixing, near_duplicates, nearest, oracles, personal, repeats,
    spelling, token_records, urls, warc,
)

BYTE_BPE = "byte_bpe_50k.json"
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


def tokens(spark: SparkSession, docs: DataFrame, position_col: str | None = None) -> DataFrame:
    """Write the shards, read them back, drop them; the rows stay as a checkpoint."""
    common.small_batches(spark)
    folder, path = common.new_folder(spark, "tokens"), tokenizer_path()
    manifest = token_records.write(docs, folder, path, position_col=position_col)
    out = common.cut(token_records.read(spark, folder, manifest, token_records.width_of(path), position_col is not None))
    common.remove(folder)
    return out


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(_table(spark, sf_dir, "documents"), size=2, percent=80)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark, _table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    profiles = language.learn(docs.where(~F.col("held_out")))
    found = language.predict(docs.select("doc_id", "held_out", "text"), profiles)
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives, read them back, drop them; the rows stay as a checkpoint."""
    folder = common.new_folder(spark, "warc")
    names = warc.write(_table(spark, sf_dir, "pages"), folder)
    out = common.cut(warc.read(spark, folder, names).drop("url"))
    common.remove(folder)
    return out


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(_table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.report(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_near_duplicates, op2_mixing, op3_token_records, op4_decontamination, op5_url_templates,
        op6_repeated_strings, op7_language_id, op8_warc, op9_personal_data, op10_nearest,
        op11_exact_copies, op12_spelling_variants, op13_hard_negatives,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)

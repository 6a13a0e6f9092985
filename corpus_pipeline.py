"""From raw documents to token records, in five stages.

Each stage is a function of the session, the documents its predecessor kept and the
folder of the tables; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common, contamination, language, mixing, near_duplicates
from ledgerloom.llm.queries import tokens

#: The languages come from a model and the token ids from a vocabulary file: no SQL.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go, and those that are like no learned language:
    their score is under the limit that labelled documents of as many runs give.
    Where there is no language to learn from, all documents with letters stay."""
    common.small_batches(spark)
    labelled = docs.where(~language.held_out())
    profiles = language.learn(labelled)
    if not profiles.languages:
        return docs.where(language.letters(F.col("text")) > 0)
    limits = language.limits(labelled, profiles)
    name = common.free_name(docs, "found")
    found = language.predict(docs, profiles, out=name, told=True)
    return found.where(language.alike(F.col(name), limits)).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word shingles, 80 %) the document with the
    smallest id stays."""
    common.small_batches(spark)
    return near_duplicates.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold text of a benchmark item go."""
    common.small_batches(spark)
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the schedule; those of small sources come in
    as often as their weight asks for."""
    slot, place, _ = names = tuple(common.free_name(docs, c) for c in ("slot", "place", "epoch"))
    mixed = mixing.mix(docs, out=names)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, slot, place).sortWithinPartitions(slot, place).drop(*names)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shards are in the order of ids; ``position`` is the place of a record in the mix,
    which is the stored order of ``docs``. A reader that goes by it, and by the index of
    the shards, gets every source at its weight."""
    place = common.free_name(docs, "position")
    return tokens(spark, common.stored_order(docs, place), place)


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("mix", target_mix),
    ("tokens", token_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each from the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            path = common.new_folder(spark, f"stage-{place}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

"""Corpus preparation: quality rules, near-duplicates, benchmark decontamination, secrets, source mix.

Each stage takes the documents its predecessor kept; ``run`` writes every stage to the shared folder before the next reads it.
All stages but the last return the columns of documents, whatever these are beside doc_id, text, source and n_chars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscout.llm import decontaminate, mixing, rules, secrets, simhash
from linkscout.operators.storage import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The ratio is a log over hashed n-grams, the groups a graph closure, the retrieval a matrix factorisation: no SQL for them.
ORACLE_SQL = None


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` beside the whole row, so that no column name of an operator meets one of the table."""
    return docs.select("doc_id", "text", F.struct("*").alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the ratio of trusted to raw text; trusted are those labelled as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.judge(carried(docs), labels.where("quality = 1")).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, two bits): the one with the smallest id.

    Rows that repeat an id are told apart by their text; of rows that repeat both, one stays. A row without an id goes by a
    hash of its text.
    """
    keyed = carried(docs).withColumn("_id", F.coalesce("doc_id", F.xxhash64("text"))).withColumn("_text", F.xxhash64("text"))
    groups = simhash.near_duplicates(keyed, "_id", keep=("_text",)).where("doc_id = component_id")
    first = groups.groupBy(F.col("component_id").alias("_id")).agg(F.min("_text").alias("_text")).hint("merge")
    return keyed.join(first, ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"]).select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(carried(docs), benchmark, keep=("_row",)).where(F.size("items") == 0).select("_row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` counted anew."""
    found = secrets.scan(carried(docs))
    clean = secrets.redacted(F.col("text"), F.concat("base", "added"))
    changed = {"text": clean} | ({"n_chars": F.length(clean).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return found.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix with their texts, in the order of the mix, and the number of words it takes from each."""
    _, summary = mixing.mix(docs)
    taken = summary.where("taken > 0").drop("source").hint("merge")
    texts = docs.select(F.col("doc_id"), "source", "text", mixing.turn("doc_id", "text").alias("turn"))
    key = taken["doc_id"].eqNullSafe(texts["doc_id"]) & (taken["turn"] == texts["turn"])
    mixed = texts.join(taken, key).drop(taken["doc_id"], taken["turn"])
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot", "text").orderBy("first_slot", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs

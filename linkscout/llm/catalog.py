"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscout.llm import (
    decontaminate, html, machine, merkle, mixing, periods, reputation, rules, secrets, simhash, substrings, tokens, warc,
)
from linkscout.llm.common import let, words
from linkscout.operators import storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    out = rules.judge(table(spark, sf_dir, "documents"), labels.where("quality = 1"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("ratio", 6).alias("ratio"),
    )


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the label of the same id: bad if labelled as of low quality or toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    out = reputation.judge(table(spark, sf_dir, "pages"), outcomes)
    return out.select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad",
        *[(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) for c in ("mean", "bound")],
    )


@query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summary = mixing.mix(table(spark, sf_dir, "documents"))
    return summary.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("base", lambda m: m.getField("kind") == kind)).cast("long")

    return out.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder, compression="none")
    return warc.resolved(warc.read(spark, folder))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labelled rows outside a fixed fifth, which is held out."""

    def held_out(key: Column) -> Column:
        return F.crc32(key.cast("string").cast("binary")) % 5 == 0

    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    out = machine.classify(table(spark, sf_dir, "documents"), known.where(~held_out(F.col("id"))))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("items") > 0).alias("leaked"), F.size("items").cast("long").alias("n_items"), "items")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by id, are checked against a copy whose text has lost its line ends."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "source", merkle.leaf(*fields).alias("leaf"), merkle.leaf(*fields[:-1], changed).alias("claim"))
    out = merkle.prove(leaves, "source", "doc_id", "leaf").withColumn("folded_root", merkle.folded(F.col("claim"), F.col("proof")))
    return out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; in a tenth of them, by id, a stretch of words is repeated up to the end. Ids that are null plant nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(found: Column) -> Column:
        n = F.size(found)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))

        def word(w: Column, i: Column) -> Column:
            return F.when(i < a, w).otherwise(F.get(found, (a + (i - a) % p).cast("int")))

        return F.when(n > 0, F.array_join(F.transform(found, word), " ")).otherwise(F.lit(""))

    planted = F.when(h % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", planted.alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))

    def stronger(best: Column, r: Column) -> Column:
        more = r.getField("length") * best.getField("period") > best.getField("length") * r.getField("period")
        return F.when(more, r).otherwise(best)

    best = F.aggregate(F.slice("runs", 2, 1 << 30), F.get("runs", F.lit(0)), stronger).alias("best")
    spelled = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.getField("start"), r.getField("length"), r.getField("period")), F.lit("\n")))
    found = out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best, F.sha2(F.array_join(spelled, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = storage.new_folder(spark, "tokens")
    tokens.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokens.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

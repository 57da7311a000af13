"""The threshold that the data gives: labels held out, and the shares of good and bad documents kept."""

import pytest
from pyspark.sql import functions as F

from linkscout.llm import catalog, rules

SF = "/root/testdata/sf0.01"


def kept_shares(judged, labels):
    both = judged.where("not base_failed").join(labels, "doc_id").groupBy("quality")
    return {r.quality: r.share for r in both.agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


def test_query_rejects_bad(spark, tables):
    got = kept_shares(catalog.QUERIES["op5_quality_rules"](spark, SF), tables[1])
    print(got)
    assert got[1] >= 0.99 and got[0] <= 0.15


def test_held_out_labels(tables):
    """A fifth of the trusted texts is held out; labels of bad ones are never seen."""
    docs, labels = tables
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    judged = rules.judge(docs, labels.where("quality = 1").where(seen))
    got = kept_shares(judged, labels.where((F.col("quality") == 0) | ~seen))
    print(got)
    assert got[1] >= 0.97 and got[0] <= 0.2


def test_cut_leaves_the_own_text_out(spark, hard, empty):
    trusted = spark.createDataFrame([(1,), (None,)], "doc_id long")
    out = rules.judge(hard, trusted)
    assert out.count() == hard.count() and out.where("doc_id = 1 and kept").count() == 2
    counts = rules.bucket_counts(hard, trusted)
    assert rules.cut(hard, trusted.limit(0), counts) == -rules.MARGIN
    assert rules.judge(empty, trusted).count() == 0


def test_cut_takes_all_trusted_texts(spark):
    """More texts than any sample of 4,000 ids, of which few are far below the others: the share is that of all."""
    strange = [(i, " ".join(f"odd{i * 7 + j}" for j in range(60))) for i in range(100)]
    plain = [(i, " ".join(f"word{(i * 13 + j * j) % 97}" for j in range(60))) for i in range(100, 6000)]
    docs = spark.createDataFrame(strange + plain, "doc_id long, text string").repartition(4)
    trusted = docs.select("doc_id")
    counts = rules.bucket_counts(docs, trusted).localCheckpoint()
    every = rules.cut(docs, trusted, counts)
    # The same by the plain definition: every text without its own n-grams.
    each = rules.with_hashes(docs, "text").select(F.xxhash64("text").alias("t"), F.explode(F.concat("_one", "_two")).alias("h"))
    own = each.groupBy("t", F.pmod("h", F.lit(rules.BUCKETS)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    totals = counts.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    rest = own.join(own.groupBy("t").agg(F.sum("c").alias("n")), "t").join(counts, "b").crossJoin(totals)
    target, raw = (rules.share(F.col(n) - F.col("c"), F.col(f"all_{n}") - F.col("n"), rules.BUCKETS) for n in ("target", "raw"))
    scored = rest.groupBy("t").agg((F.sum(F.col("c") * rules.weight(target, raw)) / F.first("n") / rules.UNIT).alias("ratio"))
    low = scored.agg(F.percentile("ratio", F.lit(rules.QUANTILE))).first()[0]
    assert every == low - rules.MARGIN


def test_quantile_is_exact(spark):
    values = spark.range(20_001).selectExpr("cast(id * 7919 % 20011 as double) as v").localCheckpoint()
    for at in (0.0, 0.01, 0.3333, 0.5, 1.0):
        assert rules.quantile(values, "v", at) == values.agg(F.percentile("v", F.lit(at))).first()[0]
    same = spark.createDataFrame([(2.0,)] * 9 + [(3.0,)], "v double")
    assert rules.quantile(same, "v", 0.95) == same.agg(F.percentile("v", F.lit(0.95))).first()[0]
    assert rules.quantile(same.limit(0), "v", 0.5) is None

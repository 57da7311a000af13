"""Quality rules: text statistics, and the log-likelihood ratio of hashed n-grams between trusted and raw text."""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import SPACES, let, words
from linkscout.operators.storage import counted, materialise

BUCKETS = 1 << 14
#: Weights are whole multiples of this fraction, so that sums do not depend on their order.
UNIT = 1 << 20
#: Added to each bucket's count in both distributions.
PRIOR = 1.0
#: A text goes if its mean log ratio per n-gram lies this far below this share of the trusted texts, each judged without itself.
QUANTILE = 0.01
MARGIN = 0.05
#: Most trusted texts that the share is taken over: all of them.
SAMPLE = sys.maxsize
#: Ids allowed in a broadcast; they are counted first, and more of them meet the texts in a merge join.
BROADCAST_IDS = 500_000
#: Ranks by which a share of values is bracketed, on both sides.
BRACKET = 3e-4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def neighbours(hashes: Column) -> Column:
    """Hash of every pair of neighbouring elements."""
    return F.zip_with(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))), F.slice(hashes, 2, 1 << 30), lambda x, y: F.xxhash64(x, y)
    )


def repeat_words(pairs: Column) -> Column:
    """Number of words inside 3-word windows that occur at least twice, from the 64-bit hashes of all pairs of neighbours.

    Whole hashes are sorted together with their positions, so equal windows are neighbours, in a text of any length. Texts
    without a repeated window, most of them, are not sorted.
    """
    def twice(s: Column) -> Column:
        """Positions of windows that equal their predecessor or successor in ``s``."""
        same = F.zip_with(s, F.slice(s, 2, 1 << 30), lambda x, y: F.when(x.getField("h") == y.getField("h"), F.array(x.getField("i"), y.getField("i"))))
        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(same))))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def counted(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        alike = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(alike, let(let(placed, twice), covered)).otherwise(F.lit(0).cast("long"))

    return let(neighbours(pairs), counted)


def with_hashes(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_words``, and ``_one`` and ``_two``, the hashes of all words and of all pairs of neighbours."""
    one = F.transform("_words", lambda x: F.xxhash64(x))
    found = docs.withColumn("_words", words(F.col(text_col))).withColumn("_one", one)
    return found.withColumn("_two", neighbours(F.col("_one")))


def with_statistics(hashed: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return hashed.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.size(F.split(text, SYMBOLS)) - 1).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_two")),
    })


def bucket_counts(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS
) -> DataFrame:
    """``(b, raw, target)`` per bucket: its n-grams in all texts and in trusted ones.

    ``trusted`` lists ids of trusted rows of ``docs``. Counts cover every n-gram of every row; each task sends at most
    one row per bucket. The texts meet the ids in a merge join, whatever the number of ids, so they are shuffled once.
    """
    sure = trusted.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct().withColumn("_sure", F.lit(1)).hint("merge")
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(sure, "_id", "left")
    each = with_hashes(marked, "_text").select("_sure", F.explode(F.concat("_one", "_two")).alias("h"))
    bucket = bucket_of(F.col("h"), buckets).alias("b")
    counts = each.groupBy(bucket).agg(F.count(F.lit(1)).alias("raw"), F.count("_sure").alias("target"))
    spark = docs.sparkSession
    return spark.range(buckets).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").na.fill(0)


def bucket_of(h: Column, buckets: int) -> Column:
    """Number of the bucket of a hash; for a power of two its last bits are the remainder."""
    return (h.bitwiseAND(F.lit(buckets - 1).cast("long")) if buckets & (buckets - 1) == 0 else F.pmod(h, F.lit(buckets))).cast("int")


def share(count: Column, total: Column, buckets: int) -> Column:
    return (count + F.lit(PRIOR)) / (total + F.lit(PRIOR * buckets))


def weight(target: Column, raw: Column) -> Column:
    return F.round((F.log(target) - F.log(raw)) * F.lit(float(UNIT))).cast("long")


def weights(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with ``w``, the whole-number weight of each bucket: log of its share in trusted texts over its share in all."""
    listed = counts.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("b", "raw", "target"))).alias("c"),
        F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"),
    )

    def ratio(c: Column) -> Column:
        return weight(*[share(c.getField(n), F.col(f"all_{n}"), buckets) for n in ("target", "raw")])

    # Without any trusted word there is nothing to compare with, and no text is judged.
    none = F.array_repeat(F.lit(0).cast("long"), buckets)
    return listed.select(F.when(F.col("all_target") > 0, F.transform("c", ratio)).otherwise(none).alias("w"))


def own_total(buckets_of: Column, copies: Column, all_raw: Column, all_target: Column, buckets: int) -> Column:
    """Sum of the weights of a text's n-grams, in whole numbers, by the counts without the ``copies`` of the text.

    The sorted buckets of its n-grams are read as runs; ``_raw`` and ``_target`` hold the counts by bucket.
    """
    def summed(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        # What all runs of a text share is computed once, as lambdas are interpreted.
        totals = [F.greatest(every - copies * n, F.lit(0)) + F.lit(PRIOR * buckets) for every in (all_raw, all_target)]
        held = F.struct(F.col("_raw").alias("raw"), F.col("_target").alias("target"), *[t.alias(f"n{i}") for i, t in enumerate(totals)])

        def runs(p: Column, c: Column) -> Column:
            ends = F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(n))

            def one(first: Column, end: Column) -> Column:
                def without(name: str, total: str) -> Column:
                    rest = F.greatest(F.get(c.getField(name), F.get(s, first)) - copies * (end - first), F.lit(0))
                    return (rest + F.lit(PRIOR)) / c.getField(total)

                return (end - first) * weight(without("target", "n1"), without("raw", "n0"))

            return F.aggregate(F.zip_with(p, ends, one), F.lit(0).cast("long"), lambda a, x: a + x)

        return let(starts, lambda p: let(held, lambda c: runs(p, c)))

    return let(F.sort_array(buckets_of), summed)


def quantile(values: DataFrame, name: str, at: float) -> float | None:
    """The share ``at`` of a written column, between its neighbours in order; None without a value.

    Only values between two approximate shares around it are put in order; the others are counted.
    """
    around = [max(0.0, at - BRACKET), min(1.0, at + BRACKET)]
    n, (low, high) = values.agg(F.count(name), F.coalesce(F.percentile_approx(name, around, 10_000), F.array(F.lit(0.0), F.lit(0.0)))).first()
    if not n:
        return None
    rank = at * (n - 1)
    wanted = [math.floor(rank), math.ceil(rank)]
    value = F.col(name)
    below = values.where(value < low).count()
    # The bracket holds both ranks but for an unlucky estimate; then all values are put in order.
    for before, inside in ((below, value.between(low, high)), (0, value.isNotNull())):
        found: list[float] = []
        for row in values.where(inside).groupBy(name).count().orderBy(name).toLocalIterator() if before <= wanted[0] else ():
            before += row["count"]
            found += [row[name]] * sum(w < before for w in wanted[len(found):])
            if len(found) == 2:
                break
        if len(found) == 2:
            break
    if wanted[0] == wanted[1] or found[0] == found[1]:
        return found[0]
    return (wanted[1] - rank) * found[0] + (rank - wanted[0]) * found[1]


def cut(
    docs: DataFrame, trusted: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
) -> float:
    """The threshold by the data: the QUANTILE of the ratios of all trusted texts, less MARGIN.

    A trusted text adds to the counts it is judged by, so its own n-grams and those of its copies are left out of both. Each text
    is judged within its row, whatever the number of texts. Texts below ``min_words`` do not count. Without trusted texts, which
    give a ratio of 0 to all, it is -MARGIN.
    """
    ids, n = counted(trusted.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct())
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids.hint("merge")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(ids, "_id", "left_semi")
    hashed = with_hashes(texts.groupBy("_text").agg(F.count(F.lit(1)).alias("_copies")), "_text")
    listed = counts.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("b", "raw", "target"))).alias("c"),
        F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"),
    )
    table = listed.select(F.struct(F.col("c.raw").alias("raw"), F.col("c.target").alias("target"), "all_raw", "all_target"))
    held = hashed.withColumn("_c", table.scalar()).select(
        "_copies", F.transform(F.concat("_one", "_two"), lambda h: bucket_of(h, buckets)).alias("_own"),
        F.col("_c.raw").alias("_raw"), F.col("_c.target").alias("_target"), F.col("_c.all_raw").alias("_all_raw"), F.col("_c.all_target").alias("_all_target"),
    )
    total = own_total(F.col("_own"), F.col("_copies"), F.col("_all_raw"), F.col("_all_target"), buckets)
    # n words give 2n - 1 n-grams. Short texts are told by these, so that no text is cut into words twice.
    long = F.size("_own") >= max(2 * min_words - 1, 1)
    ratios = materialise(held.select(F.when(long, total / F.size("_own") / UNIT).alias("ratio")))
    low = quantile(ratios, "ratio", QUANTILE)
    return (low or 0.0) - MARGIN


def judge(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
    threshold: float | None = None, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Every row and column of ``docs`` with the statistics, ``ratio``, ``base_failed`` and ``kept``.

    ``ratio`` is the mean log-likelihood ratio per word and pair of neighbours; a row is kept if it passes the base rules
    and its ratio is at least ``threshold``, or with None at least the ``cut`` that the data gives. The comparison is made in
    whole numbers, so equal texts are judged alike in every run. Null and empty texts have no words, a ratio of 0, and fail the base rules. A null id is never trusted. The
    result has columns of ``docs`` followed by the ones named here; a column of the same name is replaced.
    """
    counts = bucket_counts(docs, trusted, id_col, text_col, buckets)
    if threshold is None:
        counts = materialise(counts)
        threshold = cut(docs, trusted, counts, id_col, text_col, buckets, min_words)
    table = weights(counts, buckets)
    total = F.aggregate(
        F.concat("_one", "_two"), F.lit(0).cast("long"), lambda a, h: a + F.get(F.col("_w"), bucket_of(h, buckets))
    )
    whole = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    counted = with_statistics(with_hashes(whole, "_text"), "_text").withColumn("_w", table.scalar()).withColumn("_total", total)
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    fails = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    limit = round(threshold * UNIT)
    judged = counted.withColumn("base_failed", fails).withColumns({
        "kept": ~F.col("base_failed") & (F.col("_total") >= F.lit(limit) * n_grams),
        "ratio": F.when(n_grams > 0, F.col("_total") / n_grams / F.lit(float(UNIT))).otherwise(0.0),
    })
    # One generated row each: a filter on a result would else be moved below it and repeat all that led to it.
    held = judged.select("_row", F.inline(F.array(F.struct(*RESULTS))))
    return held.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in RESULTS], *RESULTS)

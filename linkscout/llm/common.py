"""Words, hashes and connected components shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.operators.storage import materialise

SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and empty texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner != "", F.split(inner, SPACE_CLASS)).otherwise(F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though ``body`` uses it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hash of each word given as bytes. ``bytes.split()`` cuts at exactly the six characters of SPACE_CLASS."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit factors from a seed, for hashes of word windows."""
    return np.array([xxhash.xxh64_intdigest(b"factor %d" % i, seed) | 1 for i in range(n)], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a sum, so that partitions by hash come out even."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(h: np.ndarray, factors: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the windows of ``len(factors)`` consecutive words that start ``at``. A difference in one word always shows."""
    total = np.zeros(len(at), dtype=np.uint64)
    for j, f in enumerate(factors):
        total += h[at + j] * f
    return mixed(total)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``(u, v)``: one row ``(node, root)`` per linked node, the root its smallest node.

    Alternating large-star and small-star steps, which turn every component into a star around its smallest node in a
    number of rounds that grows with the logarithm of its size. Minima are combined before the shuffle; the joins back
    are plain equi-joins, whose outsized partitions Spark splits. Links stay on the executors, each round is written to
    the shared folder, and the driver sees one row of totals.
    """
    edges = materialise(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

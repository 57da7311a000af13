"""Equi-join that splits hot keys on both sides."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of one key that one task is asked to join.
ROWS_PER_TASK = 200_000
#: A key is split if it holds more than this part of its table, and more than ROWS_PER_TASK rows. So at most this many keys
#: are split on either side, whatever the size of the tables.
MOST_HOT = 100_000
NULL_SALTS = 1024
#: Rows of either side that one call of a function on groups of keys gets, and groups there are for each shuffle partition at least.
ROWS_PER_GROUP = 50_000
GROUPS_PER_PARTITION = 2


def _content(df: DataFrame, salts: Column) -> Column:
    """Salt from the row's content, so a task that is run again assigns the same salt."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), salts).cast("int")


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, _n)``: rows per key; partial sums per task. Give the key columns of a base table where ``df`` costs more."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def hot_keys(counts: tuple[DataFrame | None, DataFrame | None], keys: list[str], rows_per_task: int) -> DataFrame | None:
    """``(keys, _a, _b)``: keys to split and the number of salts of either side; None if no key is to be split.

    ``counts`` holds the rows per key of the left and the right side, as by :func:`key_counts`, or None for a side that is not
    split. One job finds the total and the largest key of both, one row for the driver. Only if a key is large are keys
    looked up.
    """
    known = [None if c is None else c.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])) for c in counts]
    sides = [c.agg(F.lit(i).alias("side"), F.max("_n").alias("most"), F.sum("_n").alias("total")) for i, c in enumerate(known) if c is not None]
    hot = []
    for row in reduce(DataFrame.unionByName, sides).collect() if sides else []:
        limit = max(rows_per_task, -(-(row.total or 0) // MOST_HOT))
        if (row.most or 0) > limit:
            salts = F.ceil(F.col("_n") / limit).cast("int").alias(("_a", "_b")[row.side])
            hot.append(known[row.side].where(F.col("_n") > limit).select(*keys, salts))
    if not hot:
        return None
    every = hot[0] if len(hot) == 1 else hot[0].join(hot[1], keys, "full")
    return every.select(*keys, *[F.coalesce(F.col(c) if c in every.columns else F.lit(None), F.lit(1)).cast("int").alias(c) for c in ("_a", "_b")])


def skewed_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", rows_per_task: int = ROWS_PER_TASK,
    left_counts: DataFrame | int | None = None, right_counts: DataFrame | int | None = None,
) -> DataFrame:
    """Inner or left equi-join in which each hot key is spread over as many tasks as its counted rows need.

    A key with a salts on the left and b on the right becomes a grid of a times b joins; each row gets one salt of its own
    side and is repeated over those of the other. In a left join only the left side is split, and rows without a key are
    spread as well. The split keys are at most 2 * MOST_HOT small rows, which bounds the broadcast. Without a hot key it is
    the plain join.

    Keys are counted once, here: from ``left_counts`` and ``right_counts`` (rows per key, or an upper bound), or from the
    inputs if none are given. A number is a bound for every key, such as the rows of a written table; a side whose bound is
    within a task is not counted at all.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot split a {how} join")

    def counts(df: DataFrame, known: DataFrame | int | None) -> DataFrame | None:
        if isinstance(known, int):
            return None if known <= rows_per_task else key_counts(df, keys)
        return key_counts(df, keys) if known is None else known

    hot = hot_keys((counts(left, left_counts), counts(right, right_counts) if how == "inner" else None), keys, rows_per_task)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    if hot is None and how == "inner":
        return left.join(right, keys)
    if hot is None:
        # Rows without a key would meet in one task.
        spread = F.when(no_key, _content(left, F.lit(NULL_SALTS))).otherwise(0)
        return left.withColumn("_s", spread).join(right.withColumn("_s", F.lit(0)), [*keys, "_s"], how).drop("_s")
    hot = F.broadcast(hot)
    a, b = F.coalesce("_a", F.lit(1)), F.coalesce("_b", F.lit(1))
    if how == "left":
        a = F.when(no_key, F.lit(NULL_SALTS)).otherwise(a)

    def every(salts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), salts - 1))

    salted = left.join(hot, keys, "left").withColumn("_s", _content(left, a)).withColumn("_t", every(b)).drop("_a", "_b")
    spread = right.join(hot, keys, "left").withColumn("_t", _content(right, b)).withColumn("_s", every(F.coalesce("_a", F.lit(1))))
    return salted.join(spread.drop("_a", "_b"), [*keys, "_s", "_t"], how).drop("_s", "_t")


def cogrouped(
    left: DataFrame, right: DataFrame, key: str, run: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType, left_rows: int, right_rows: int,
    together: str | None = None, rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """The tables that ``run`` makes of the left and right rows of groups of keys, put together.

    A group holds whole keys, about ``rows_per_group`` rows of either side. Keys with more rows than that are split as in
    :func:`skewed_join`, so ``run`` must give the same for a key's rows in parts; left rows that agree in the column ``together`` stay in one
    part. ``left_rows`` and ``right_rows`` are the rows of both sides.
    """
    sides = (left, left_rows), (right, right_rows)
    hot = hot_keys(tuple(key_counts(df, [key]) if n > rows_per_group else None for df, n in sides), [key], rows_per_group)
    groups = max(GROUPS_PER_PARTITION * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-max(left_rows, right_rows) // rows_per_group))
    parts = [F.col(key)]
    if hot is not None:
        hot, parts = F.broadcast(hot), [F.col(key), F.col("_s"), F.col("_t")]
        a, b = F.coalesce("_a", F.lit(1)), F.coalesce("_b", F.lit(1))
        own = _content(left.select(together) if together else left, a)
        left = left.join(hot, key, "left").withColumn("_s", own).withColumn("_t", F.explode(F.sequence(F.lit(0), b - 1))).drop("_a", "_b")
        right = right.join(hot, key, "left").withColumn("_t", _content(right, b)).withColumn("_s", F.explode(F.sequence(F.lit(0), a - 1))).drop("_a", "_b")
    group = F.pmod(F.xxhash64(*parts), F.lit(groups)).cast("int")
    # Parts of one key that share a group must not meet there.
    apart = ["_group"] if hot is None else ["_group", "_s", "_t"]
    sides = [df.withColumn("_group", group).groupBy(*apart) for df in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def read_spread(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read parquet; a table of fewer splits than cores is redistributed, as the work per row is high here."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    cores = min(16, spark.sparkContext.defaultParallelism)
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

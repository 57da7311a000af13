"""Mix of sources to target weights: a low-discrepancy schedule of slots over blocks of equally many words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout.llm.common import words
from linkscout.operators.storage import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 1000
#: Blocks grow beyond BLOCK_WORDS where a schedule would have more slots than about this: points of RANGE places tell no more apart.
MOST_SLOTS = 1 << 27
#: Points of the schedule are ``i * STEP mod RANGE`` with STEP / RANGE near the golden ratio, exact in whole numbers.
RANGE = 1 << 31
STEP = 1327217885
CHUNK = 1 << 16


def turn(id_col: str, text_col: str) -> Column:
    """A row's place in the shuffle of its source, by id and text."""
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.size(words(text)).cast("long").alias("size"),
        turn(id_col, text_col).alias("turn"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``(source, source_size, s, target)`` per source, ``s`` its place by code point with null last.

    Each source gets a level times its weight, stopped at ``most`` times its size; the level is the one at which all
    targets add up to ``share`` times all sizes. Sources are few against rows: they were summed per task, and this small
    table is ordered in one.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    n = len(weights)
    weighed = sizes.withColumn("s", place).withColumn(
        "w", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") - 1) % n)
    )
    # Sources reach their limit in the order of limit over weight.
    order = Window.orderBy(F.col("source_size") / F.col("w"), "s")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    limit, every = F.lit(most) * F.col("source_size"), Window.orderBy(F.lit(1)).rowsBetween(*[Window.unboundedPreceding, Window.unboundedFollowing])
    levels = weighed.withColumns({
        "level": (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("w").over(rest),
        "limit": limit,
    })
    fits = F.when(F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))
    level = F.max(F.col("first_level")).over(every)
    first = F.when(F.row_number().over(Window.orderBy(fits.isNull(), F.col("source_size") / F.col("w"), "s")) == 1, fits)
    return levels.withColumn("first_level", first).withColumn("final", level).select(
        "source", "source_size", "s", F.least(F.col("limit"), F.col("final") * F.col("w")).alias("target")
    )


def starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the words of the source before a row in shuffled order.

    The order is that of a hash; sums over ranges of the hash come first, so no task holds a whole source.
    """
    ranged = rows.withColumn("part", F.substring("turn", 1, 3))
    sums = ranged.groupBy("s", "part").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("s", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "part").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["s", "part"]).withColumn(
        "start", F.col("base") + F.col("inside")
    ).drop("part", "inside", "base")


def schedule(sources: DataFrame) -> DataFrame:
    """``(s, block, slot)``: when each block of each source is taken.

    ``sources`` has ``(s, blocks)``. Slot ``i`` stands at the golden-ratio point ``i * STEP mod RANGE``, mapped through the
    sources' cumulative block counts. Among 2n + 2 points no gap is as wide as one of n equal parts, so each part is met;
    its first slot counts. Slots of a source are ranked by time, in chunks, and the k-th takes the source's block k.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    point = F.pmod("id", F.lit(RANGE)) * F.lit(STEP) % F.lit(RANGE)
    slots = spark.range(2 * total + 2).select(F.col("id").alias("slot"), F.floor(point * F.lit(total) / F.lit(RANGE)).alias("part"))
    first = slots.groupBy("part").agg(F.min("slot").alias("slot"))
    ahead = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sources.where("blocks > 0").withColumn("base", F.coalesce(F.sum("blocks").over(ahead), F.lit(0)))
    chunks = ranges.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / CHUNK))))
    last = F.least(F.col("blocks"), (F.col("chunk") + 1) * CHUNK) - 1
    each = F.explode(F.sequence(F.col("base") + F.col("chunk") * CHUNK, F.col("base") + last))
    parts = chunks.repartition("s", "chunk").select("s", each.alias("part"))
    owned = parts.join(first, "part").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = owned.groupBy("s", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("s", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("s", "chunk").orderBy("slot")) - 1
    return owned.withColumn("rank", rank).join(base, ["s", "chunk"]).select("s", (F.col("base") + F.col("rank")).alias("block"), "slot")


def block_rows(rows: DataFrame, block: Column) -> DataFrame:
    """``(s, start, block, from_word, n_taken)``: the words each row gives to each block of its source's repeated stream."""
    repeats = F.explode(F.sequence(F.lit(0), F.ceil(F.col("target") / F.col("source_size")).cast("int") - 1))
    passes = rows.where((F.col("size") > 0) & (F.col("target") >= 1)).withColumn("repeat", repeats)
    lo = F.col("repeat") * F.col("source_size") + F.col("start")
    spans = passes.withColumn("lo", lo).withColumn("hi", F.least(F.col("lo") + F.col("size"), F.floor("target"))).where("hi > lo")
    each = spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    begin = F.greatest(F.col("lo"), F.col("block") * block)
    end = F.least(F.col("hi"), (F.col("block") + 1) * block)
    return each.select("doc_id", "s", "start", "block", (begin - F.col("lo")).alias("from_word"), (end - begin).alias("n_taken"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The mixed order and its summary.

    The order has ``(slot, source place s, block, doc_id, start, from_word, n_taken)``: which words of which row stand at
    which slot. The summary has ``(doc_id, source, turn, size, source_size, target, taken, first_slot)`` per row of ``docs``, the last
    null for rows that give nothing. A source gives
    its target to the word: the blocks of its shuffled words, repeated from the start until the target is reached, the
    last one cut there. No row gives more than ``most`` times its words.

    Null sources are one source, the last by order; null and empty texts have size 0 and give nothing. Repeated rows are
    separate rows. The shuffle is a hash of id and text, so reruns agree. An empty table gives empty results.
    """
    rows = materialise(_rows(docs, id_col, text_col, source_col))
    aims = materialise(targets(rows, weights, share, most))
    named = rows.join(aims, rows.source.eqNullSafe(aims.source)).drop(aims.source)
    placed = materialise(starts(named))
    total = aims.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0))).first()[0]
    block = F.lit(max(block_words, -(-total // MOST_SLOTS)))
    slots = schedule(aims.select("s", F.ceil(F.floor("target") / block).alias("blocks")))
    order = block_rows(placed, block).join(slots, ["s", "block"])
    taken = order.groupBy("s", "start").agg(F.sum("n_taken").alias("taken"), F.min("slot").alias("first_slot"))
    # An empty row stands where the next one starts.
    given = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    slot = F.when(F.col("size") > 0, F.col("first_slot")).alias("first_slot")
    summary = placed.join(taken, ["s", "start"], "left").select(
        "doc_id", "source", "turn", "size", "source_size", "target", given.alias("taken"), slot
    )
    return order, summary

"""Merkle manifest of a dataset: blocks keep each level of the tree as one string, substrings of which are hashed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscout.llm.common import let
from linkscout.operators.storage import materialise

FAN = 3
#: Levels of the tree inside one block, which holds FAN ** LEVELS nodes at most.
LEVELS = 7
WIDTH = FAN**LEVELS
#: Characters of a digest.
HEX = 64
ROW_BITS = 33


def leaf(*columns: Column) -> Column:
    """Digest of a row: of each column ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    values = [c.cast("string") for c in columns]
    parts = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]
    return F.sha2(F.concat(*parts), 256)


def parents(level: Column) -> Column:
    """The next level: digests of every FAN consecutive nodes, the last ones fewer. Both are the bytes of one hex string."""
    size = FAN * HEX
    starts = F.sequence(F.lit(1), F.octet_length(level), F.lit(size))
    return F.array_join(F.transform(starts, lambda at: F.sha2(F.substring(level, at, F.lit(size)), 256)), "").cast("binary")


def beside(levels: Column, place: Column) -> Column:
    """``array<struct<left, right>>``: on each level below the last, the siblings on both sides of the node above ``place``."""
    powers = F.array(*[F.lit(FAN**i) for i in range(LEVELS)])

    def on(level: Column, i: Column) -> Column:
        node = F.floor(place / F.get(powers, i)).cast("int")
        run, after = node - node % FAN, (node + 1) * HEX
        return F.struct(
            F.substring(level, run * HEX + 1, (node - run) * HEX).alias("left"),
            F.substring(level, after + 1, (run + FAN) * HEX - after).alias("right"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), on)


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof in one string, level by level, left to right."""
    nothing = F.lit("").cast("binary")
    return F.aggregate(proof, nothing, lambda done, s: F.concat(done, s.getField("left"), s.getField("right")))


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of a proof."""
    return F.aggregate(
        proof, digest, lambda node, s: F.sha2(F.concat(s.getField("left"), node.cast("binary"), s.getField("right")), 256)
    )


def numbered(rows: DataFrame, group: str, order: list[str], ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``pos``, the row's place in its group by ``order`` and then ``ties``, and ``n``, the group's rows.

    Rows are dealt by ranges of group and order, so a group of any size lies in many tasks. A place is the row's number in
    its written range, less the rows of other groups there, and the group's rows in earlier ranges; these are summed over
    one row per range and group.
    """
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order, *ties)
    placed = materialise(ranged.select("*", F.spark_partition_id().alias("_part"), number.alias("_i")))
    each = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = each.select(group, "_part", (before - F.col("_first")).alias("_start"), F.sum("_n").over(whole).alias("n"))
    return placed.join(starts, [group, "_part"]).withColumn("pos", F.col("_i") + F.col("_start")).drop("_i", "_start", "_part")


def blocks(nodes: DataFrame, carry: str) -> DataFrame:
    """``(g, block, n, levels, members)`` per aligned block of ``(g, pos, n, node, carry)``.

    A group of several blocks climbs exactly LEVELS levels in each, a group of one until a single node is left.
    """
    here = nodes.groupBy("g", F.floor(F.col("pos") / WIDTH).alias("block"), "n")
    found = here.agg(F.sort_array(F.collect_list(F.struct("pos", "node", carry))).alias("sorted"))
    first = F.array_join(F.transform("sorted", lambda m: m.getField("node")), "").cast("binary")

    def climb(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when((F.col("n") > WIDTH) | (F.octet_length(top) > HEX), F.concat(levels, F.array(parents(top)))).otherwise(levels)

    levels = F.aggregate(F.array(*[F.lit(i) for i in range(LEVELS)]), F.array(first), climb)
    members = F.transform("sorted", lambda m: m.getField(carry)).alias("members")
    return materialise(found.select("g", "block", "n", levels.alias("levels"), members))


def tops(table: DataFrame) -> DataFrame:
    """The last node of each block, as the nodes of the next blocks."""
    return table.select(
        "g", F.col("block").alias("pos"), F.ceil(F.col("n") / WIDTH).alias("n"), F.element_at("levels", -1).cast("string").alias("node"),
        F.lit(None).cast("string").alias("none"),
    )


def tree(nodes: DataFrame, carry: str) -> list[DataFrame]:
    """Block tables from the leaves up, until each group has one block. The driver sees one number a round."""
    tables = [blocks(nodes, carry)]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > WIDTH:
        tables.append(blocks(tops(tables[-1]), "none"))
    return tables


def below(table: DataFrame, above: DataFrame, name: str) -> DataFrame:
    """``(g, name, pos, above)`` per member of the blocks, its proof going on with the one ``above`` its block."""
    table = table.join(above.withColumnRenamed("pos", "block"), ["g", "block"])

    def member(m: Column, i: Column) -> Column:
        path = F.concat(beside(F.col("levels"), i), F.col("above.proof"))
        up = F.struct(path.alias("proof"), F.col("above.subroot").alias("subroot"), F.col("above.root").alias("root"))
        return F.struct(m.alias(name), (F.col("block") * WIDTH + i).alias("pos"), up.alias("above"))

    return table.select("g", F.inline(F.transform("members", member)))


def descend(tables: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The proof of every leaf, from ``above``: one row ``(g, above)`` per group. Only blocks are joined, never leaves."""
    above = above.withColumn("pos", F.lit(0).cast("long"))
    for table in reversed(tables):
        above = below(table, above, name).select("g", "pos", "above", name)
        last = above
        above = above.select("g", "pos", "above")
    return last.drop("pos")


def prove(rows: DataFrame, group_col: str, order_col: str, leaf_col: str) -> DataFrame:
    """Every row and column of ``rows`` with ``subroot``, ``root`` and ``proof``.

    Leaves of a group ascend by ``order_col``; FAN consecutive nodes become the digest of their concatenated hex digests, the
    last ones of a level fewer, until one is left, the group's subroot (a lone leaf itself). Subroots in order of their
    groups give the root in the same way. A proof lists the siblings ``left`` and ``right`` of the leaf's node, level by level.

    A null group is a group, the first one; rows with a null in ``order_col`` come first in theirs; ties and repeated rows are
    ordered by their leaf and their other columns. Columns ``subroot``, ``root`` and ``proof`` of ``rows`` are replaced. An
    empty table gives an empty result. Groups of any size are split in blocks; a task holds one block at a time.
    """
    own = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    keyed = rows.select(group.alias("g"), F.col(order_col).alias("at"), F.col(leaf_col).alias("node"), F.struct(*own).alias("row"))
    # Written, as the ranges are drawn from a first pass over the rows, which would compute the leaves once more.
    leaves = tree(numbered(materialise(keyed), "g", ["at", "node"], ("row",)), "row")
    subroots = tops(leaves[-1]).select(F.lit("").alias("g"), F.col("g").alias("name"), "node")
    groups = tree(numbered(subroots, "g", ["name"]), "name")
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    root = tops(groups[-1]).select("g", F.struct(none.alias("proof"), F.lit("").alias("subroot"), F.col("node").alias("root")).alias("above"))
    named = descend(groups, root, "name").select(F.col("name").alias("g"), F.col("above").alias("up"))
    subroot = tops(leaves[-1]).select("g", F.col("node").alias("subroot"))
    top = F.struct(F.col("up.proof").alias("proof"), F.col("subroot").alias("subroot"), F.col("up.root").alias("root"))
    proved = descend(leaves, named.join(subroot, "g").select("g", top.alias("above")), "row")
    return proved.select("row.*", "above.subroot", "above.root", "above.proof")

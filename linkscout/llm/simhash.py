"""Near-duplicate documents by SimHash, with pivot distance tables to find fingerprints a few bits apart."""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import components
from linkscout.operators.storage import materialise

BITS = 64
GROUPS = 5
REFERENCES_PER_GROUP = 8
#: Buckets of the distance table up to this size are compared pair by pair; larger ones go through midpoints.
BUCKET = 48


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: a bit is set if it is set in more than half of the shingle hashes, repeats included.

    Letters A-Z are lower-cased. Fewer words than ``shingle`` form one shingle; no words give 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        grams = [b" ".join(found)]
    else:
        grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, seed) for g in grams], dtype=">u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row ``(doc_id, fp, *keep)`` per row of ``docs``. A null text counts as empty; a null id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [signed(fingerprint(t or b"", shingle, seed)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *keep])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *keep)
    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, "doc_id long, fp long" + kept)


def bit_groups() -> list[list[int]]:
    edges = [BITS * g // GROUPS for g in range(GROUPS + 1)]
    return [list(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]


def references(seed: int = 7) -> list[list[int]]:
    """The reference fingerprints, by bit group: random subsets of the group's bits. Zero is one more, before them."""
    draw = random.Random(seed)
    return [[sum(1 << b for b in draw.sample(g, len(g) // 2)) for _ in range(REFERENCES_PER_GROUP)] for g in bit_groups()]


def distances(fp: Column) -> Column:
    """Row of the pivot table: the Hamming distances of a fingerprint to all references."""
    pivots = F.array(*[F.lit(signed(p)) for p in [0, *sum(references(), [])]])
    return F.transform(pivots, lambda p: F.bit_count(fp.bitwiseXOR(p)))


def table_keys(table: Column, radius: int) -> Column:
    """Keys of the pivot table that fingerprints within ``radius`` bits must share at least one of.

    The distance to a reference less the distance to zero depends on the bits of that reference's group alone, so a
    changed bit moves the coordinates of one group. Among any ``radius`` changed bits, ``GROUPS - radius`` groups keep
    all their coordinates; there is one key for each choice of these groups.
    """
    own = F.transform(table, lambda d: d - F.get(table, F.lit(0)))
    size = REFERENCES_PER_GROUP
    choices = list(combinations(range(GROUPS), GROUPS - radius))
    return F.array(*[
        F.xxhash64(F.lit(i), *[F.slice(own, 2 + g * size, size) for g in choice]) for i, choice in enumerate(choices)
    ])


def farthest(x: Column, y: Column) -> Column:
    """Largest difference of two fingerprints' distances to any reference; never above their own distance."""
    return F.array_max(F.zip_with(distances(x), distances(y), lambda a, b: F.abs(a - b)))


def links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(u, v)`` that join all distinct fingerprints ``fp`` within ``radius`` (at most 2) bits, as components.

    Buckets of the pivot table up to BUCKET members are paired; pairs are discarded by the largest coordinate difference,
    survivors are verified. A larger bucket would give all pairs of a large group of near copies. There, two fingerprints
    are within two bits exactly if both lie within one bit of a common midpoint, so members are linked to the smallest
    member around each midpoint: 65 rows a member, at most 65 members a midpoint, and no link of a component is lost.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    table = nodes.select("fp", distances(F.col("fp")).alias("table"))
    keyed = materialise(table.select("fp", F.explode(table_keys(F.col("table"), radius)).alias("k")))
    sizes = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(keyed.join(sizes, "k"))
    few = shared.where(F.col("n") <= BUCKET)
    pairs = few.select("k", F.col("fp").alias("u")).join(few.select("k", F.col("fp").alias("v")), "k").where("u > v")
    kept = pairs.select("u", "v").distinct().where(farthest(F.col("u"), F.col("v")) <= radius)
    verified = kept.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    crowd = shared.where(F.col("n") > BUCKET).select("fp").distinct()
    if radius == 2:
        around = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << b))) for b in range(BITS)]]
        ball = crowd.select("fp", F.explode(F.array(*around)).alias("z"))
        centre = ball.groupBy("z").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
        close = ball.join(centre, "z").select(F.col("fp").alias("u"), "v")
    else:
        flips = [F.col("fp").bitwiseXOR(F.lit(signed(1 << b))) for b in range(BITS if radius else 0)]
        near = crowd.select("fp", F.explode(F.array(*flips) if flips else F.array(F.col("fp"))).alias("v"))
        close = near.join(crowd.select(F.col("fp").alias("v")), "v").select(F.col("fp").alias("u"), "v")
    return verified.unionByName(close.where("u <> v").distinct())


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, fp, component_id, *keep)`` per row of ``docs``: the smallest id among all rows reachable over links.

    Two rows are linked if their fingerprints differ in at most ``radius`` bits. Equal fingerprints form one node first,
    so copies are never paired. Rows with null or empty text share the fingerprint 0 and are linked like any other.
    Null ids are passed over when the smallest is taken; a component without any id has a null ``component_id``. Repeated
    rows are kept. Columns of ``docs`` that are not in ``keep`` are not read. An empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, shingle, seed, keep))
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id", *keep)

"""The manifest against a version that hashes one group after another, in blocks of any size; hard rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.llm import catalog, merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves):
    """The root, and for each leaf its siblings on each level as (left, right)."""
    proofs, levels = [[] for _ in leaves], [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    for i, proof in enumerate(proofs):
        at = i
        for level in levels[:-1]:
            run = at - at % 3
            proof.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
            at //= 3
    return levels[-1][0], proofs


def brute_force(rows):
    """``rows`` of (id, group, leaf): subroot, root and proof of each, ordered as given inside a group."""
    groups = defaultdict(list)
    for i, r in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[1][2])):
        groups[r[1]].append(i)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([rows[i][2] for i in groups[g]]) for g in names}
    root, ups = brute_tree([trees[g][0] for g in names]) if names else (None, [])
    return sorted(
        (str(rows[i][0]), rows[i][2], trees[g][0], root, tuple(proof + up))
        for g, up in zip(names, ups) for i, proof in zip(groups[g], trees[g][1])
    )


def proved(frame):
    return sorted(
        (str(r.id), r.leaf, r.subroot, r.root, tuple((bytes(s.left).decode(), bytes(s.right).decode()) for s in r.proof))
        for r in frame.collect()
    )


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "WIDTH", 3**levels)
    draw = random.Random(levels)
    sizes = {None: 4, "": 1, "é": 9, "z": 28, "Z": 3, "漢": 10, "hot": 150} | {f"s{i}": draw.randrange(1, 4) for i in range(20)}
    rows = [(i, g) for g, n in sizes.items() for i in draw.sample(range(-500, 500), n)]
    rows = [(i, g, leaf(i, g)) for i, g in rows]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, src string, leaf string").repartition(5)
    assert proved(merkle.prove(frame, "src", "id", "leaf")) == brute_force(rows)


def test_hard_rows(hard, empty):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    keyed = hard.withColumn("leaf", merkle.leaf(*fields)).withColumnRenamed("id", "g").withColumn("proof", F.lit("mine"))
    out = merkle.prove(keyed, "source", "doc_id", "leaf")
    assert out.columns == [c for c in keyed.columns if c != "proof"] + ["subroot", "root", "proof"]
    rows = [(r.doc_id, r.source, leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)) for r in hard.collect()]
    assert proved(out.withColumn("id", F.col("doc_id"))) == brute_force(rows)
    assert out.where("g = 'mine'").count() == len(rows) and out.select("root").distinct().count() == 1
    assert merkle.prove(empty.withColumn("leaf", F.lit("")), "source", "doc_id", "leaf").count() == 0


def test_every_change_of_a_text_shows(spark, docs, sf_dir):
    out = {r.doc_id: r for r in catalog.QUERIES["op11_merkle_manifest"](spark, sf_dir).collect()}
    rows = docs.collect()
    assert set(out) == {r.doc_id for r in rows}
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (r.text or "")
        got = out[r.doc_id]
        assert got.verified is not changed and (got.folded_root == got.root) is not changed
        assert got.leaf == leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)


def test_a_group_lies_in_many_tasks(spark):
    """Ranges cut inside the only group; places are still those of one order."""
    frame = spark.range(5000).select(F.lit("one").alias("g"), (F.col("id") * 7 % 5003).alias("at"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = merkle.numbered(frame, "g", ["at"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.pos for r in sorted(out, key=lambda r: r["at"])] == list(range(5000)) and {r.n for r in out} == {5000}


def test_only_blocks_are_joined(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("src", "leaf")] + [T.StructField("id", T.LongType())])
    frame = spark.createDataFrame([("a", leaf(i), i) for i in range(30)], schema)
    plan = merkle.prove(frame, "src", "id", "leaf")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join")

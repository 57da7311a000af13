"""Classifier, reputation, decontamination, mix: held-out accuracy, brute force on small tables, and hard rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.llm import catalog, decontaminate, machine, mixing, reputation

SF = "/root/testdata/sf0.01"


# Classifier


def test_pairs_in_linear_time():
    draw = np.random.default_rng(1)
    m = machine.Machine(draw.normal(size=20), draw.normal(size=(20, 4)))
    at, x = np.array([3, 7, 11, 3, 5]), draw.normal(size=5)
    out = m.logits(at, x, np.array([0, 3]))
    for rows, found in (([0, 1, 2], out[0]), ([3, 4], out[1])):
        pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in rows for j in rows if i < j)
        assert found == pytest.approx(sum(m.linear[at[i]] * x[i] for i in rows) + pairs)


def test_held_out_accuracy(spark):
    out = catalog.QUERIES["op1_quality_classifier"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and ((out.score >= 0.3) == (out.predicted == 1)).all()
    both = out[out.held_out].merge(labels, on="doc_id")
    right = (both.predicted == both.quality)
    assert right.mean() >= 0.95 and right[both.quality == 1].mean() >= 0.98


def test_classifier_hard_rows(spark, hard, empty):
    known = spark.createDataFrame([(1, 1), (6, 0), (9, 0), (None, 0), (2, None)], "id long, label int")
    out = machine.classify(hard, known)
    assert out.count() == hard.count() and out.where("score between 0 and 1").count() == hard.count()
    assert out.where("doc_id = 1").distinct().count() == 1
    assert machine.classify(empty, known).count() == 0
    alike = machine.classify(hard, known.limit(0)).select("score").distinct().collect()
    assert [r.score for r in alike] == [pytest.approx(0.5)]


# Reputation

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())])


def test_host_path_and_rules(spark):
    urls = {
        "HTTP://WWW.Example.ORG/es/1?x#y": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/123": ("example.org", "/en/123", "example.org/en/1", "block"),
        "https://example.org/en/23": ("example.org", "/en/23", "org/", "allow"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "ftp://a.com/fr/x://y": ("a.com", "/fr/x://y", "com/fr/", "allow"), "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://a.com/DE/": ("a.com", "/DE/", None, "allow"), "http://É.org": ("É.org", "", None, "allow"), "http://a.org?x": ("a.org", "", None, "allow"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "x://\n/a": ("\n", "/a", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    out = {r.url: (r.host, r.path, r.rule, r.verdict) for r in reputation.judge(pages, outcomes).collect()}
    assert out == urls


def test_shrinkage(spark):
    rows, bad, i = [], [], 0
    for name, n, share in (("spam.bad.net", 60, 1.0), ("www.good.net", 60, 0.0), ("one.fine.net", 1, 1.0), ("b.bad.net", 1, 1.0), ("c.bad.net", 0, 0)):
        for k in range(max(n, 1)):
            rows.append((i, f"http://{name}/{k}"))
            if n:
                bad.append((i, int(k < share * n)))
            i += 1
    judged = reputation.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(bad, "page_id long, bad int"))
    out = {r.host: r for r in judged.collect()}
    assert out["spam.bad.net"].verdict == "block" and out["www.good.net"].verdict == "allow"
    # One bad page does not block a host; hosts of a bad domain start from its share.
    assert out["one.fine.net"].verdict == "allow" and out["c.bad.net"]["mean"] > out["one.fine.net"]["mean"] > out["www.good.net"]["mean"]
    assert all(r.bound <= r["mean"] for r in out.values())


def test_reputation_hard_rows(spark):
    rows = [(None, None), (None, "http://a.net/x"), (1, "http://a.net/x"), (1, "http://a.net/x"), (2, None), (3, "")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "path", "mean", "n", "x", "prior")})
    outcomes = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "page_id long, bad int")
    assert reputation.judge(pages, outcomes).count() == 6
    assert reputation.judge(pages.limit(0), outcomes).count() == 0


# Decontamination


def test_very_long_url(spark):
    """A host of a million labels and a path of a million characters; both are judged as they are."""
    rows = [(1, "http://" + "a." * 500_000 + "example.org/es/" + "x" * 1_000_000), (2, "http://b/" + "?" * 1_000_000), (3, "y" * 1_000_000)]
    pages = spark.createDataFrame(rows, PAGES)
    out = {r.page_id: r for r in reputation.judge(pages, spark.createDataFrame([(2, 1)], "page_id long, bad int")).collect()}
    assert out[1].verdict == "block" and out[1].rule == "example.org/es/" and len(out[1].path) == 1_000_004 and len(out[1].host) == 1_000_011
    assert (out[2].host, out[2].path, out[2].n_bad) == ("b", "/", 1) and (out[3].host, out[3].path, out[3].verdict) == ("", "", "allow")


def planted(draw, n_items=30):
    vocabulary = [f"t{i}" for i in range(2000)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(15, 60)))) for k in range(n_items)]
    texts = {}
    for i in range(200):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(5, 300))]
        if i % 4 == 0:
            leak = items[draw.randrange(n_items)][1].split()
            if i % 8 == 0:  # a paraphrase: some words are others, some are new
                leak = [draw.choice(vocabulary) if draw.random() < 0.1 else w for w in leak]
                leak.insert(draw.randrange(len(leak)), "really")
            at = draw.randrange(len(words) + 1)
            words[at:at] = leak
        texts[i] = " ".join(words)
    return items, texts


def test_recall_against_brute_force(spark):
    items, texts = planted(random.Random(5))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, k) for r in found.collect() for k in r["items"]}
    want = {(d, k) for d, held in decontaminate.brute_force(texts, [decontaminate.item_of(*i) for i in items]).items() for k in held}
    assert len(want) >= 40 and got <= want and len(got) >= 0.9 * len(want)


def test_leaks_of_the_tables(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [" ".join(r.text.lower().split()) for r in bench.collect()]
    held = {r.doc_id for r in docs.collect() if any(f" {i} " in f" {' '.join(r.text.lower().split())} " for i in items)}
    found = {r.doc_id for r in decontaminate.find_leaks(docs, bench).where(F.size("items") > 0).collect()}
    assert len(held - found) <= 0.1 * len(held) and len(found - held) <= 0.01 * docs.count()


def test_common_subsequence():
    item = "a b c a d".split()
    assert decontaminate.common(decontaminate.masks(item), 5, "x a c b a d".split()) == 4
    assert decontaminate.common(decontaminate.masks(item), 5, []) == 0


def test_answer_is_checked():
    item = decontaminate.item_of(1, "one two three four five six seven eight nine ten eleven twelve", "paris london")
    words = [b"one", b"two", b"three", b"four", b"five", b"six", b"seven", b"eight", b"nine", b"ten", b"eleven", b"twelve"]
    assert item.share(words) == 0 and item.share([*words, b"paris"]) == 1


def test_decontamination_hard_rows(spark, hard, empty):
    prose = " ".join(f"word{i}" for i in range(80))
    bench = spark.createDataFrame([(5, prose), (6, None), (7, ""), (None, "x"), (8, "one two"), (9, prose)], "item_id long, text string")
    out = decontaminate.find_leaks(hard, bench)
    held = sorted((str(r.doc_id), tuple(r["items"])) for r in out.collect())
    assert len(held) == 14 and held.count(("1", (5, 9))) == 2 and ("-9", (5, 9)) in held and ("8", (8,)) in held and ("3", ()) in held
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(hard, bench.limit(0)).where(F.size("items") > 0).count() == 0



def passage_rows(text):
    t = decontaminate.terms((text or "").encode().lower().split())
    return [t[i : i + decontaminate.WINDOW] for i in range(0, len(t), decontaminate.WINDOW)]


def test_every_passage_counts_in_the_fit(spark):
    """Passages fewer than the rank keep all they are: their latent vectors are as long as they were, and at right angles."""
    draw = random.Random(6)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(24 * 30 - 5)), None, "", "lone word"]
    docs = spark.createDataFrame([*enumerate(texts), (None, " ".join(f"x{i} x{i}" for i in range(24)))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(f"y{i}" for i in range(40)))], "item_id long, text string")
    vectors = decontaminate.fit(docs, bench, "doc_id", "text")
    held = [p for r in docs.collect() + bench.collect() for p in passage_rows(r.text)]
    df = np.zeros(1 << decontaminate.TERM_BITS, dtype=int)
    inside = [p for r in docs.collect() for p in passage_rows(r.text)]
    for p in inside:
        df[np.unique(p)] += 1
    idf = np.log((len(inside) + 1) / (df + 1)) + 1
    length = [np.sqrt(sum((np.count_nonzero(p == t) * idf[t]) ** 2 for t in set(p.tolist()))) for p in held]
    latent = np.array([vectors[p].sum(axis=0) / n for p, n in zip(held, length)])
    assert len(held) == 30 + 1 + 2 + 2
    assert np.abs(latent @ latent.T - np.eye(len(held))).max() < 1e-3


def test_the_fit_is_that_of_the_whole_matrix(spark):
    """Gram matrix of all passages by the definition, with repeated terms and repeated ids."""
    draw = random.Random(8)
    texts = [" ".join(f"v{int(draw.paretovariate(0.7))}" for _ in range(draw.choice([1, 30, 24 * 40]))) for _ in range(150)]
    docs = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = decontaminate.passages(docs, "text")
    df, n = decontaminate.frequencies(rows)
    held = [p for t in texts for p in passage_rows(t)]
    assert n == len(held) > 1000 and (df[np.unique(held[0])] > 0).all()
    idf = decontaminate.inverse(df, n)
    x = np.zeros((len(held), len(df)))
    for i, p in enumerate(held):
        np.add.at(x[i], p, idf[p])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    basis = np.linalg.qr(np.random.default_rng(1).normal(size=(len(df), 8)))[0]
    product = x.T @ (x @ basis)
    assert np.allclose(decontaminate._product(rows, idf, basis), product, atol=1e-4)
    assert np.allclose(decontaminate._product(rows, idf, basis, within=True), basis.T @ product, atol=1e-4)


# Mix


def brute_targets(sizes):
    """By resharing the excess until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check_mix(order, summary):
    rows = summary.collect()
    sizes = {r.source: r.source_size for r in rows}
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert order.agg(F.sum("n_taken")).first()[0] == sum(taken.values()) or not rows
    return rows


def test_mix(spark, docs):
    order, summary = mixing.mix(docs, block_words=100)
    rows = check_mix(order, summary)
    again = mixing.mix(docs.repartition(3), block_words=100)[1].collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == docs.count()
    # Early and late slots hold each source in its share.
    slots = order.select("slot", "s", "block").distinct().toPandas()
    half = slots[slots.slot <= slots.slot.median()].s.value_counts() / (len(slots) / 2)
    whole = slots.s.value_counts() / len(slots)
    assert (half.reindex(whole.index).fillna(0) - whole).abs().max() <= 3 / (len(slots) / 2) ** 0.5


@pytest.mark.parametrize("blocks", [[1], [5, 1, 1], [100, 1, 37, 0, 1], [1000, 3, 500]])
def test_schedule_takes_every_block_once(spark, blocks):
    sources = spark.createDataFrame([(i + 1, b) for i, b in enumerate(blocks)], "s int, blocks long")
    found = [(r.s, r.block) for r in mixing.schedule(sources).orderBy("slot").collect()]
    assert sorted(found) == [(i + 1, k) for i, b in enumerate(blocks) for k in range(b)]
    for s in {s for s, _ in found}:
        own = [k for t, k in found if t == s]
        assert own == sorted(own)


def test_mix_hard_rows(hard, empty):
    order, summary = mixing.mix(hard)
    assert len(check_mix(order, summary)) == 14
    assert mixing.mix(empty)[1].count() == 0 and mixing.mix(empty)[0].count() == 0
    only = hard.where("text is null or text = ''")
    assert {r.taken for r in mixing.mix(only)[1].collect()} == {0}


def test_mix_is_native(docs):
    order, summary = mixing.mix(docs)
    for frame in (order, summary):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())

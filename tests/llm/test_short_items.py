"""Verbatim occurrences of benchmark items that are shorter than a window."""

import random

import pytest

from linkscout.llm import decontaminate

SF = "/root/testdata/sf0.01"


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def planted(spark):
    """Index of slices of benchmark items, by their length, and each slice in the middle of a document."""
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    vectors = decontaminate.fit(docs, bench, "doc_id", "text")
    hosts = [w for r in docs.orderBy("doc_id").limit(200).collect() if len(w := words(r.text)) >= 60]
    sources = [w for r in bench.orderBy("item_id").collect() if len(w := words(r.text)) >= 15]
    draw, out = random.Random(7), {}
    for n in range(3, 24):
        cases = []
        for _ in range(60):
            source, host = draw.choice(sources), list(draw.choice(hosts))
            size, at = min(n, len(source)), draw.randrange(len(host) + 1)
            begin = draw.randrange(len(source) - size + 1)
            own = source[begin : begin + size]
            host[at:at] = own
            cases.append((own, host))
        items = [decontaminate.item_of(k, b" ".join(own).decode()) for k, (own, _) in enumerate(cases)]
        index = decontaminate.Index(items, vectors)
        out[n] = sum(k in index.leaks(host) for k, (_, host) in enumerate(cases)) / len(cases)
    return out


def test_recall_of_short_items(planted):
    print({n: round(x, 2) for n, x in planted.items()})
    assert all(x >= 0.9 for x in planted.values()), planted


def test_windows_fit_the_items():
    for n in range(1, 100):
        size, stride = decontaminate.window_of(n)
        assert size <= n and (stride <= max(size / 3, 1)) and (n < decontaminate.WINDOW or size == decontaminate.WINDOW)


def test_short_items_through_the_query(spark):
    draw = random.Random(4)
    vocabulary = [f"t{i}" for i in range(2000)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(3, 15)))) for k in range(40)]
    texts = {}
    for i in range(160):
        found = [draw.choice(vocabulary) for _ in range(draw.randrange(40, 200))]
        at = draw.randrange(len(found))
        found[at:at] = items[i % 40][1].split() if i < 120 else []
        texts[i] = " ".join(found)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, k) for r in out.collect() for k in r["items"]}
    want = {(d, k) for d, held in decontaminate.brute_force(texts, [decontaminate.item_of(*i) for i in items]).items() for k in held}
    assert got <= want and len(want) >= 120 and len(got) >= 0.9 * len(want)

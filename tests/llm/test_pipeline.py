"""Every stage against a brute-force version of it, on what its predecessor kept."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_models import brute_targets
from test_text import brute_components, expected as judged, python_spans

from linkscout.llm import decontaminate, simhash
from linkscout.operators.storage import materialise


@pytest.fixture(scope="module")
def kept(spark, docs, sf_dir):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], sf_dir)))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_keep_the_columns(kept, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "source_mix"]
    assert all(frame.schema == docs.schema for frame in kept[1:-1])


def test_quality_rules(kept, labels):
    rows = [(r.doc_id, r.text) for r in kept[0].collect()]
    want = {r[0] for r in judged(rows, {r.doc_id for r in labels.where("quality = 1").collect()}) if r[-1]}
    assert set(texts(kept[1])) == want


def test_near_duplicates(kept):
    fps = {i: simhash.fingerprint(t.encode()) for i, t in texts(kept[1]).items()}
    group = brute_components(set(fps.values()))
    first = {}
    for i, f in fps.items():
        first[group[f]] = min(i, first.get(group[f], i))
    assert set(texts(kept[2])) == set(first.values())


def test_decontamination(kept, spark, sf_dir):
    items = [decontaminate.item_of(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(kept[2]), texts(kept[3])
    held = {i for i, found in decontaminate.brute_force(before, items).items() if found}
    assert set(before) - set(after) <= held and len(held & set(after)) <= 0.1 * len(held)


def test_secret_scan(kept):
    before, after = texts(kept[3]), texts(kept[4])
    assert set(before) == set(after)
    for i, text in before.items():
        spans, out, end = sorted(sum(map(list, python_spans(text)), [])), "", 0
        for start, _, stop in spans:
            out += text[end:start] + "[SECRET]" * (start >= end)
            end = max(end, stop)
        assert after[i] == out + text[end:]
    assert kept[4].where(F.length("text") != F.col("n_chars")).count() == 0


def test_source_mix(kept):
    sizes = {}
    for r in kept[4].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in kept[5].collect():
        taken[r.source] += r.taken
        assert 0 < r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    rows, texts_ = kept[5].collect(), texts(kept[4])
    assert all(r.text == texts_[r.doc_id] for r in rows)
    ordered = [r.first_slot for r in corpus_pipeline.source_mix(kept[4].sparkSession, kept[4], "").collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) > 10


def test_near_duplicates_of_repeated_ids(spark, sf_dir):
    """Rows that share an id are told apart by their text, and a copy goes also where its id stays for another text."""
    a, b = (" ".join(f"{p}{i}" for i in range(300)) for p in "ab")
    rows = [(3, a), (9, a), (9, b), (9, b), (12, b), (None, a), (None, "alone " * 60), (20, None), (21, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()), key=str)
    hashed = spark.range(1).select(F.xxhash64(F.lit(a)), F.xxhash64(F.lit("alone " * 60))).first()
    # A row without an id goes by a hash of its text, which may be the smallest of its group.
    first = (None, a) if hashed[0] < 3 else (3, a)
    assert out == sorted([first, (9, b), (None, "alone " * 60), (20, None)], key=str)


@pytest.mark.parametrize("frame", ["hard", "empty"])
def test_hard_rows(spark, sf_dir, request, frame):
    docs = request.getfixturevalue(frame)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    # Of the rows with enough words: one of the four copies, the copy with a word more, which is over two bits away, the long text.
    assert docs.count() == (3 if frame == "hard" else 0)

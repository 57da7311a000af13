"""Periodic runs against a comparison of all words at every distance; hard rows; the planted runs of the query."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_text import WORD

from linkscout.llm import catalog, periods


def repetitive(seed, n):
    """Texts of repeated roots of many lengths, Sturmian words and noise, over alphabets from one word up."""
    draw, texts = random.Random(seed), []
    for _ in range(n):
        size, found = draw.choice([1, 2, 3, 5, 50, 1000]), []
        for _ in range(draw.randrange(0, 6)):
            kind = draw.random()
            if kind < 0.5:
                p = draw.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33, 40, 64, 100])
                found += ([f"w{draw.randrange(size)}" for _ in range(p)] * 8)[: draw.randrange(p, 6 * p + 3)]
            elif kind < 0.7:
                a, b = ["a"], ["b"]
                for _ in range(draw.randrange(1, 7)):
                    a, b = (a + b, a) if draw.random() < 0.5 else (a * 3 + b, a)
                found += (a * draw.randrange(1, 6))[:1500]
            else:
                found += [f"w{draw.randrange(size)}" for _ in range(draw.randrange(0, 40))]
        texts.append(" ".join(found))
    return texts + ["", "   ", " ".join(["x"] * 1000), " ".join((["x"] * 20 + ["y"]) * 9), " ".join((["a"] * 9 + ["b"] * 9) * 30)]


def kept(found, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(found) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(spark, seed):
    texts = repetitive(seed, 150)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scales = set()
    for r in periods.find_runs(frame).collect():
        want = periods.brute_force(texts[r.doc_id].split())
        assert [tuple(x) for x in r.runs] == want
        assert r.kept == kept(texts[r.doc_id].split(), want) and r.n_words == len(texts[r.doc_id].split())
        scales |= {p.bit_length() for _, _, p in want}
    assert scales >= {1, 2, 3, 4, 5, 6}


def test_runs_of_the_documents(spark, docs):
    out = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.find_runs(docs).collect()}
    for r in docs.collect():
        assert out[r.doc_id] == periods.brute_force((r.text or "").split()), r.doc_id


def test_thue_morse():
    """Words without a third power, on which sums of powers modulo 2^64 fail."""
    bits = [i.bit_count() & 1 for i in range(1 << 13)]
    t = np.array([*bits, -1], dtype=np.int64)
    assert not len(periods.find(t, np.array([len(bits)])))
    t = np.array([*(bits[:2048] * 4), -1], dtype=np.int64)
    assert periods.find(t, np.array([8192])).tolist() == [[0, 8192, 2048]]


def test_picks_are_few_and_dense():
    draw = np.random.default_rng(1)
    t = np.r_[draw.integers(0, 1 << 40, 5000), np.tile([1, 2], 2000), draw.integers(0, 1 << 40, 5000)]
    names = periods.mixed(t.astype(np.uint64) * periods.FACTOR)
    for scale in (1, 2, 4, 8):
        names = periods.doubled(names, scale)
    inside = np.zeros(len(t), dtype=bool)
    inside[5000 : 9000 - 16 + 1] = True
    picks = periods.synchronising(names, 16, inside)
    assert len(picks) < 4 * 10000 / 16 and not ((picks > 5016) & (picks < 8950)).any()
    plain = picks[(picks < 4960)]
    assert np.diff(plain).max() <= 16


def test_slices_join_up(monkeypatch):
    texts = repetitive(9, 60)
    whole = [c.to_pylist() for c in periods._searched(pa.array(texts), 4, 6)]
    monkeypatch.setattr(periods, "SLICE", 500)
    parts = [[c.to_pylist() for c in periods._searched(pa.array(texts[a:b]), 4, 6)] for a, b in periods._slices(pa.array(texts))]
    assert len(parts) > 10 and [sum(c, []) for c in zip(*parts)] == whole


def test_hard_rows(hard, empty):
    out = periods.find_runs(hard).collect()
    assert len(out) == 14 and sum(r.n_words == 0 and not r.runs and r.kept == "" for r in out) == 4
    assert periods.find_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(hard, exponent=3)


def test_planted_runs(spark, docs, hard, empty):
    out = {r.doc_id: r.text for r in catalog.with_planted_runs(docs).collect()}
    n_changed = 0
    for r in docs.collect():
        h, found = zlib.crc32(str(r.doc_id).encode()), WORD.findall(r.text or "")
        if h % 10 == 0 and found:
            g, n = h // 10, len(found)
            a, n_changed = g % n, n_changed + 1
            p = 1 + (n - a) // (3 + g % 8)
            assert out[r.doc_id].split() == [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]
        else:
            assert out[r.doc_id] == r.text
    assert n_changed > 5
    assert catalog.with_planted_runs(hard).count() == 14 and catalog.with_planted_runs(empty).count() == 0

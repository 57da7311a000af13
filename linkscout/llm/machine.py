"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import word_hashes

WORD_BITS = 15
FACTORS = 8
#: Labelled rows that are learned from, at most: those with the smallest hashes of their ids.
MAX_ROWS = 8000
#: Passes over the rows, more where they are few, so that there are at least so many steps.
EPOCHS = 12
MIN_STEPS = 600
BATCH = 128
RATE = 0.1
DECAY = 1e-5
CUT = 0.3

# Classes of bytes: letters by case, digits, white space, sentence marks, other ASCII marks, and the rest.
UPPER, LOWER, DIGIT, BLANK, STOP, MARK, OTHER = range(7)


def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[:128] = MARK
    for code, characters in (
        (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (LOWER, b"abcdefghijklmnopqrstuvwxyz"), (DIGIT, b"0123456789"),
        (BLANK, b" \t\n\x0b\x0c\r"), (STOP, b".,;:!?'\"()-"),
    ):
        table[list(characters)] = code
    return table


BYTE_CLASSES = _byte_classes()
#: Each statistic becomes one of this many cells, so that factors can tell a text's ranges apart.
CELLS = 16


def statistics(raw: bytes, found: list[bytes], counts: Counter, n_chars: int | None) -> list[float]:
    """Structure of a text and the given number of characters, each scaled to 0 up to 1."""
    n = max(len(found), 1)
    kinds = np.bincount(BYTE_CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=7) / max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    heads = Counter(zip(found, found[1:]))
    declared = len(raw) if n_chars is None else max(n_chars, 0)
    return [
        min(np.log1p(len(found)) / 12, 1.0), min(len(raw) / n / 16, 1.0), *kinds.tolist(), len(counts) / n,
        max(counts.values(), default=0) / n, max(heads.values(), default=0) / n, 1 - len(set(lines)) / max(len(lines), 1),
        min(np.log1p(len(found) / max(len(lines), 1)) / 8, 1.0), raw.count(b"!") / max(len(raw), 1) * 8,
        sum(not w[-1:].isalpha() and w[-1] < 128 for w in found) / n, min(np.log1p(declared) / 16, 1.0),
    ]


N_STATISTICS = 17


class Features:
    """Sparse features of a text: hashed words weighted by their counts, and one cell of each statistic."""

    def __init__(self, word_bits: int = WORD_BITS):
        self.mask = np.uint64((1 << word_bits) - 1)
        self.size = (1 << word_bits) + N_STATISTICS * CELLS + 1

    def of(self, text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        raw = text or b""
        found = raw.split()
        counts = Counter(found)
        slots = (word_hashes(list(counts)) & self.mask).astype(np.int64)
        weights = np.log1p(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
        weights = weights / max(float(np.sqrt((weights * weights).sum())), 1e-9)
        values = np.clip(np.array(statistics(raw, found, counts, n_chars)), 0, 1)
        cells = np.minimum((values * CELLS).astype(np.int64), CELLS - 1)
        base = int(self.mask) + 1
        at = np.r_[slots, base + np.arange(N_STATISTICS) * CELLS + cells, self.size - 1]
        return at, np.r_[weights, np.full(N_STATISTICS, 0.5), 1.0].astype(np.float32)


@dataclass
class Machine:
    """``linear`` weight and ``factors`` of each feature."""

    linear: np.ndarray
    factors: np.ndarray

    def logits(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of rows that begin at ``starts``: pairs by half of (sum of v x) squared less the sum of squares, in linear time."""
        vx = self.factors[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        squares = np.add.reduceat(vx * vx, starts)
        return np.add.reduceat(self.linear[at] * x, starts) + 0.5 * (total * total - squares).sum(axis=1)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, seed: int = 5) -> Machine:
    """Adagrad on the logistic loss, over shuffled batches; the same rows in the same order give the same machine.

    Without any rows, or with one label only, the score is the smoothed share of that label everywhere.
    """
    draw = np.random.default_rng(seed)
    m = Machine(np.zeros(size, dtype=np.float32), draw.normal(0, 0.05, (size, FACTORS)).astype(np.float32))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    m.linear[-1] = np.log(share / (1 - share))
    if not len(labels) or labels.min() == labels.max():
        m.factors[:] = 0
        return m
    seen_w, seen_v = np.full(size, 1e-3, dtype=np.float32), np.full((size, FACTORS), 1e-3, dtype=np.float32)
    for _ in range(max(EPOCHS, -(-MIN_STEPS // -(-len(rows) // BATCH)))):
        order = draw.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            chosen = order[b : b + BATCH]
            at = np.concatenate([rows[i][0] for i in chosen])
            x = np.concatenate([rows[i][1] for i in chosen])
            lengths = np.array([len(rows[i][0]) for i in chosen])
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            error = np.repeat(probability(m.logits(at, x, starts)) - labels[chosen], lengths).astype(np.float32) / len(chosen)
            vx = m.factors[at] * x[:, None]
            total = np.repeat(np.add.reduceat(vx, starts), lengths, axis=0)
            g_w, g_v = error * x, (error * x)[:, None] * (total - vx)
            slots, inverse = np.unique(at, return_inverse=True)
            sort = np.argsort(inverse, kind="stable")
            edges = np.searchsorted(inverse[sort], np.arange(len(slots)))
            g_w = np.add.reduceat(g_w[sort], edges) + DECAY * m.linear[slots]
            g_v = np.add.reduceat(g_v[sort], edges) + DECAY * m.factors[slots]
            seen_w[slots] += g_w * g_w
            seen_v[slots] += g_v * g_v
            m.linear[slots] -= RATE * g_w / np.sqrt(seen_w[slots])
            m.factors[slots] -= RATE * g_v / np.sqrt(seen_v[slots])
    return m


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, chars_col: str | None, max_rows: int) -> tuple[list, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled rows, picked and ordered by a hash of the id.

    Ids are picked first, so that the texts are met by a broadcast of a bounded table and only features are collected.
    """
    known = labels.where("label is not null and id is not null").groupBy("id").agg(F.max("label").alias("label"))
    picked = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    chars = F.col(chars_col).cast("long") if chars_col else F.lit(None).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), chars.alias("n_chars")).join(F.broadcast(picked), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of(t, n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
            at = pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32()))
            x = pa.array([v for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), at, x], ["id", "label", "at", "x"])

    fetched = rows.mapInArrow(run, "id long, label int, at array<int>, x array<float>").toArrow()
    ids = fetched.column("id").to_numpy()
    turn = np.array([xxhash.xxh64_intdigest(b"%d" % i) for i in ids], dtype=np.uint64)
    order = np.lexsort((ids, turn))
    at, x = fetched.column("at").combine_chunks(), fetched.column("x").combine_chunks()
    data = [(at[int(i)].values.to_numpy().astype(np.int64), x[int(i)].values.to_numpy()) for i in order]
    return data, fetched.column("label").to_numpy()[order].astype(np.float32) if len(ids) else np.zeros(0, dtype=np.float32)


def score(docs: DataFrame, machine: Machine, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    chars = F.col(chars_col).cast("long") if chars_col else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            scores = np.empty(batch.num_rows)
            texts, n = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i in range(batch.num_rows):
                at, x = features.of(texts[i], n[i])
                scores[i] = machine.logits(at, x, np.zeros(1, dtype=np.int64))[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability(scores))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), chars.alias("n_chars"))
    return rows.mapInArrow(run, "doc_id long, score double")


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
    max_rows: int = MAX_ROWS, cut: float = CUT,
) -> DataFrame:
    """``(doc_id, score, predicted)`` per row of ``docs``: the probability of label 1, and 1 if it is at least ``cut``.

    ``labels`` has ``(id, label)`` of the rows to learn from; the machine is fitted on at most ``max_rows`` of them and
    scores every whole text in one pass without a shuffle. Inputs are the words, the text's structure and the number of
    characters the table gives; ids, labels and other columns are not. Null and empty texts are scored by their statistics.
    Labels of rows without an id, and null labels, are not used; of repeated labels the largest counts. Rows of equal text
    and ``chars_col`` get equal scores.
    """
    rows, known = sample(docs, labels, id_col, text_col, chars_col, max_rows)
    machine = fit(rows, known, Features().size)
    out = score(docs, machine, id_col, text_col, chars_col)
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))

"""Periodic runs of words, proposed by string synchronising sets at dyadic scales and settled by exact comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import mixed

#: A run repeats its period at least so often. The exclusion of periodic windows below relies on four.
EXPONENT = 4
MIN_LENGTH = 6
#: Smallest scale. Shorter periods are found by comparing all words with those so far on.
BASE = 8
#: Bytes of text that are searched at once, if no single text is longer.
SLICE = 4 << 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, those past the end counting as NONE."""
    n = len(values)
    padded = np.full(-(-(n + width) // width) * width, NONE)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of windows of ``2 * width`` words from those of ``width``. Past the end, a window is named by its first half."""
    second = np.zeros_like(names)
    second[: len(names) - width] = names[width:]
    return mixed(names * FACTOR + (second ^ (names >> np.uint64(29))))


def synchronising(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Positions whose own window or the one ``scale`` further on has the least name of all windows from here to there.

    Windows of small period do not count, so few positions are picked; whether one is picked depends on the ``2 * scale``
    words from it on alone. Any ``scale`` consecutive positions hold a pick, unless all windows there have a small period.
    """
    key = np.where(periodic, NONE, names)
    least = sliding_least(key, scale + 1)
    ahead = np.full_like(key, NONE)
    ahead[: len(key) - scale] = key[scale:]
    return np.flatnonzero((least != NONE) & ((least == key) | (least == ahead)))


def extended(t: np.ndarray, lo: int, hi: int, p: int) -> list[tuple[int, int]]:
    """Maximal stretches ``[a, b)`` around ``[lo, hi)`` of words that equal the word ``p`` further on, compared one by one."""
    step, n = 64, len(t) - p
    while lo > 0:
        b = max(0, lo - step)
        differ = np.flatnonzero(t[b:lo] != t[b + p : lo + p])
        if len(differ):
            lo = b + int(differ[-1]) + 1
            break
        lo, step = b, 2 * step
    step = 64
    while hi < n:
        b = min(n, hi + step)
        differ = np.flatnonzero(t[hi:b] != t[hi + p : b + p])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = b, 2 * step
    starts, ends = stretches(t[lo:hi] == t[lo + p : hi + p])
    return [(lo + int(a), lo + int(b)) for a, b in zip(starts, ends, strict=True)]


def proposals(picks: np.ndarray, contexts: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """``(first, last, period)``: chains of picks whose next pick of equal context lies one period on.

    In a run of period p from ``scale`` to twice that, the picks recur every p words and no nearer, and neighbouring ones
    are at most ``scale`` apart.
    """
    order = np.argsort(contexts, kind="stable")
    same = contexts[order][1:] == contexts[order][:-1]
    at, then = picks[order][:-1][same], picks[order][1:][same]
    period = then - at
    fits = (period >= scale) & (period < 2 * scale)
    at, period = at[fits], period[fits]
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    if not len(at):
        return []
    breaks = np.flatnonzero((np.diff(period) != 0) | (np.diff(at) > 2 * scale)) + 1
    firsts, lasts = np.r_[0, breaks], np.r_[breaks, len(at)] - 1
    return list(zip(at[firsts].tolist(), at[lasts].tolist(), period[firsts].tolist(), strict=True))


def find(t: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All maximal stretches of smallest period p and at least EXPONENT * p words, as rows ``(start, stop, period)``.

    ``t`` holds word numbers of texts of ``lengths`` words, each followed by a negative number that occurs once.
    """
    found: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64)]
    for p in range(1, min(BASE, len(t))):
        a, b = stretches(t[:-p] == t[p:])
        long = b - a >= (EXPONENT - 1) * p
        found.append(np.stack([a[long], b[long] + p, np.full(int(long.sum()), p)], axis=1))
    scale, names, place = 1, mixed(t.astype(np.uint64) * FACTOR + FACTOR), np.arange(len(t))
    own = np.repeat(lengths, lengths + 1)
    longest = int(lengths.max(initial=0))
    while EXPONENT * scale <= longest:
        long = own >= EXPONENT * scale
        if long.sum() < 0.7 * len(t):
            t, names, place, own = t[long], names[long], place[long], own[long]
        contexts = doubled(names, scale) if len(names) > scale else names
        if scale >= BASE:
            known = np.concatenate(found)
            known = known[(known[:, 2] * EXPONENT <= scale) & (known[:, 1] - known[:, 0] >= scale)]
            here = np.searchsorted(place, known[:, 0])
            there = here < len(place)
            there[there] = place[here[there]] == known[there, 0]
            edge = np.zeros(len(t) + 1, dtype=np.int64)
            np.add.at(edge, here[there], 1)
            np.add.at(edge, here[there] + (known[there, 1] - known[there, 0]) - scale + 1, -1)
            picks = synchronising(names, scale, np.cumsum(edge[:-1]) > 0)
            rows = []
            for first, last, p in proposals(picks, contexts[picks], scale):
                rows += [(place[a], place[a] + b - a + p, p) for a, b in extended(t, first, last + 1, p) if b - a >= (EXPONENT - 1) * p]
            if rows:
                found.append(np.array(rows, dtype=np.int64))
        names, scale = contexts, 2 * scale
    every = np.unique(np.concatenate(found), axis=0)
    # A stretch has also the multiples of its smallest period; np.unique has put that first.
    first = np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)][: len(every)]
    return every[first]


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE bytes of text."""
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(text):
        limit = (ends[at - 1] if at else 0) + SLICE
        stop = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield at, stop
        at = stop


def _searched(text: pa.Array, exponent: int, min_length: int) -> list[pa.Array]:
    """``[n_words, runs, kept]`` of some texts."""
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    n_words = np.bincount(owner[real.to_numpy(zero_copy_only=False)], minlength=len(text))
    flat = flat.filter(real)
    first = np.cumsum(n_words + 1) - n_words - 1
    t = np.empty(len(flat) + len(text), dtype=np.int64)
    is_word = np.ones(len(t), dtype=bool)
    is_word[first + n_words] = False
    t[is_word] = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    t[~is_word] = -1 - np.arange(len(text))
    runs = find(t, n_words)
    length = runs[:, 1] - runs[:, 0]
    runs = runs[length >= np.maximum(min_length, exponent * runs[:, 2])]
    by = np.searchsorted(first, runs[:, 0], side="right") - 1
    order = np.lexsort((runs[:, 2], runs[:, 0]))
    runs, by = runs[order], by[order]
    edge = np.zeros(len(t) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    stays = (np.cumsum(edge[:-1]) == 0) & is_word
    n_kept = np.add.reduceat(stays, first).astype(np.int64) if len(text) else n_words
    kept = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_kept)].astype(np.int32)), flat.filter(pa.array(stays[is_word])))
    columns = [pa.array(c.astype(np.int64)) for c in (runs[:, 0] - first[by], runs[:, 1] - runs[:, 0], runs[:, 2])]
    ends = np.r_[0, np.cumsum(np.bincount(by, minlength=len(text)))].astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    return [pa.array(n_words.astype(np.int64)), listed, pc.binary_join(kept, " ")]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, min_length: int = MIN_LENGTH
) -> DataFrame:
    """``(doc_id, n_words, runs, kept)`` per row of ``docs``.

    ``runs`` lists ``(start, length, period)`` of each stretch of at least ``max(min_length, exponent * period)`` words, period
    its smallest one, that no neighbouring word continues, by start and period. ``kept`` is the text, its words joined by
    one space, without what follows the first period of each run.

    Scales double from BASE; each finds the periods from it to its double, in runs of EXPONENT periods and more. Windows of
    small period are left out, by the runs found before; the shortest periods are compared directly. Each row is searched
    for itself, so there is no shuffle; memory grows with the longest text.

    Null and empty texts have no words, no runs and an empty ``kept``. Ids may be null or repeated; rows are not told apart by
    them. Other columns are not read. An empty table gives an empty result.
    """
    if exponent < EXPONENT:
        raise ValueError(f"runs of fewer than {EXPONENT} periods are not searched")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.columns
            for a, b in _slices(text):
                out = _searched(text.slice(a, b - a), exponent, min_length)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *out], ["doc_id", "n_words", "runs", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, kept string")


def brute_force(words: list[str], exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """The runs of one text, by comparing all words at every distance."""
    smallest: dict[tuple[int, int], int] = {}
    for p in range(1, len(words) // exponent + 1):
        at = 0
        for i in range(len(words) - p + 1):
            if i < len(words) - p and words[i] == words[i + p]:
                continue
            if i + p - at >= max(min_length, exponent * p):
                smallest.setdefault((at, i + p - at), p)
            at = i + 1
    return sorted((start, length, p) for (start, length), p in smallest.items())

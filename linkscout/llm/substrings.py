"""Removal of word windows that occurred earlier in the corpus, found over difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import multipliers, window_hashes, word_hashes

#: Modulo 13, every difference occurs between two of these positions.
PERIOD = 13
COVER = (0, 1, 3, 9)
IN_COVER = np.isin(np.arange(PERIOD), COVER)


class Windows:
    """Hashes of one text, for windows of ``length`` words and anchors at the cover positions.

    Two equal windows share, for some shift below PERIOD, an anchor that lies at a cover position of both texts. An anchor
    of ``length - PERIOD + 1`` words at that shift is still inside the window.
    """

    def __init__(self, length: int):
        if length <= PERIOD:
            raise ValueError(f"windows must be longer than {PERIOD} words")
        self.length, self.anchor = length, length - PERIOD + 1
        self.factors = multipliers(self.anchor, 1), multipliers(length, 2), multipliers(length, 3)

    def of(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes, and the anchors' positions."""
        h = word_hashes(found)
        at = np.arange(max(0, len(h) - self.anchor + 1))
        return h, at[IN_COVER[at % PERIOD]]

    def anchors(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        return window_hashes(h, self.factors[0], at).view(np.int64)

    def candidates(self, h: np.ndarray, at: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of all windows that hold a shared anchor."""
        hit = np.zeros(len(h) + PERIOD + 1, dtype=np.int64)
        marked = at[np.isin(self.anchors(h, at), shared)]
        np.add.at(hit, np.maximum(marked - PERIOD + 1, 0), 1)
        np.add.at(hit, marked + 1, -1)
        return np.flatnonzero(np.cumsum(hit)[: max(0, len(h) - self.length + 1)] > 0)

    def extended(self, h: np.ndarray, starts: np.ndarray, part: int = 0) -> np.ndarray:
        """Hash of the whole windows at ``starts``; the two parts are independent."""
        return window_hashes(h, self.factors[1 + part], starts).view(np.int64)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bool]]:
    return batch.column("id").to_numpy(zero_copy_only=False), batch.column("nul").to_pylist()


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(nul, id, raw)``. A row without an id is known by a hash of its text."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).isNull().alias("nul"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(raw)).alias("id"), raw.alias("raw")
    )


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """``(k, id, nul, sure, hashes)``: anchors on their way to meet, and those known to be shared.

    An anchor seen in several documents of a batch, or twice in one, is known to be shared: the hashes of each document
    that are sure so go to ``k``, the document. One row with the hash as ``k`` stands for the batch, so a hash has at most
    one row to meet a batch, however frequent it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length)
        for batch in batches:
            ids, nul = _ids(batch)
            hashes, owners, repeated = [], [], []
            for i, raw in enumerate(batch.column("raw").to_pylist()):
                found = raw.split()
                if len(found) < length:
                    continue
                own = np.sort(windows.anchors(*windows.of(found)))
                first = np.r_[True, own[1:] != own[:-1]]
                hashes.append(own[first])
                repeated.append(np.diff(np.r_[np.flatnonzero(first), len(own)]) > 1)
                owners.append(np.full(len(hashes[-1]), i))
            if not hashes:
                continue
            h, owner, twice = np.concatenate(hashes), np.concatenate(owners), np.concatenate(repeated)
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            first = np.r_[True, sorted_h[1:] != sorted_h[:-1]]
            counts = np.diff(np.r_[np.flatnonzero(first), len(h)])
            sure = twice.copy()
            sure[order] |= np.repeat(counts > 1, counts)
            met, flags = order[first], np.array(nul, dtype=bool)
            known = np.flatnonzero(sure)
            edges = np.flatnonzero(np.r_[True, owner[known][1:] != owner[known][:-1]]) if len(known) else known
            docs = owner[known][edges]
            ends = np.r_[edges, len(known)][1:]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[np.zeros(len(met) + 1), ends].astype(np.int32)), pa.array(h[known]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[h[met], ids[docs]]), pa.array(np.r_[ids[owner[met]], ids[docs]]),
                    pa.array(np.r_[flags[owner[met]], flags[docs]]),
                    pa.array(np.r_[np.zeros(len(met), dtype=bool), np.ones(len(docs), dtype=bool)]), lists,
                ],
                ["k", "id", "nul", "sure", "hashes"],
            )

    return rows.mapInArrow(run, "k long, id long, nul boolean, sure boolean, hashes array<bigint>")


def _shared(rows: DataFrame, length: int) -> DataFrame:
    """``(nul, id, shared)``: the shared anchors of each document that has any."""
    met = _anchor_rows(rows, length).selectExpr("*", "count(1) over (partition by k, sure) as n").where("sure or n > 1")
    own = F.when(F.col("sure"), F.col("hashes")).otherwise(F.array("k")).alias("own")
    return met.select("nul", "id", own).groupBy("nul", "id").agg(F.flatten(F.collect_list("own")).alias("shared"))


def _window_rows(joined: DataFrame, length: int) -> DataFrame:
    """``(h1, h2, real, bare)``: each candidate window of each document once, with the document's id or stand-in.

    The two hashes have 96 bits together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length)
        for batch in batches:
            ids, nul = _ids(batch)
            shared = batch.column("shared")
            h1, h2, owner = [], [], []
            for i, raw in enumerate(batch.column("raw").to_pylist()):
                h, at = windows.of(raw.split())
                starts = windows.candidates(h, at, shared[i].values.to_numpy())
                own, first = np.unique(windows.extended(h, starts), return_index=True)
                h1.append(own)
                h2.append(windows.extended(h, starts[first], 1).astype(np.int32))
                owner.append(np.full(len(own), i))
            if not h1:
                continue
            by = np.concatenate(owner)
            own, bare = ids[by], np.array(nul, dtype=bool)[by]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h1)), pa.array(np.concatenate(h2)), pa.array(own, mask=bare), pa.array(own, mask=~bare)],
                ["h1", "h2", "real", "bare"],
            )

    return joined.mapInArrow(run, "h1 long, h2 int, real long, bare long")


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` per row: the words left when repeated windows of ``length`` words go.

    A word goes if a window over it has the same words as a window that starts earlier, in a document with a smaller id or
    before it in the same one. Windows are judged on the input. Anchors pick the windows that may be repeated, whole
    windows decide; both steps group by hash, combine in each task first and send no window's text.

    Null text has no words. Rows without an id come after all others. Rows of equal id do not precede each other, nor do
    rows without an id that hold the same text, so repeated rows have equal results. Other columns are not read. Memory per
    task grows with the longest text, not with the number of copies.
    """
    rows = _identified(docs, id_col, text_col)
    joined = rows.join(_shared(rows, length), ["nul", "id"], "left")
    owner = _window_rows(joined.where(F.col("shared").isNotNull()), length).groupBy("h1", "h2").agg(
        F.min("real").alias("real"), F.min("bare").alias("bare")
    )
    owned = owner.select(F.col("real").isNull().alias("nul"), F.coalesce("real", "bare").alias("id"), "h1").groupBy("nul", "id")
    judged = joined.join(owned.agg(F.collect_list("h1").alias("owned")), ["nul", "id"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length)
        for batch in batches:
            shared, owned_by = batch.column("shared"), batch.column("owned")
            n_words, n_removed, kept = [], [], []
            for i, raw in enumerate(batch.column("raw").to_pylist()):
                found = raw.split()
                gone = 0
                if shared[i].is_valid:
                    h, at = windows.of(found)
                    starts = windows.candidates(h, at, shared[i].values.to_numpy())
                    h1 = windows.extended(h, starts)
                    first = np.zeros(len(starts), dtype=bool)
                    first[np.unique(h1, return_index=True)[1]] = True
                    if owned_by[i].is_valid:
                        first &= np.isin(h1, owned_by[i].values.to_numpy())
                    else:
                        first[:] = False
                    edge = np.zeros(len(found) + 1, dtype=np.int64)
                    edge[starts[~first]] += 1
                    edge[starts[~first] + length] -= 1
                    stays = np.cumsum(edge[:-1]) == 0
                    gone = len(found) - int(stays.sum())
                    if gone:
                        kept.append(b" ".join([w for w, s in zip(found, stays.tolist(), strict=True) if s]))
                n_words.append(len(found))
                n_removed.append(gone)
                if not gone:
                    kept.append(b" ".join(found))
            ids = [None if n else x for x, n in zip(batch.column("id").to_pylist(), batch.column("nul").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    out = judged.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def brute_force(texts: list[tuple[int, str | None]], length: int = 20) -> dict[int, tuple[int, int, str]]:
    """The same for a few documents with distinct ids, by a table of all windows: id -> words, removed, SHA-256 of the rest."""
    seen: set[tuple[bytes, ...]] = set()
    out = {}
    for key, text in sorted(texts, key=lambda t: t[0]):
        found = (text or "").encode().split()
        gone: set[int] = set()
        for i in range(len(found) - length + 1):
            window = tuple(found[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(found) if i not in gone)
        out[key] = len(found), len(gone), hashlib.sha256(kept).hexdigest()
    return out


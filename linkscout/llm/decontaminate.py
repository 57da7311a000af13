"""Benchmark decontamination by latent semantic retrieval, checked by longest common subsequences and answers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import word_hashes
from linkscout.operators.storage import materialise

TERM_BITS = 14
RANK = 48
OVERSAMPLE = 8
ROUNDS = 2
WINDOW = 24
STRIDE = 8
#: Items below WINDOW words are searched by windows of the largest of these lengths that they have, at a third as stride.
SHORT_WINDOWS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 19)
MIN_COSINE = 0.5
#: Share of an item's words, and of its answer's, that must occur in order in a text.
MIN_SHARE = 0.75
MIN_ANSWER = 0.5
#: Words of the item on either side of the place where it is expected.
SLACK = 12
#: Items below this many words must occur whole.
SHORT_ITEM = 8
#: Passages of one written row; passages that are multiplied at once; occurrences in these from which a term is summed by itself.
ROW_PASSAGES = 64
CHUNK = 8192
FREQUENT = 32
PASSAGES_PER_TASK = 1 << 20
BLOCK_ITEMS = 1000
#: Blocks of items that one plan goes through.
PASS_BLOCKS = 8


def window_of(n: int) -> tuple[int, int]:
    """Length and stride of the text windows that an item of ``n`` words is searched by."""
    if n >= WINDOW:
        return WINDOW, STRIDE
    size = max(w for w in SHORT_WINDOWS if w <= n)
    return size, max(size // 3, 1)


def terms(found: list[bytes]) -> np.ndarray:
    return (word_hashes(found) & np.uint64((1 << TERM_BITS) - 1)).astype(np.int64)


def passages(texts: DataFrame, text_col: str) -> DataFrame:
    """``(t)``: the hashed terms of all passages of all texts, written; up to ROW_PASSAGES passages a row, as 16-bit numbers.

    Each passage holds its terms in ascending order, with -1 before them where it is shorter than WINDOW.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for raw in batch.column(0).to_pylist():
                t = terms(raw.lower().split())
                rows = np.full((-(-len(t) // WINDOW), WINDOW), -1, dtype=np.int16)
                rows.ravel()[: len(t)] = t
                held.append(rows)
                n += len(rows)
                if n >= CHUNK:
                    yield _written(held)
                    held, n = [], 0
            if n:
                yield _written(held)

    rows = texts.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return materialise(rows.mapInArrow(run, "t binary"))


def _written(held: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.sort(np.concatenate(held), axis=1)
    return pa.RecordBatch.from_arrays([pa.array([rows[i : i + ROW_PASSAGES].tobytes() for i in range(0, len(rows), ROW_PASSAGES)], pa.binary())], ["t"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The passages of :func:`passages`, a row each, in chunks of bounded size."""
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK // ROW_PASSAGES):
            held = b"".join(batch.column(0).slice(i, CHUNK // ROW_PASSAGES).to_pylist())
            yield np.frombuffer(held, dtype=np.int16).reshape(-1, WINDOW)


def frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages of the whole corpus each hashed term occurs, and the number of passages.

    Each task sends one row per term at most; the table of 2 ** TERM_BITS terms is what the driver sees.
    """
    size = 1 << TERM_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, dtype=np.int64), 0
        for t in _chunks(batches):
            new = t >= 0
            new[:, 1:] &= t[:, 1:] != t[:, :-1]
            df += np.bincount(t[new], minlength=size)
            n += len(t)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[used, -1]), pa.array(np.r_[df[used], n])], ["term", "n"])

    counts = rows.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(size, dtype=np.int64), 0
    for term, n in counts:
        if term < 0:
            total = n
        else:
            df[term] = n
    return df, total


def inverse(df: np.ndarray, n: int) -> np.ndarray:
    return (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)


def _projected(t: np.ndarray, idf: np.ndarray, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``weighted`` over the terms of each passage, and the squared length of its TF-IDF weights.

    Both arrays end with a row of zeros, which -1 stands for.
    """
    p = np.zeros((len(t), weighted.shape[1]), dtype=np.float32)
    sq, before = np.zeros(len(t), dtype=np.float32), np.zeros(len(t), dtype=np.float32)
    for j in range(WINDOW):
        p += weighted.take(t[:, j], axis=0, mode="wrap")
        # The first n odd numbers add up to the square of n.
        before = np.where(t[:, j] == t[:, j - 1], before + 1, 0) if j else before
        sq += idf.take(t[:, j], mode="wrap") ** 2 * (2 * before + 1)
    return p, np.maximum(sq, 1e-18)


def _added(total: np.ndarray, t: np.ndarray, p: np.ndarray) -> None:
    """Add the row ``p`` of each passage to ``total`` at each of its terms."""
    flat = t.ravel()
    order = flat.argsort(kind="stable")
    order = order[np.count_nonzero(flat < 0) :]
    if not len(order):
        return
    slots = flat[order]
    first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
    n = np.diff(first, append=len(slots))
    rank = (-n).argsort(kind="stable")
    found, first, n = slots[first][rank], first[rank], n[rank]
    order //= WINDOW
    sums = np.zeros((len(found), p.shape[1]), dtype=np.float32)
    frequent = int(np.count_nonzero(n > FREQUENT))
    ones = np.ones(int(n[0]), dtype=np.float32)
    for i in range(frequent):
        sums[i] = ones[: n[i]] @ p.take(order[first[i] : first[i] + n[i]], axis=0)
    for k in range(FREQUENT):  # the k-th occurrence of all other terms that have one
        some = slice(frequent, int(np.count_nonzero(n > k)))
        if some.stop <= frequent:
            break
        sums[some] += p.take(order[first[some] + k], axis=0)
    total[found] += sums


def _padded(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros_like(x[:1])]).astype(np.float32)


def singular(rows: DataFrame, idf: np.ndarray, seed: int = 11) -> np.ndarray:
    """Whitened right singular vectors (terms x RANK) of the matrix of all passages, by a randomised SVD.

    The rows of that matrix are the passages' TF-IDF weights at length 1. In each round every task multiplies its passages with
    the current basis and back, and the products are added per term on the executors; the driver orthogonalises a matrix whose
    size is fixed.
    """
    size, width = 1 << TERM_BITS, RANK + OVERSAMPLE
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    for _ in range(ROUNDS):
        product = _product(rows, idf, basis)
        if not product.any():
            return np.zeros((size, RANK), dtype=np.float32)
        basis = np.linalg.qr(product)[0]
    small = _product(rows, idf, basis, within=True)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][:RANK]
    scale = 1 / np.sqrt(np.maximum(values[top], 1e-6 * max(values.max(), 1e-9)))
    return (basis @ (vectors[:, top] * scale)).astype(np.float32)


def _product(rows: DataFrame, idf: np.ndarray, basis: np.ndarray, within: bool = False) -> np.ndarray:
    """The matrix of passages, transposed, times itself times ``basis`` (terms x columns); ``within`` the basis, that from the left as well."""
    size, width = basis.shape
    inverse_frequency, weighted = _padded(idf), _padded(basis * idf[:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width if within else size, width))
        for t in _chunks(batches):
            p, sq = _projected(t, inverse_frequency, weighted)
            if within:
                total += p.T @ (p / sq[:, None])
            else:
                _added(total, t, p / sq[:, None])
        if not within:
            total *= idf[:, None]
        used = np.flatnonzero(total.any(axis=1))
        for i in range(0, len(used), 2048):
            some = used[i : i + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(total[some]), pa.list_(pa.float64()))], ["at", "v"])

    parts = rows.mapInArrow(run, "at long, v array<double>")
    sums = parts.groupBy("at").agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(width)]).alias("v"))
    out = np.zeros((width if within else size, width))
    table = sums.toArrow()
    for at, v in zip(table.column(0).to_pylist(), table.column(1), strict=True):
        out[at] = v.values.to_numpy()
    return out


def common(item_masks: dict[bytes, int], m: int, text: list[bytes]) -> int:
    """Length of the longest common subsequence of an item of ``m`` words and ``text``, a word of ``text`` a step."""
    full = (1 << m) - 1
    v = full
    for w in text:
        u = v & item_masks.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def masks(found: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(found):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Item:
    key: int
    words: list[bytes]
    answer: list[bytes]
    masks: dict[bytes, int] = field(default_factory=dict)
    answer_masks: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.masks, self.answer_masks = masks(self.words), masks(self.answer)

    @property
    def least(self) -> float:
        """Words of the item that must be found."""
        n = len(self.words)
        return n if n < SHORT_ITEM else MIN_SHARE * n

    def share(self, text: list[bytes]) -> float:
        """Share of the item's words found in order, 0 if that is too small or the answer is missing."""
        n = len(self.words)
        # A common subsequence is no longer than the words that both have.
        if sum(map(self.masks.__contains__, text)) < self.least:
            return 0.0
        found = common(self.masks, n, text)
        if found < self.least:
            return 0.0
        if common(self.answer_masks, len(self.answer), text) < MIN_ANSWER * len(self.answer):
            return 0.0
        return found / n


def item_of(key: int, text: str | None, answer: str | None = None) -> Item | None:
    """An item without an answer of its own is answered by its last quarter."""
    found = (text or "").encode().lower().split()
    if not found or key is None:
        return None
    return Item(key, found, (answer or "").encode().lower().split() or found[-max(1, len(found) // 4) :])


class Index:
    """Latent vectors of the items' windows, and the search of one text against them."""

    def __init__(self, items: list[Item], vectors: np.ndarray):
        self.items, self.vectors = items, vectors
        rows, self.of_item, self.offset = [], [], []
        for k, item in enumerate(items):
            last = max(len(item.words) - WINDOW, 0)
            for at in sorted({*range(0, last, WINDOW), last}):
                rows.append(vectors[terms(item.words[at : at + WINDOW])].sum(axis=0))
                self.of_item.append(k)
                self.offset.append(at)
        q = np.array(rows, dtype=np.float32).reshape(len(rows), vectors.shape[1])
        self.of_item, self.offset = np.array(self.of_item, dtype=np.int64), np.array(self.offset, dtype=np.int64)
        held = [terms(item.words) for item in items]
        self.words = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
        self.starts = np.cumsum([0, *map(len, held)])[:-1]
        self.least = np.array([item.least for item in items])
        self.queries = (q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)).T.copy()
        kinds: dict[tuple[int, int], list[int]] = {}
        for row, k in enumerate(self.of_item.tolist()):
            kinds.setdefault(window_of(len(items[k].words)), []).append(row)
        self.kinds = {kind: np.array(rows_of) for kind, rows_of in kinds.items()}

    def candidates(self, t: np.ndarray, min_cosine: float = MIN_COSINE) -> tuple[np.ndarray, np.ndarray]:
        """Item, and place of its first word, for every window of the terms ``t`` that is near an item's, best first.

        Of items that need more words than the whole text has, nothing is listed.
        """
        n = len(t)
        seen = np.zeros(1 << TERM_BITS, dtype=np.int64)
        seen[t] = 1
        possible = (np.add.reduceat(seen[self.words], self.starts) >= self.least)[self.of_item]
        sums = np.zeros((n + 1, self.vectors.shape[1]), dtype=np.float32)
        np.cumsum(self.vectors[t], axis=0, out=sums[1:])
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for (size, stride), of_kind in self.kinds.items():
            live = of_kind[possible[of_kind]]
            if not len(live):
                continue
            queries = self.queries[:, live]
            at = np.arange(0, max(n - size, 0) + stride, stride)
            for i in range(0, len(at), 4096):
                begin = np.minimum(at[i : i + 4096], max(n - size, 0))
                p = sums[np.minimum(begin + size, n)] - sums[begin]
                p /= np.maximum(np.sqrt(np.einsum("ij,ij->i", p, p)), 1e-9)[:, None]
                cosine = p @ queries
                near = cosine >= np.float32(min_cosine)
                if not near.any():
                    continue
                w, q = np.nonzero(near)
                found.append((cosine[w, q], self.of_item[live[q]], begin[w] - self.offset[live[q]]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        cosine, item, place = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((place, item, -cosine))
        return item[order], place[order]

    def leaks(self, found: list[bytes]) -> dict[int, float]:
        """Items that the text holds, each with the share of its words found in order."""
        out: dict[int, float] = {}
        if not found or not self.items:
            return out
        item, place = self.candidates(terms(found))
        for k, first in zip(item.tolist(), place.tolist(), strict=True):
            one = self.items[k]
            if one.key not in out:
                share = one.share(found[max(first - SLACK, 0) : max(first, 0) + len(one.words) + SLACK])
                if share:
                    out[one.key] = share
        return out


def fit(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Vector of every term: its inverse passage frequency times its whitened singular coordinates.

    All passages of all rows of ``docs`` and of all benchmark items count, whatever their ids. Each task of the products sends
    a table of fixed size, so it goes through PASSAGES_PER_TASK passages where there are more of them than cores.
    """
    held = passages(docs, text_col)
    df, n = frequencies(held)
    idf = inverse(df, n)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n // PASSAGES_PER_TASK))
    return singular(held.coalesce(tasks).unionByName(passages(benchmark, text_col)), idf) * idf[:, None]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> Iterator[list[Item]]:
    """The benchmark in blocks of a bounded number of items."""
    columns = [item_col, text_col, *([answer_col] if answer_col else [])]
    rows = benchmark.select(*columns).orderBy(item_col, text_col).toLocalIterator()
    items = (item for item in (item_of(*r) for r in rows) if item)
    while block := list(islice(items, BLOCK_ITEMS)):
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, items, shares)`` and the columns ``keep`` per row of ``docs``: benchmark items that its whole text holds.

    Windows of every text near an item's window in the latent space, of its own length if that is short, are compared with the item: enough of its words must
    occur in order, and enough of its answer's. Statistics and the latent space are those of all passages of the whole corpus
    and the benchmark. Benchmark items are taken in blocks, each of which goes over all texts without a shuffle; after PASS_BLOCKS blocks
    the rows are written, so neither the plan nor what the driver holds grows with the benchmark. Letters A-Z are lower-cased.

    Null and empty texts hold no item; null and empty items are in no text; items of equal text are all reported. Items
    are listed by id. Repeated rows are kept; other columns of ``docs`` are not read.
    """
    vectors = fit(docs, benchmark.select(F.col(item_text_col).alias(text_col)), id_col, text_col)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_raw")
    empty = F.array().cast("array<struct<item:bigint,share:double>>").alias("_leaks")
    rows = docs.select(F.col(id_col).alias("_id"), raw, empty, *[F.col(c) for c in keep])
    for i, block in enumerate(blocks(benchmark, item_col, item_text_col, answer_col)):
        if i and i % PASS_BLOCKS == 0:
            rows = materialise(rows)

        def run(batches: Iterator[pa.RecordBatch], block: list[Item] = block) -> Iterator[pa.RecordBatch]:
            index = Index(block, vectors)
            kind = pa.list_(pa.struct([("item", pa.int64()), ("share", pa.float64())]))
            for batch in batches:
                out = []
                for text, before in zip(batch.column("_raw").to_pylist(), batch.column("_leaks").to_pylist(), strict=True):
                    own = index.leaks(text.lower().split())
                    out.append(before + [{"item": k, "share": s} for k, s in own.items()])
                i = batch.schema.get_field_index("_leaks")
                yield batch.set_column(i, pa.field("_leaks", kind), pa.array(out, kind))

        rows = rows.mapInArrow(run, rows.schema)
    ordered = F.sort_array("_leaks")
    return rows.select(
        F.col("_id").alias("doc_id"), F.transform(ordered, lambda x: x.getField("item")).alias("items"),
        F.transform(ordered, lambda x: x.getField("share")).alias("shares"), *keep,
    )


def brute_force(texts: dict[int, str | None], items: list[Item]) -> dict[int, list[int]]:
    """The same for a few texts by comparing every item with every stretch of every text."""
    out = {}
    for key, text in texts.items():
        found = (text or "").encode().lower().split()
        held = []
        for item in items:
            n = len(item.words) + 2 * SLACK
            starts = range(0, max(len(found) - n, 0) + 1)
            if any(item.share(found[i : i + n]) for i in starts):
                held.append(item.key)
        out[key] = sorted(held)
    return out


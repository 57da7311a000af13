"""Token ids in binary files of independent zstandard frames, with a seek table, checksums and an index of the documents."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the zstandard frame format and of its seekable extension: the frame number that ends a file, the number of
# skippable frames that hold a seek table, and the one used here for the index.
SEEK_END = 0x8F92EAB1
SEEK_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
#: Seek table entries carry a checksum: the low 32 bits of XXH64 of what a frame decompresses to.
CHECKSUMS = 0x80

INDEX = b"TIDS"
HEAD = struct.Struct("<4sBBHIIQQ")
VERSION = 1
#: A frame holds whole documents up to so many ids; a longer one has frames of its own, of so many ids each.
FRAME_IDS = 1 << 14
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 1 << 24
#: Bytes of text that are encoded at once, and of ids that are handed on, if no single document is longer.
TEXT_SLICE = 8 << 20
IDS_SLICE = 4 << 20
#: Words whose ids a worker remembers.
MOST_WORDS = 1 << 19
JOINED = 64
LEVEL = 3


class Encoder:
    """Ids of texts by a tokenizer that never joins words across the six white space characters of ``bytes.split``.

    Each different word of some texts is encoded once by the library, JOINED words in one call with a special token between
    them, where the tokenizer has one that stands for itself alone. Words are remembered up to MOST_WORDS; later ones are
    encoded whenever they come.
    """

    _ready: dict[str, Encoder] = {}

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.known: dict[str, bytes] = {}
        self.added = self.tokenizer.get_added_tokens_decoder()
        alone = [i for i, t in self.added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark = min(alone, default=None)

    @classmethod
    def of(cls, definition: str) -> Encoder:
        """One encoder a worker process, whatever the number of its tasks."""
        if definition not in cls._ready:
            cls._ready = {definition: cls(definition)}
        return cls._ready[definition]

    def fresh(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words that hold no added token, in order."""
        if self.mark is None:
            for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4").tobytes()
            return
        between = self.added[self.mark].content
        joined = [between.join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(e.ids, dtype="<u4")
            raw, marks = ids.tobytes(), (np.flatnonzero(ids == self.mark) * 4).tolist()
            yield from (raw[a:b] for a, b in zip([0, *[m + 4 for m in marks]], [*marks, len(raw)], strict=True))

    def pieces(self, found: list[str], odd: set[str]) -> list[bytes]:
        """The ids of different words; ``odd`` are those that hold an added token."""
        known = self.known
        out = [known.get(w) for w in found]
        new = [k for k, raw in enumerate(out) if raw is None]
        if odd:
            for k in [k for k in new if found[k] in odd]:
                out[k] = np.array(self.tokenizer.encode(found[k], add_special_tokens=False).ids, dtype="<u4").tobytes()
            new = [k for k in new if out[k] is None]
        for i in range(0, len(new), 1 << 14):
            some = new[i : i + (1 << 14)]
            for k, raw in zip(some, self.fresh([found[k] for k in some]), strict=True):
                out[k] = raw
            if len(known) < MOST_WORDS:
                known.update((found[k], out[k]) for k in some)
        return out

    def encode(self, text: pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` last."""
        lists = pc.ascii_split_whitespace(text)
        owner = np.repeat(np.arange(len(text), dtype=np.int32), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        contents = [t.content for t in self.added.values()]
        held = [c for c in contents if pc.any(pc.match_substring(text, c)).as_py()]
        found = coded.dictionary.to_pylist()
        pieces = self.pieces(found, {w for w in found if any(c in w for c in held)} if held else set())
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        joined, first = np.frombuffer(b"".join(pieces), dtype="<u4"), np.cumsum(size) - size
        word = coded.indices.to_numpy(zero_copy_only=False)
        count = size[word]
        ids = joined[np.repeat(first[word] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        ends = np.cumsum(np.bincount(owner, weights=count, minlength=len(text)).astype(np.int64))
        return [np.append(part, np.uint32(end_id)) for part in np.split(ids, ends[:-1])]


class File:
    """A file under construction."""

    def __init__(self, width: int, part: int, seq: int):
        self.width, self.part, self.seq = width, part, seq
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.pending: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.ids: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.waiting + len(ids) > FRAME_IDS:
            self.flush()
        for i in range(0, len(ids), FRAME_IDS):
            self.pending.append(ids[i : i + FRAME_IDS])
            self.waiting += len(self.pending[-1])
            if len(ids) > FRAME_IDS:
                self.flush()
        self.n_ids += len(ids)
        self.ids.append(doc_id)
        self.sizes.append(len(ids))

    def flush(self) -> None:
        if self.pending:
            raw = np.concatenate(self.pending).astype(f"<u{self.width}").tobytes()
            self.frames.append(self.compressor.compress(raw))
            self.table.append((len(self.frames[-1]), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.waiting = [], 0

    def finish(self) -> bytes:
        """The whole file but for the number that ends it."""
        self.flush()
        ids = np.array([i or 0 for i in self.ids], dtype="<i8").tobytes()
        nulls = np.array([i is None for i in self.ids], dtype=bool).tobytes()
        head = HEAD.pack(INDEX, VERSION, self.width, 0, self.part, self.seq, len(self.ids), self.n_ids)
        body = self.compressor.compress(head + ids + np.array(self.sizes, dtype="<u8").tobytes() + nulls)
        self.frames.append(struct.pack("<II", INDEX_FRAME, len(body)) + body)
        self.table.append((len(self.frames[-1]), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        foot = struct.pack("<IB", len(self.table), CHECKSUMS)
        return b"".join([*self.frames, struct.pack("<II", SEEK_FRAME, len(entries) + len(foot) + 4), entries, foot])


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of every whole text, ``end_id`` after each, in ascending order of ids to files below ``folder``.

    Rows are dealt by ranges of their id; each task writes files of about FILE_IDS ids and holds one of them, compressed. Ids are
    stored in two bytes where the vocabulary allows it, else in four. Null texts are empty; rows without an id come first;
    rows that repeat one stand in order of their texts. Other columns are not read. An empty table gives no file with content.
    """
    with open(tokenizer_path) as source:
        definition = source.read()
    width = 2 if max(Encoder.of(definition).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = Encoder.of(definition), 0
        part = TaskContext.get().partitionId()
        file = File(width, part, seq)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(ends):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_SLICE, side="right")))
                found = encoder.encode(batch.column(1).slice(at, stop - at), end_id)
                for doc_id, ids in zip(batch.column(0).slice(at, stop - at).to_pylist(), found, strict=True):
                    file.add(doc_id, ids)
                    if file.n_ids >= FILE_IDS:
                        yield pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], ["value"])
                        seq += 1
                        file = File(width, part, seq)
                at = stop
        if file.ids:
            yield pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], ["value"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    values = ranged.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    # One row a file; what the writer puts after a row is the number that ends a seek table.
    end = struct.pack("<I", SEEK_END).decode("latin-1")
    values.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", end).text(folder)


class Reader:
    """A file's seek table and index; frames are decompressed as they are asked for, and checked."""

    def __init__(self, content: bytes):
        self.content = content
        n, kind, end = struct.unpack("<IBI", content[-9:])
        if end != SEEK_END or not kind & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end")
        entries = np.frombuffer(content[-9 - 12 * n : -9], dtype="<u4").reshape(n, 3).astype(np.int64)
        self.stops = np.cumsum(entries[:, 0])
        self.starts, self.sizes, self.sums = self.stops - entries[:, 0], entries[:, 1], entries[:, 2]
        if self.stops[-1] + 8 + 12 * n + 9 != len(content):
            raise ValueError("the seek table does not describe the file")
        body = zstandard.ZstdDecompressor().decompress(content[self.starts[-1] + 8 : self.stops[-1]])
        magic, version, self.width, _, self.part, self.seq, self.n_docs, self.n_ids = HEAD.unpack_from(body)
        if magic != INDEX or version != VERSION:
            raise ValueError("not an index of documents")
        ids, counts, nulls = (np.frombuffer(body, t, self.n_docs, HEAD.size + o * self.n_docs) for t, o in (("<i8", 0), ("<u8", 8), ("?", 16)))
        self.ids, self.counts, self.nulls = ids, counts.astype(np.int64), nulls
        self.first = np.cumsum(self.counts) - self.counts
        self.frame_first = (np.cumsum(self.sizes) - self.sizes) // self.width
        self.opened: tuple[int, np.ndarray] = (-1, np.zeros(0))
        self.n_opened = 0

    def frame(self, i: int) -> np.ndarray:
        if self.opened[0] != i:
            raw = zstandard.ZstdDecompressor().decompress(self.content[self.starts[i] : self.stops[i]])
            if len(raw) != self.sizes[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} does not have its size and checksum")
            self.opened = i, np.frombuffer(raw, f"<u{self.width}")
            self.n_opened += 1
        return self.opened[1]

    def document(self, k: int) -> bytes:
        """The ids of the k-th document of the file, as little-endian unsigned 32-bit integers."""
        at, stop, out = int(self.first[k]), int(self.first[k] + self.counts[k]), []
        i = int(np.searchsorted(self.frame_first[:-1], at, side="right")) - 1
        while at < stop:
            inside = at - int(self.frame_first[i])
            out.append(self.frame(i)[inside : inside + stop - at])
            at, i = at + len(out[-1]), i + 1
        return np.concatenate(out).astype("<u4").tobytes()


def _contents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")


def _starts(files: DataFrame) -> DataFrame:
    """``(path, base)``: the ids of all earlier files. Sums run inside chunks of parts, then over the chunks."""
    chunked = files.withColumn("chunk", F.floor(F.col("part") / 1024))
    over = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy("chunk").agg(F.sum("n_ids").alias("n")).select("chunk", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy("chunk").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return chunked.join(chunks, "chunk").select("path", base.alias("base"))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, part, seq, n_ids, first_id, last_id)`` per file, read from the ends of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                r = Reader(content.as_py())
                real = r.ids[~r.nulls]
                ends = [int(real[0]), int(real[-1])] if len(real) else [None, None]
                values = [path.as_py(), r.part, r.seq, r.n_ids, *ends]
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "part", "seq", "n_ids", "first_id", "last_id"), values, strict=True))], schema)

    schema = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("part", "seq", "n_ids", "first_id", "last_id")]])
    return _contents(spark, folder).mapInArrow(run, "path string, part long, seq long, n_ids long, first_id long, last_id long")


def read(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` per stored document, or per one whose id is ``wanted`` (a bounded list).

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned 32-bit integers. Of wanted
    documents only the frames that hold them are decompressed, in files whose range of ids meets the list. A frame that
    does not have its size and checksum raises.
    """
    files = index(spark, folder)
    starts = _starts(files)
    if wanted is not None:
        hit = F.exists(F.array(*[F.lit(w).cast("long") for w in wanted]), lambda w: w.between(F.col("first_id"), F.col("last_id")))
        starts = starts.join(files.where(hit).select("path"), "path", "left_semi")
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, base in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                r = Reader(content.as_py())
                held = np.arange(r.n_docs) if wanted is None else np.flatnonzero(np.isin(r.ids, wanted) & ~r.nulls)
                size = np.cumsum(r.counts[held]) * 4 // IDS_SLICE
                for some in np.split(held, np.flatnonzero(np.diff(size)) + 1) if len(held) else []:
                    columns = [
                        pa.array(r.ids[some], pa.int64(), mask=r.nulls[some]), pa.array(base + r.first[some]), pa.array(r.counts[some]),
                        pa.array([r.document(k) for k in some.tolist()], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    found = _contents(spark, folder).join(starts, "path").select("content", "base")
    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")

"""Token files: ids against the library on whole texts, an exact round trip, the public format, chosen documents, damage."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

from linkscout.llm import catalog, tokens
from linkscout.operators import storage

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def ids(row):
    return np.frombuffer(row.ids, "<u4").tolist()


@pytest.fixture(scope="module")
def stored(spark, docs):
    folder = storage.new_folder(spark, "tokens")
    tokens.write(docs, folder, PATH, 1)
    return folder


@pytest.fixture(scope="module")
def contents(spark, stored):
    return [bytes(r.content) for r in tokens._contents(spark, stored).collect()]


def test_round_trip(spark, docs, stored, tokenizer):
    out = sorted(tokens.read(spark, stored).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, d in zip(out, sorted(docs.collect(), key=lambda r: r.doc_id), strict=True):
        want = whole(tokenizer, d.text)
        assert (r.doc_id, r.start, r.n_tokens, ids(r)) == (d.doc_id, start, len(want), want)
        start += len(want)


def test_query(spark, sf_dir, docs, tokenizer):
    got = {r.doc_id: r.ids_crc32 for r in catalog.QUERIES["op12_token_files"](spark, sf_dir).collect()}
    want = {r.doc_id: zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for r in docs.collect() for x in [whole(tokenizer, r.text)]}
    assert got == want


def test_words_alone_give_the_ids_of_whole_texts(tokenizer):
    """Letters that combine, all kinds of space, special tokens in the text, characters outside the basic plane."""
    draw = random.Random(6)
    parts = ["é", "é", "́", "ﬁ", "Ǆ", "İ", "Σ", "ΑΣ", "<|endoftext|>", "<|startoftext|>x", "a", "B", "don't", "'S", "12", "½", "漢字", "𝄞",
             " ", " ", "\x1c", "\x85", "‍", "👩‍👧", "ก็", "-", "...", "가", "가", "﻿", "\x00", "ß"]
    texts = ["".join(draw.choice([*parts, " ", "\t", "\n", "\x0b", "\r\n", "  "]) for _ in range(draw.randrange(0, 30))) for _ in range(3000)]
    with open(PATH) as f:
        encoder = tokens.Encoder(f.read())
    for text, found in zip(texts, encoder.encode(pa.array(texts), 1), strict=True):
        assert found.tolist() == whole(tokenizer, text), repr(text)


def test_files_are_plain_zstandard(contents):
    """Any decoder gives all ids in order; the seek table is the public one, with frames that stand alone."""
    for content in contents:
        reader = tokens.Reader(content)
        raw = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
        assert len(raw) == reader.n_ids * reader.width
        n, kind, end = struct.unpack("<IBI", content[-9:])
        assert (end, kind) == (0x8F92EAB1, 0x80)
        at = total = 0
        for i in range(n):
            packed, size, check = struct.unpack_from("<III", content, len(content) - 9 - 12 * (n - i))
            if size:
                alone = zstandard.ZstdDecompressor().decompress(content[at : at + packed])
                assert len(alone) == size and xxhash.xxh64_intdigest(alone) & 0xFFFFFFFF == check
                assert alone == raw[total : total + size]
            at, total = at + packed, total + size
        assert total == len(raw) and struct.unpack_from("<II", content, at) == (0x184D2A5E, 12 * n + 9)


def test_only_frames_asked_for_are_opened(contents, monkeypatch):
    content = max(contents, key=len)
    reader = tokens.Reader(content)
    middle = reader.n_docs // 2
    reader.document(middle)
    assert reader.n_opened <= 1 + reader.counts[middle] // tokens.FRAME_IDS + 1 < len(reader.sizes) - 1


def test_wanted_documents(spark, stored, docs, tokenizer):
    texts = {r.doc_id: r.text for r in docs.collect()}
    starts = {r.doc_id: r.start for r in tokens.read(spark, stored).collect()}
    out = tokens.read(spark, stored, wanted=[3, 77, 78, 199, 10**9]).collect()
    assert sorted(r.doc_id for r in out) == [3, 77, 78, 199]
    assert all(ids(r) == whole(tokenizer, texts[r.doc_id]) and r.start == starts[r.doc_id] for r in out)


def test_small_frames_and_files(spark, hard, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "FRAME_IDS", 50)
    monkeypatch.setattr(tokens, "FILE_IDS", 200)
    file, texts = tokens.File(4, 0, 0), ["a b c", "", "word " * 170, "x " * 49, "y"]
    for i, t in enumerate(texts):
        file.add(i if i != 1 else None, np.array(whole(tokenizer, t), dtype=np.uint32))
    reader = tokens.Reader(file.finish() + struct.pack("<I", tokens.SEEK_END))
    assert len(reader.sizes) > 5 and max(reader.sizes) == 200
    for i, t in enumerate(texts):
        assert np.frombuffer(reader.document(i), "<u4").tolist() == whole(tokenizer, t)
    assert reader.nulls.tolist() == [False, True, False, False, False]


def test_damage_raises(contents):
    content = bytearray(contents[0])
    reader = tokens.Reader(bytes(content))
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(content[reader.starts[0] : reader.stops[0]]), np.uint8).copy()
    raw[0] ^= 1
    other = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(raw.tobytes())
    content[len(content) - 9 - 12 * len(reader.sizes) + 8] ^= 1
    with pytest.raises(ValueError):
        tokens.Reader(bytes(content)).frame(0)
    with pytest.raises(ValueError):
        tokens.Reader(other + bytes(contents[0][reader.stops[0] :])[:-1])
    with pytest.raises(ValueError):
        tokens.Reader(b"\0" + contents[0])


def test_hard_rows(spark, hard, empty, tokenizer):
    folder = storage.new_folder(spark, "tokens")
    tokens.write(hard, folder, PATH, 1)
    out = sorted(tokens.read(spark, folder).collect(), key=lambda r: r.start)
    texts = sorted(hard.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    assert [(r.doc_id, ids(r)) for r in out] == [(r.doc_id, whole(tokenizer, r.text)) for r in texts]
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    none = storage.new_folder(spark, "tokens")
    tokens.write(empty, none, PATH, 1)
    assert tokens.read(spark, none).count() == 0 and tokens.read(spark, none, wanted=[1]).count() == 0

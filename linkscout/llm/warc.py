"""WARC archives: writing with revisits for equal payloads, and reading with verified record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkscout.operators.storage import materialise

END = b"\r\n\r\n"
MAGIC = b"WARC/1."
#: Archives are cut where a line starts with the magic. No line of a header does, and the cut never overlaps itself, so
#: splits of a file agree on it wherever they begin.
CUT = b"\n" + MAGIC
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, sha: str) -> str:
    h = hashlib.sha1(f"{page_id}|{url}|{sha}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, sha: str, payload: bytes, refers_to: str | None, first_page: int | None) -> bytes:
    """One record without the blank lines that end it. A revisit holds no payload."""
    block = HTTP if refers_to else HTTP + payload
    head = [
        "WARC/1.0", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, sha)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
        head += [f"X-Refers-To-Page-Id: {first_page}"]
    return "\r\n".join(head).encode() + END + block


def digests(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas = [digest(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shas, pa.string())], ["page_id", "url", "payload", "sha"])

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    )
    return rows.mapInArrow(run, "page_id long, url string, payload binary, sha string")


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 0,
    compression: str = "gzip",
) -> None:
    """Write one record per row of ``pages`` to WARC files below ``folder``, one file a task.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with the smallest id are responses and the others
    revisits of it; rows of the same smallest id, as of repeated rows, are all responses, and so are rows without an id.
    A null html is an empty payload; a null url or id leaves its header out. Records end with the blank lines that
    Spark's text writer puts after each row, so files are plain WARC, compressed whole; with ``compression`` "none" they can
    be read in splits. Payloads that occur twice are listed first, by digest; where these are few, the rows meet them
    without a shuffle of their bytes.
    """
    rows = digests(pages, id_col, url_col, html_col)
    first = materialise(rows.where(F.octet_length("payload") >= min_revisit).groupBy("sha").agg(
        F.min("page_id").alias("first_page"), F.min_by("url", "page_id").alias("first_url"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                again = r["page_id"] is not None and r["first_page"] is not None and r["page_id"] > r["first_page"]
                refers_to = record_id(r["first_page"], r["first_url"], r["sha"]) if again else None
                out.append(record(r["page_id"], r["url"], r["sha"], r["payload"], refers_to, r["first_page"]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = rows.join(first, "sha", "left").select("page_id", "url", "payload", "sha", "first_page", "first_url")
    values = records.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    values.write.option("lineSep", END.decode()).option("compression", compression).text(folder)


def _header(raw: bytes, name: bytes) -> str | None:
    found = re.search(rb"^" + re.escape(name) + rb":[ \t]*(.*?)[ \t]*\r?$", raw, re.I | re.M)
    return found[1].decode("utf-8", "replace") if found else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


FIELDS = (
    "page_id long, record_id string, record_type string, url string, refers_to_id string, refers_to long, declared string, "
    "payload_bytes long, payload_digest string"
)
FIELD_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def fields(record: bytes) -> dict:
    """The headers of a record, and length and digest of the payload that it holds, with the payload."""
    head, _, body = record.partition(END)
    payload = body[: int(LENGTH.search(head)[1])].partition(END)[2]
    return {
        "page_id": _number(_header(head, b"X-Page-Id")), "record_id": _header(head, b"WARC-Record-ID"),
        "record_type": _header(head, b"WARC-Type"), "url": _header(head, b"WARC-Target-URI"),
        "refers_to_id": _header(head, b"WARC-Refers-To"), "refers_to": _number(_header(head, b"X-Refers-To-Page-Id")),
        "declared": (_header(head, b"WARC-Payload-Digest") or "").removeprefix("sha1:"), "payload_bytes": len(payload),
        "payload_digest": digest(payload), "payload": payload,
    }


KINDS = {"long": pa.int64(), "string": pa.string()}
FIELD_SCHEMA = [(f.split()[0], KINDS[f.split()[1]]) for f in FIELDS.split(", ")]


def successor(piece: bytes, at: int) -> int | None:
    """Where the record that a piece at ``at`` starts says that it ends; None if the piece has no header."""
    head, blank, _ = piece.partition(END)
    found = LENGTH.search(head) if blank and head.startswith(MAGIC) else None
    return at + len(head) + len(END) + int(found[1]) + len(END) if found else None


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """``(file, block, at, piece)`` of the cut rows of splits, in order."""
    key, at = None, 0
    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != key:
                key, at = (file, block), 0
            first = block == 0 and at == 0
            yield (file, block, 0, value) if first else (file, block, at - len(MAGIC), MAGIC + value)
            at += len(value) + len(CUT)


def _cut(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("lineSep", CUT.decode()).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary")
    )


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, block, at, size, next, whole, FIELDS)``: the archives cut at each line that starts with the magic.

    A piece is a candidate record, header and all, with its payload up to the next candidate. ``at`` is its place relative
    to its split's first cut, ``next`` the place where its header says that the successor starts, null without a header.
    Every byte belongs to one piece or cut, so places in the file are sums of lengths. A piece that ends where its header
    says is ``whole``; its fields are taken while it is at hand, and count if it turns out to be a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _placed(batches)
        schema = pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("next", pa.int64()),
            ("whole", pa.bool_()), *FIELD_SCHEMA,
        ])
        while some := list(islice(rows, 1000)):
            out = []
            for file, block, at, piece in some:
                end = successor(piece, at)
                whole = end is not None and end - at - len(piece) in (0, 1)
                row = fields(piece) if whole else dict.fromkeys(FIELD_NAMES)
                row.pop("payload", None)
                out.append({"file": file, "block": block, "at": at, "size": len(piece), "next": end, "whole": whole, **row})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _cut(spark, folder).mapInArrow(run, f"file string, block long, at long, size long, next long, whole boolean, {FIELDS}")


def values(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, block, at, value)`` of the same pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _placed(batches)
        while some := list(islice(rows, 256)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*some, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["file", "block", "at", "value"],
            )

    return _cut(spark, folder).mapInArrow(run, "file string, block long, at long, value binary")


def chained(candidates: DataFrame) -> DataFrame:
    """Adds ``leaves``: where the chain from a candidate first meets a place that is no candidate of its own split.

    ``candidates`` has ``(file, block, at, next)`` by place in the file. One task follows the chains inside one split,
    whose size Spark bounds, so that between splits a few jumps remain.
    """

    def follow(split: pd.DataFrame) -> pd.DataFrame:
        split = split.sort_values("at", ascending=False)
        leaves: dict[int, int] = {}
        for at, after in zip(split["at"].tolist(), split["next"].tolist(), strict=True):
            leaves[at] = leaves.get(after, after)
        return split.assign(leaves=split["at"].map(leaves))

    return candidates.groupBy("file", "block").applyInPandas(follow, "file string, block long, at long, next long, leaves long")


def entries(chains: DataFrame) -> DataFrame:
    """``(file, at)``: the places by which the chain from each file's start enters its splits, by pointer jumping.

    Each round joins the places reached so far with the jumps and doubles the jumps, so a file of n splits takes about
    log n rounds. A round's results are written to the shared folder; the driver sees counts.
    """
    jumps = materialise(chains.select("file", "at", F.col("leaves").alias("to")))
    known = materialise(jumps.where("at = 0").select("file", "at"))
    count = known.count()
    while True:
        ahead = known.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = materialise(known.unionByName(ahead.join(jumps.select("file", "at"), ["file", "at"], "left_semi")).distinct())
        found = reached.count()
        if found == count:
            return known
        known, count = reached, found
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        # A jump that ends at no candidate stays as it is.
        jumps = materialise(jumps.join(second, ["file", "to"], "left").select("file", "at", F.coalesce("far", "to").alias("to")))


def verified(candidates: DataFrame) -> DataFrame:
    """``(file, block, at, next)`` of the candidates on the chain from each file's start; the others lie inside payloads."""
    chains = materialise(chained(candidates))
    entered = entries(chains).withColumn("entered", F.lit(True))
    marked = chains.join(entered, ["file", "at"], "left").select("file", "block", "at", "next", "entered")

    def walk(split: pd.DataFrame) -> pd.DataFrame:
        successor = dict(zip(split["at"].tolist(), split["next"].tolist(), strict=True))
        kept = set()
        for at in split.loc[split["entered"].eq(True), "at"].tolist():
            while at in successor and at not in kept:
                kept.add(at)
                at = successor[at]
        return split.loc[split["at"].isin(kept), ["file", "block", "at", "next"]]

    return marked.groupBy("file", "block").applyInPandas(walk, "file string, block long, at long, next long")


def read(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The FIELDS of each record of the archives, and with ``payload`` its payload.

    Only records reachable from the start of their file count. Length and digest are those of the payload that was read,
    ``declared`` is the digest in the header. Records that a payload's own text cut into pieces, or that lie across splits,
    are put together from a second reading, as are all records if payloads are asked for; the others need no shuffle of
    their bytes. An archive cut off in a payload yields what is there.
    """
    raw = materialise(pieces(spark, folder))
    # The magic stands in the piece and its line break between two.
    sizes = raw.groupBy("file", "block").agg((F.max(F.col("at") + F.col("size")) + len(CUT)).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialise(sizes.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base")))
    placed = raw.join(bases, ["file", "block"]).withColumn("place", F.col("at") + F.col("base"))
    candidates = placed.where(F.col("next").isNotNull()).select(
        "file", "block", F.col("place").alias("at"), (F.col("next") + F.col("base")).alias("next")
    )
    records = materialise(verified(candidates))
    starts = records.select("file", F.col("at").alias("place"))
    whole = placed.where("whole").join(starts, ["file", "place"], "left_semi").select(*FIELD_NAMES)
    # Each piece belongs to the last record that starts at or before it, in its split or in an earlier one.
    lasts = records.groupBy("file", "block").agg(F.max("at").alias("last"))
    carried = bases.join(lasts, ["file", "block"], "left").select(
        "file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried")
    )
    so_far = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    owned = placed.select("file", "block", "at", "place", "whole").join(
        starts.withColumn("start", F.col("place")), ["file", "place"], "left"
    ).withColumn("start", F.last("start", ignorenulls=True).over(so_far)).join(carried, ["file", "block"])
    owned = owned.withColumn("start", F.coalesce("start", "carried")).where(F.col("start").isNotNull())
    broken = owned.where("place = start").where(F.lit(payload) | ~F.col("whole")).select("file", "start")
    needed = materialise(owned.join(broken, ["file", "start"], "left_semi").select("file", "block", "at", "start"))
    parts = values(spark, folder).join(needed, ["file", "block", "at"]).groupBy("file", "start").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda x: x.getField("value")).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*FIELD_SCHEMA, ("payload", pa.binary())])
        for batch in batches:
            out = [fields(b"\n".join(x)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    rebuilt = parts.select("parts").mapInArrow(run, f"{FIELDS}, payload binary")
    return rebuilt if payload else whole.unionByName(rebuilt.drop("payload"))


def resolved(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per record, revisits by the response they name.

    A revisit of a record that is not in the archives has a null length and digest.
    """
    hashed = materialise(records)
    responses = hashed.where("record_type = 'response'")
    named = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    revisits = hashed.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(named, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(columns).unionByName(revisits.select(columns))

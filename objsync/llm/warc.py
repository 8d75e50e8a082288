"""Web archives: records written in segments, and their reassembly."""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm.common import stored

# A payload of fewer bytes is always stored in full.
REVISIT_BYTES = 1000
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
# Records of one archive file: with the segment size, the bound of what a reader holds.
ARCHIVE_RECORDS = 512

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URI = "urn:page:"

RECORD = ("record_uri string, record_type string, page_id long, refers_to long, url string, payload_digest string,"
          " payload_bytes long, payload binary, segment int, total_length long, problem string")


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per page (``page_id``, ``url``, ``html``) as compressed WARC files below ``folder``.

    Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
    largest page id is a response, the others are revisits of it without a body; a
    page without an id revisits it too, and where all ids are null each is a
    response. Repeats of the row with the largest id are responses. The body of a
    response is in chunked transfer framing. A block beyond ``segment_bytes`` is
    split over continuation records. Null html is an empty payload; a null url is
    left out of the header, and white space and control characters in one are
    percent-encoded. Repeated rows give a record each. Other columns are ignored.

    Copies are found by an aggregate of digests; only digests that occur again are
    joined back, so a digest of a third of all pages splits like any skewed join.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    again = rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1 and kept is not null").drop("n")
    rows = rows.join(stored(again, "copies"), "digest", "left")
    refers = F.when(~F.coalesce(F.col("page_id") == F.col("kept"), F.lit(False)), F.col("kept"))
    ready = rows.select(
        F.monotonically_increasing_id().alias("number"), "page_id", "url", "digest", refers.alias("refers_to"),
        F.octet_length("payload").cast("long").alias("size"), F.when(refers.isNull(), F.col("payload")).alias("payload"))

    def records(batches):
        for batch in batches:
            lines = []
            for row in batch.to_pylist():
                lines.extend(_records(row, segment_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(lines, type=pa.binary())], ["record"])

    text = ready.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", ARCHIVE_RECORDS).option("compression", "gzip").text(folder)


def _records(row: dict, segment_bytes: int) -> list[bytes]:
    """The WARC records of one page, each without its last line feed, which the text writer adds."""
    page = "" if row["page_id"] is None else row["page_id"]
    uri = f"<{PAGE_URI}{page}:{row['number']}>"
    head = {"WARC-Type": "response", "WARC-Record-ID": uri, "WARC-Date": "2000-01-01T00:00:00Z"}
    if row["url"] is not None:
        head["WARC-Target-URI"] = _clean(row["url"])
    head["WARC-Payload-Digest"] = f"sha1:{row['digest']}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Payload-Length: {row['size']}\r\n"
    if row["refers_to"] is not None:
        head |= {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": f"<{PAGE_URI}{row['refers_to']}>"}
        return [_record(head, f"{http}\r\n".encode())]
    body = row["payload"]
    parts = [body[at:at + CHUNK_BYTES] for at in range(0, len(body), CHUNK_BYTES)]
    framed = b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"
    block = f"{http}Transfer-Encoding: chunked\r\n\r\n".encode() + framed
    pieces = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        return [_record(head, block)]
    found = [_record(head | {"WARC-Segment-Number": "1"}, pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"{uri[:-1]}:{number}>", "WARC-Date": head["WARC-Date"],
                "WARC-Segment-Origin-ID": uri, "WARC-Segment-Number": str(number)}
        if number == len(pieces):
            more["WARC-Segment-Total-Length"] = str(len(block))
        found.append(_record(more, piece))
    return found


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record(head: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r"


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Read the archives back, one row per response or revisit record.

    A record in one piece is decoded where it is read. Only segments are dealt out:
    by the record that they continue, put in order by segment number, and checked
    against the total length before the body's chunked framing is decoded.
    Result: ``page_id`` (null where the record has none), ``url``, ``record_type``,
    ``refers_to``, ``payload_bytes``, ``payload_digest`` (of a revisit: as its header
    says), ``payload`` (null for a revisit, and without ``payloads``) and ``problem``,
    null for a sound record, else what is wrong with it: a missing segment, a wrong
    total length, broken framing or a digest that differs. No files give no rows.
    """
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").load(folder).select("content")

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = list(_parse(gzip.decompress(content.as_buffer())))
                if not payloads:
                    rows = [row if "segment" in row else row | {"payload": None} for row in rows]
                for at in range(0, len(rows), 64):
                    yield _batch(rows[at:at + 64])

    def reassemble(batches):
        for batch in batches:
            rows = [_joined(row) for row in batch.to_pylist()]
            yield _batch(rows if payloads else [row | {"payload": None} for row in rows])

    found = stored(files.mapInArrow(parse, RECORD), "records")
    pieces = found.filter("segment is not null")
    grouped = pieces.groupBy("record_uri").agg(
        *[F.max(c).alias(c) for c in ("record_type", "page_id", "url", "payload_digest", "total_length")],
        F.array_sort(F.collect_list(F.struct("segment", "payload"))).alias("parts"))
    whole = grouped.mapInArrow(reassemble, RECORD)
    columns = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "problem")
    return found.filter("segment is null").unionByName(whole).select(*columns)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in RECORD.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], type=kinds[k]) for n, k in fields],
                                      [n for n, _ in fields])


def _parse(data) -> list[dict]:
    """The records of one archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        end = _find(view, b"\r\n\r\n", at)
        lines = bytes(view[at:end]).decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        block = bytes(view[end + 4:end + 4 + size])
        at = end + 4 + size + 4
        uri = head["WARC-Record-ID"]
        row = {"record_uri": head.get("WARC-Segment-Origin-ID", uri), "record_type": head["WARC-Type"],
               "url": head.get("WARC-Target-URI"), "payload_digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:")}
        page = re.match(rf"<{PAGE_URI}(-?\d*):", uri)
        row["page_id"] = int(page[1]) if page and page[1] else None
        if "WARC-Segment-Number" in head:
            total = head.get("WARC-Segment-Total-Length")
            kind = None if row["record_type"] == "continuation" else row["record_type"]
            row |= {"record_type": kind, "segment": int(head["WARC-Segment-Number"]), "payload": block,
                    "payload_digest": row["payload_digest"] or None, "total_length": int(total) if total else None}
        elif row["record_type"] == "revisit":
            row["refers_to"] = int(head["WARC-Refers-To"][len(PAGE_URI) + 1:-1])
            row["payload_bytes"] = int(_http(block)[0]["x-payload-length"])
        else:
            row |= _decoded(block, row["payload_digest"])
        yield row


def _find(view: memoryview, mark: bytes, at: int, step: int = 4096) -> int:
    """The place of a mark, searched in short copies of the view."""
    while at < len(view):
        found = bytes(view[at:at + step + len(mark)]).find(mark)
        if found >= 0:
            return at + found
        at += step
    raise ValueError("A record header does not end")


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if line)}, body


def _decoded(block: bytes, digest: str | None) -> dict:
    """Payload, size and digest of a whole HTTP response."""
    head, body = _http(block)
    payload, problem = body, None
    if head.get("transfer-encoding") == "chunked":
        parts, at = [], 0
        while True:
            end = body.find(b"\r\n", at)
            size = re.match(rb"[0-9a-fA-F]+", body[at:end]) if end >= 0 else None
            if not size or len(body) < end + 4 + int(size[0], 16):
                problem = "broken framing"
                break
            count = int(size[0], 16)
            if not count:
                break
            parts.append(body[end + 2:end + 2 + count])
            at = end + 4 + count
        payload = b"".join(parts)
    actual = hashlib.sha1(payload).hexdigest()
    if not problem and digest and actual != digest:
        problem = "digest differs"
    return {"payload": payload, "payload_bytes": len(payload), "payload_digest": actual, "problem": problem}


def _joined(row: dict) -> dict:
    parts, total = row["parts"], row["total_length"]
    block = b"".join(part["payload"] for part in parts)
    out = {k: row[k] for k in ("record_uri", "record_type", "page_id", "url", "payload_digest")}
    if [part["segment"] for part in parts] != list(range(1, len(parts) + 1)) or total is None:
        return out | {"problem": "missing segment"}
    if total != len(block):
        return out | {"problem": "wrong total length"}
    return out | _decoded(block, row["payload_digest"])

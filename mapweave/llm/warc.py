"""WARC archives that are written with their index and read by it.

Writing: each task appends one gzip member per record to an archive of its own in the shared folder and returns the
index rows (file, offset, length, url, digest); the index is a table, so a task that is run again leaves at most a file
that no row names. Reading: the selected index rows are dealt by ranges of file and offset, as many as the archives' bytes
ask for; neighbours are joined into one read while the gap between them is small, and each record is cut from that read.

Of rows with equal payloads of at least MIN_REVISIT bytes, that with the smallest page_id is a response (each, if the
row repeats); the others are revisit records without the payload. Null html counts as an empty payload; a null page_id
or url is left out of the record's header and comes back null; a null page_id sorts after all others.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

MIN_REVISIT = 100
#: Read on over a gap of at most so many bytes, and at most so many bytes at once unless one record is longer.
GAP_BYTES, READ_BYTES = 64 << 10, 4 << 20
ROLL_BYTES = 1 << 30
#: Archive bytes that a reading task gets about, as long as that makes no more than so many tasks.
PART_BYTES, MOST_PARTS = 4 << 20, 50_000
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string"


def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, html with payload_digest, record_type and refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).alias("_bytes"))
    repeated = (
        rows.where(F.col("_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").select("payload_digest", "_first")
    )
    revisit = F.col("_first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("_first")))
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("_first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str | None, digest: str, kind: str, refers_to: int | None, place: str = "") -> bytes:
    """One WARC/1.1 record; place (its file and offset) makes its record id, so that rows that repeat have ids of their own."""
    payload = (html or "").encode()
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place}#{page_id}')}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
        lines.append(f"X-Url: {quote(url, safe='')}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Header fields of a record, lower-case, and its payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        key, _, value = line.partition(": ")
        fields[key.lower()] = value
    body = rest[: int(fields["content-length"])]
    fields["payload"] = body.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
    return fields


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives below folder (a URI that executors share); returns the index."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out = file = None
        at = ROLL_BYTES
        for part in shared.slices(batches, "html"):
            rows, where = part.to_pylist(), ([], [], [])
            for r in rows:
                if at >= ROLL_BYTES:
                    if out:
                        out.close()
                    file, at = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(file, compression=None)
                raw = gzip.compress(record(r["page_id"], r["url"], r["html"], r["payload_digest"], r["record_type"], r["refers_to"], f"{file}@{at}"), 4, mtime=0)
                out.write(raw)
                for to, value in zip(where, (file, at, len(raw)), strict=True):
                    to.append(value)
                at += len(raw)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(where[0], pa.string()), pa.array(where[1], pa.int64()), pa.array(where[2], pa.int64()), part.column("payload_digest")], ["page_id", "url", "file", "offset", "length", "payload_digest"])
        if out:
            out.close()

    return shared.map_arrow(pages, step, INDEX)


def ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Sorted index rows as runs to be read at once."""
    run: list[dict] = []
    for r in rows:
        if run and (r["file"] != run[-1]["file"] or r["offset"] - run[-1]["offset"] - run[-1]["length"] > GAP_BYTES or r["offset"] + r["length"] - run[0]["offset"] > READ_BYTES):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def read(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that the index names: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The payload (only if asked for) is null for revisits. A response whose payload doesn't have its digest is an error.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        source, name = None, None
        for batch in batches:
            for run in ranges(batch.to_pylist()):
                if run[0]["file"] != name:
                    if source:
                        source.close()
                    name = run[0]["file"]
                    source = store.open_input_file(name)
                begin = run[0]["offset"]
                block = source.read_at(run[-1]["offset"] + run[-1]["length"] - begin, begin)
                out = []
                for r in run:
                    x = parse(gzip.decompress(block[r["offset"] - begin : r["offset"] - begin + r["length"]]))
                    digest = x["warc-payload-digest"].removeprefix("sha256:")
                    if x["payload"] is not None and hashlib.sha256(x["payload"]).hexdigest() != digest:
                        raise ValueError(f"damaged record at {r['offset']} of {name}")
                    out.append({
                        "page_id": int(x["x-page-id"]) if "x-page-id" in x else None,
                        "url": unquote(x["x-url"]) if "x-url" in x else None,
                        "payload_bytes": int(x["x-payload-length"]) if x["payload"] is None else len(x["payload"]),
                        "payload_digest": digest,
                        "record_type": x["warc-type"],
                        "refers_to": int(x["x-refers-to-page"]) if "x-refers-to-page" in x else None,
                        "payload": x["payload"] if with_payload else None,
                    })
                yield pa.RecordBatch.from_pylist(out, pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]))
        if source:
            source.close()

    n_bytes = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = min(MOST_PARTS, max(1, -(-n_bytes // PART_BYTES)))
    wanted = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return shared.map_arrow(wanted, step, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every record back by the index."""
    folder = f"{shared.shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    shared.forget_later(pages.sparkSession, folder)
    index = shared.materialize(write(classified(pages), folder), "warc-index")
    return read(index, folder)

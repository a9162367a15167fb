"""WARC archives: a writer with revisit records and a splittable reader (operator 8).

A record is a gzip member of its own, so any byte range of an archive can be read without what is
before it. The reader's tasks each take a range, look for the gzip magic, and accept a candidate only
if it decodes to a WARC header with its length. A record belongs to the range it begins in and
is read to its end, also where that lies in the next range. From an accepted record the scan goes on at its
end, so bytes inside it are never candidates.

Among records with equal payloads of at least ``least`` bytes the one with the greatest id is the
response; the others are revisits, which hold the header block of the answer (with the length of the payload)
and the digest, but no payload. Only (digest, greatest id) is grouped, combined before its shuffle;
payloads meet it in a plain join, which is split where thousands of pages are equal.

Null payload: empty. Null url: empty. Null id: less than all others; if a whole group has none, all are
responses. Rows that repeat the greatest id are all responses. Line breaks in urls come back
percent-encoded. Empty table: no archives, empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from array import array
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skilltide.llm._files import new_file, opened
from skilltide.llm._rows import ship_package
from skilltide.session import saved, scratch_dir

RANGE_BYTES = 8 << 20
FILE_BYTES = 1 << 30
TASKS = 20_000
MAGIC = b"\x1f\x8b\x08"
MARK = b"WARC/1."
HEAD = 1 << 16
READ = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(name: str | None) -> str:
    return "<urn:x-page:null>" if name is None else f"<urn:x-page:id:{quote(name, safe='')}>"


def _name(urn: str) -> str | None:
    return unquote(urn[15:-1]) if urn.startswith("<urn:x-page:id:") else None


def _record(name, url, payload: bytes, digest: bytes, refers, revisit: bool, date: str) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(name)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers)}", f"WARC-Profile: {PROFILE}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packed.flush()


def _writer(folder: str, file_bytes: int, date: str):
    def run(batches):
        done, out, size, starts, uri = [], None, 0, array("q"), ""
        for batch in batches:
            for name, url, payload, digest, refers, revisit in zip(*(c for c in batch.columns), strict=True):
                if out is None:
                    (out, uri), size, starts = new_file(folder, ".warc.gz"), 0, array("q")
                record = _record(name.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers.as_py(), revisit.as_py(), date)
                out.write(record)
                starts.append(size)
                size += len(record)
                if size >= file_bytes:
                    out.close()
                    done, out = [*done, (uri, size, starts)], None
        if out is not None:
            out.close()
            done.append((uri, size, starts))
        for path, size, starts in done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([size], pa.int64()), pa.array([len(starts)], pa.int64()), pa.array([np.array(starts, np.int64)], pa.list_(pa.int64()))],
                ["path", "size", "records", "starts"],
            )

    return run


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, least: int = 0,
    file_bytes: int = FILE_BYTES, date: str = "2001-08-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row to archives in ``folder``; returns the saved list (path, size, records, starts: where they
    begin) of them."""
    ship_package(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    greatest = saved(
        rows.filter(F.octet_length("payload") >= least).groupBy(F.col("digest").alias("same")).agg(F.max("id").alias("greatest")), "payloads"
    )
    joined = rows.join(greatest, F.col("digest") == F.col("same"), "left")
    revisit = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("greatest"))
    chosen = joined.select(
        F.col("id").cast("string"), "url", "payload", "digest", F.col("greatest").cast("string").alias("refers"), revisit.alias("revisit")
    )
    return saved(chosen.mapInArrow(_writer(folder, file_bytes, date), "path string, size long, records long, starts array<long>"), "archives")


def _header(text: bytes) -> dict[str, str] | None:
    """The named fields of a WARC header, or None if it is none."""
    if not text.startswith(MARK) or (end := text.find(b"\r\n\r\n")) < 0:
        return None
    fields = dict(line.split(": ", 1) for line in text[:end].decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    if not fields.get("Content-Length", "").isdigit() or "WARC-Type" not in fields or "WARC-Record-ID" not in fields:
        return None
    return fields | {"": str(end + 4)}


def _member(file, at: int, first: bytes) -> tuple[dict[str, str], bytes, int] | None:
    """The record whose gzip member begins at ``at``: fields, block and the member's length. None if no
    record begins there. ``first`` are the bytes from there that were read already."""
    packed = zlib.decompressobj(31)
    try:
        text, given = bytearray(packed.decompress(first, HEAD)), len(first)
        # a header is as long as its url: go on to the blank line as long as this can be one
        seen = 0
        while text.startswith(MARK[: len(text)]) and text.find(b"\r\n\r\n", max(0, seen - 3)) < 0 and not packed.eof:
            seen, more = len(text), packed.unconsumed_tail
            if not more:
                more = file.read_at(READ, at + given)
                if not more:
                    return None
                given += len(more)
            text += packed.decompress(more, READ)
        text = bytes(text)
        if (fields := _header(text)) is None:
            return None
        parts = [text]
        if not packed.eof:  # after the end the tail is what follows the member
            parts.append(packed.decompress(packed.unconsumed_tail))
        while not packed.eof:
            more = file.read_at(READ, at + given)
            if not more:
                return None
            given += len(more)
            parts.append(packed.decompress(more))
    except zlib.error:
        return None
    text, start, size = b"".join(parts), int(fields[""]), int(fields["Content-Length"])
    if len(text) != start + size + 4:
        return None
    return fields, text[start : start + size], given - len(packed.unused_data)


def records(uri: str, start: int, end: int):
    """The records that begin in the bytes from ``start`` to before ``end`` of an archive."""
    with opened(uri) as file:
        at, low, data = start, start, b""
        while at < end:
            if at + HEAD > low + len(data):
                low, data = at, file.read_at(READ, at)
            found = data.find(MAGIC, at - low)
            if found < 0 or low + found >= end:
                after = low + len(data) - len(MAGIC) + 1
                if found >= 0 or len(data) < READ or after >= end:
                    return
                at = max(at + 1, after)
                continue
            at = low + found
            if at + HEAD > low + len(data) and len(data) == READ:
                low, data = at, file.read_at(READ, at)
            got = _member(file, at, data[at - low :])
            if got is None:
                at += 1
                continue
            yield got[0], got[1]
            at += got[2]


def _reader():
    names = ["id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            for uri, start, end, written in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end", "written")), strict=True):
                rows, held, found = [], 0, 0
                for fields, block in records(uri, start, end):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "revisit":
                        answer = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                        size, payload = int(answer["Content-Length"]), None
                    else:
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest != said:
                            raise ValueError(f"{uri}: payload of {fields['WARC-Record-ID']} does not have its digest")
                    refers = _name(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
                    rows.append((_name(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI", ""), fields["WARC-Type"], payload, size, said, refers))
                    held, found = held + len(block), found + 1
                    if held > READ * 8:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, held = [], 0
                if written is not None and found != written:
                    raise ValueError(f"{uri}, bytes {start} to {end}: {written} records were written, {found} are found")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _ranges(range_bytes: int):
    """Archives in ranges, with the number of records that begin in each where the list says it."""

    def run(batches):
        for batch in batches:
            known = "starts" in batch.schema.names
            for i, (path, size, first) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("path", "size", "first")), strict=True)):
                start = np.arange(0, size, range_bytes, dtype=np.int64)
                end = np.minimum(start + range_bytes, size)
                if known and batch.column("starts")[i].is_valid:
                    at = np.sort(batch.column("starts")[i].values.to_numpy())
                    written = pa.array(np.searchsorted(at, end) - np.searchsorted(at, start))
                else:
                    written = pa.nulls(len(start), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(start)), pa.array(start), pa.array(end), pa.array(first + np.arange(len(start))), written],
                    ["path", "start", "end", "number", "written"],
                )

    return run


def read_archives(archives: DataFrame, id_type: str = "bigint", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the archives (path, size): id, url, record_type, payload (null in a revisit),
    payload_bytes, payload_digest, refers_to. A task reads a range; with more than ``TASKS`` ranges, each several.
    Where the list also has ``starts``, the task compares the number of records it finds: a difference is an
    error, as is a list whose ``records`` are not as many as its ``starts``."""
    ship_package(archives.sparkSession)
    files, n = archives.filter("size > 0"), F.ceil(F.col("size") / range_bytes).cast("long")
    if "records" in archives.columns and "starts" in archives.columns:
        if wrong := files.filter("records <> size(starts)").select("path", "records", F.size("starts").alias("found")).first():
            raise ValueError(f"{wrong['path']}: {wrong['records']} records were written, {wrong['found']} are found")
    ranges = files.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    # a row per archive of a gigabyte: paths and sizes
    before = files.select(F.col("path").alias("of"), (F.sum(n).over(Window.orderBy("path")) - n).alias("first"))
    named = files.join(before, F.col("path") == F.col("of"))
    cut = named.select("path", "size", "first", *(["starts"] if "starts" in archives.columns else [])).mapInArrow(
        _ranges(range_bytes), "path string, start long, end long, number long, written long"
    )
    # dealt by number: adaptive execution does not merge these, though a range is a row of a hundred bytes
    dealt = cut.repartitionById(max(1, min(ranges, TASKS)), F.pmod("number", F.lit(max(1, min(ranges, TASKS)))).cast("int"))
    read = dealt.mapInArrow(
        _reader(), "id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string"
    )
    return read.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", **options) -> DataFrame:
    """Write ``pages`` to new archives in the shared folder and read them."""
    archives = write_archives(pages, scratch_dir(spark, "warc"), id_col, url_col, payload_col, **options)
    return read_archives(archives, pages.schema[id_col].dataType.simpleString())

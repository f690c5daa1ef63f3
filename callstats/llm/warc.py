"""WARC archives: a writer and a salvage reader.

Archives are written by Spark's own file writer, one gzip member per record
(or plain records), so tasks commit them like any other output and they can
lie in any store Spark writes to. The reader checks every record and, where a
check fails, searches for the next gzip member or version line, goes on from
there and logs the bytes it skipped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Target size of the pieces handed to the file writer, and pieces per file:
#: an archive holds about 32 MB, or one record if that is larger.
PIECE_BYTES = 1 << 20
PIECES_PER_FILE = 32

# Fixed values of the WARC 1.1 and gzip formats.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
NEXT_VERSION = b"\nWARC/1."
#: Longest header that is read.
MAX_HEADER = 8 << 20
MEMBER = b"\x1f\x8b\x08"
#: Bytes unpacked at once.
CHUNK = 1 << 16
#: An empty gzip member. It separates the pieces in a file of gzip members, so
#: that the file is nothing but gzip members.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)

RECORD_SCHEMA = (
    "archive string, at long, length long, found string, page_id long, record_type string, "
    "target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary, reason string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with the payload, or a revisit without it.
    Both keep the HTTP header, whose Content-Length is the full payload's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(3, f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
    return VERSION + "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``payload``, ``digest`` (hex SHA-1), ``revisit`` and ``refers_to``.

    Of the pages with equal payloads of at least ``min_bytes`` bytes the one
    with the largest page_id is the response and the others revisit it; rows
    that repeat that page_id are responses too. Equal payloads are found by
    digest and length. A group of any size costs one pre-aggregated row per
    map task, and the join back can be split by AQE.
    """
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")
    ).withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload")})
    last = full.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"))
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return (
        full.join(last, ["digest", "bytes"])
        .withColumn("revisit", revisit)
        .withColumn("refers_to", F.when(F.col("revisit"), F.col("refers_to")))
        .select("page_id", "url", "payload", "revisit", "refers_to")
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, members: bool = True) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to
    archives under ``path``: gzip members, or plain records."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                body = payload.encode("utf-8")
                rec = record_bytes(page_id, url, body, base32_sha1(body), refers_to, revisit)
                held.append(gzip.compress(rec, 3, mtime=0) if members else rec)
                size += len(held[-1])
                if size >= PIECE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["piece"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["piece"])

    # The writer puts a separator after each piece: an empty member, or the
    # blank line that may follow any record.
    separator = EMPTY_MEMBER.decode("latin-1") if members else "\r\n"
    (
        with_references(pages, min_bytes)
        .mapInArrow(pieces, "piece binary")
        .select(F.col("piece").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator)
        .option("maxRecordsPerFile", PIECES_PER_FILE)
        .text(path)
    )


def _parse(rec: bytes, start: int) -> tuple[int, dict]:
    """The record at ``start`` of ``rec``: (offset after it, fields). Raises
    ValueError with the failed check."""
    if not VERSION_LINE.match(rec, start):
        raise ValueError("no version line")
    # A header ends before the next version line: damaged ones are left quickly.
    following = rec.find(NEXT_VERSION, start + 1, start + MAX_HEADER)
    head_end = rec.find(b"\r\n\r\n", start, following if following >= 0 else start + MAX_HEADER)
    if head_end < 0:
        raise ValueError("header without end")
    head = {}
    for line in rec[start:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = head.get(b"content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise ValueError("no content length")
    block_start = head_end + 4
    end = block_start + int(length)
    block = rec[block_start:end]
    if rec[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    if head.get(b"warc-block-digest", "") not in ("", f"sha1:{base32_sha1(block)}"):
        raise ValueError("block digest differs")
    kind = head.get(b"warc-type", "")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", http)
    digest = head.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest not in ("", base32_sha1(payload)):
        raise ValueError("payload digest differs")

    def number(name: bytes) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", head.get(name, ""))
        return int(found[1]) if found else None

    return end + 4, {
        "page_id": number(b"warc-record-id"),
        "record_type": kind,
        "target_uri": head.get(b"warc-target-uri"),
        "payload_bytes": int(full[1]) if full else len(payload),
        "payload_digest": digest or base32_sha1(payload),
        "refers_to": number(b"warc-refers-to"),
        "payload": payload if kind == "response" else None,
    }


def _member(view: memoryview, start: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``start`` holds, the offset after it, and what is
    wrong with it ("" if nothing): of a broken one all that can be unpacked."""
    unzip, parts, pos = zlib.decompressobj(31), [], start
    while not unzip.eof:
        if pos >= len(view):
            return b"".join(parts), pos, "member is cut off"
        upto = min(pos + CHUNK, len(view))
        try:
            parts.append(unzip.decompress(view[pos:upto]))
        except zlib.error as e:
            more, pos = _before_error(view, start, pos, upto)
            return b"".join(parts) + more, pos, str(e)
        pos = upto
    return b"".join(parts), pos - len(unzip.unused_data), ""


def _before_error(view: memoryview, start: int, pos: int, upto: int) -> tuple[bytes, int]:
    """What the bytes from ``pos`` on yield before one is found wrong, and the
    offset after that one."""
    unzip = zlib.decompressobj(31)
    for at in range(start, pos, CHUNK):
        unzip.decompress(view[at : min(at + CHUNK, pos)])
    got = []
    try:
        for at in range(pos, upto):
            got.append(unzip.decompress(view[at : at + 1]))
    except zlib.error:
        upto = at + 1
    return b"".join(got), upto


def salvage(data: bytes, members: bool = True) -> Iterator[dict]:
    """Records and gaps of one archive, in order, each with ``at`` and
    ``length`` in its bytes and ``found`` ("record" or "gap").

    At every position the reader expects a gzip member of records, a plain
    record, or line ends between records. Anything else, and any record that
    fails a check (version line, header, length, end marker, digests), opens a
    gap, which ends at the next place from which a member or record reads well,
    or at the end of the archive. Inside a member it is the same: a damaged
    record is a gap, told with the member's place and its unpacked bytes, and
    the records after it are read. Of a member that is cut off or fails gzip's
    checks, the whole records it yields are kept, and its bytes become a gap as
    well. An empty archive has neither records nor gaps.
    """
    view, size = memoryview(data), len(data)
    pos, gap, why = 0, -1, ""
    next_member = next_line = -1
    kept_to = 0  # plain version lines before this are in a member already read
    while pos < size:
        found, broken = [], ""
        try:
            if members and data.startswith(MEMBER, pos):
                inner, end, broken = _member(view, pos)
                for r in salvage(inner, members=False):
                    if r["found"] == "gap":
                        if broken and r["at"] + r["length"] == len(inner):
                            continue  # part of the member's own gap
                        r["reason"] += f" (unpacked bytes {r['at']} to {r['at'] + r['length']})"
                    found.append(r | {"at": pos, "length": end - pos})
                if broken and not found:
                    raise ValueError(broken)
            elif VERSION_LINE.match(data, pos):
                end, fields = _parse(data, pos)
                found = [{"found": "record", "at": pos, "length": end - pos, **fields}]
            elif data[pos] in b"\r\n" and gap < 0:
                pos += 1
                continue
            else:
                raise ValueError("neither member nor version line")
        except ValueError as e:
            if gap < 0:
                gap, why = pos, str(e)
        else:
            if gap >= 0:
                yield {"found": "gap", "at": gap, "length": pos - gap, "reason": why}
                gap = -1
            yield from found
            if not broken:
                pos = end
                continue
            gap, why, kept_to = pos, broken, end
        # To the next place where a member or a record may begin.
        if next_member <= pos:
            next_member = data.find(MEMBER, pos + 1) if members else -1
            next_member = size if next_member < 0 else next_member
        if next_line <= pos or next_line < kept_to:
            line = VERSION_LINE.search(data, max(pos + 1, kept_to))
            next_line = line.start() if line else size
        pos = min(next_member, next_line)
    if gap >= 0:
        yield {"found": "gap", "at": gap, "length": size - gap, "reason": why}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path``: ``found`` is "record"
    or "gap" (a quarantined byte range with its ``reason``). One archive is
    read in one task; ``payloads=False`` leaves the payload column empty. An
    empty archive gives no rows; records and headers of any length up to
    MAX_HEADER are read, repeated records as often as they occur."""
    schema = spark.createDataFrame([], RECORD_SCHEMA).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        kinds += [pa.string(), pa.int64(), pa.binary(), pa.string()]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            arrays = [pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for k in range(b.num_rows):
                rows, size = [], 0
                for r in salvage(b.column(1)[k].as_py()):
                    r["archive"] = b.column(0)[k].as_py()
                    size += len(r.get("payload") or b"") if payloads else 0
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    if size > (8 << 20) or len(rows) >= 10_000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)

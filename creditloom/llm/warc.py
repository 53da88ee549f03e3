"""WARC archives: writing, and reading with segments put together again.

Writing. Each page is an HTTP response whose body is sent in chunks. Of equal payloads of at least
``LEAST_REVISIT`` bytes the one with the smallest page_id is stored, the others are ``revisit``
records that name its digest and record. A record block over ``SEGMENT_CHARS`` is cut: the first part
is the response with segment number 1, the rest are ``continuation`` records that carry the origin's
id and, on the last, the total length. Spark's text writer saves the records as gzip files, each
record a row and its closing two line ends the separator, so a lost task leaves no partial archive.

Reading. ``binaryFile`` gives whole files, which the writer keeps small, and a file has to fit into a
task as it lies on disk; it is inflated by windows and walked record by record by the lengths in the
headers, so that no more than a record and a window of it are held as text. Records of one segment are
decoded at once. Only cut ones are shuffled: grouped by origin, ordered by segment number, the numbers
must be 1..n and the length the stated total. Then the chunked body is decoded and its digest compared
with the header's. A record whose parts are missing, contradict the headers or have headers that are no
numbers keeps its row, with an ``error`` and no payload. Where a file breaks off, is damaged or holds
something else, a row with an ``error`` ends it; the records before stay.

An empty table gives an empty archive. Long payloads are cut into segments. Columns other than page_id,
url and html, whatever their names, are not read.

Nulls: a null html is an empty payload. A null url becomes an empty target. A null page_id is
written without one and reads back as null; its payload is stored and never referred to. Pages that
repeat a page_id are records of their own; if they repeat the payload as well, the one with the
smallest url is stored and the others refer to it. Rows equal in all columns are stored each.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_REVISIT = 100
# Characters per chunk of a body and per segment of a record block.
CHUNK_CHARS, SEGMENT_CHARS = 4096, 32768
# Bytes of a file that are inflated at a time.
WINDOW = 1 << 20
# Rows per archive file.
FILE_RECORDS = 2000
# Ways into which the copies of one payload are dealt while they look up their first page.
SALTS = 64
END = "\r\n"
# Fixed value: the name of the profile for revisits of equal payloads.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, type string, page_id bigint, url string, refers_to bigint,"
    " digest string, payload_bytes bigint, payload binary, error string"
)


def with_originals(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, url, html, digest, bytes, original)``; ``original`` is null for what is stored.

    Only digests that repeat are joined, each dealt into ``SALTS`` parts, as one payload may hold a
    large part of all pages.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("bigint").alias("bytes"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    long = F.col("bytes") >= least
    # Among rows of one page id and payload the smallest url is the one stored.
    first = F.min(F.struct("page_id", "url")).alias("first")
    known = F.col("page_id").isNotNull()
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = (
        rows.where(long & known)
        .groupBy("digest")
        .agg(first, F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.col("digest").alias("d"), "first", F.explode(salts).alias("s"))
    )
    same = (rows["digest"] == repeated["d"]) & (rows["salt"] == repeated["s"]) & long & known
    found = rows.join(repeated, same, "left")
    is_first = F.col("first").isNull() | (
        (F.col("page_id") == F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    )
    return found.select(
        "page_id", "url", "html", "digest", "bytes",
        F.when(~is_first, F.col("first.page_id")).alias("original"),
    )


def record_texts(
    pages: DataFrame, chunk: int = CHUNK_CHARS, segment: int = SEGMENT_CHARS
) -> DataFrame:
    """``value``: the text of each record, without the two line ends that close it."""
    rows = with_originals(pages)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    # Unique in this archive; rows may repeat in all columns.
    place = F.monotonically_increasing_id().cast("string")
    name = F.concat(F.lit("<urn:page:"), page, F.lit(":"), place, F.lit(">"))
    body = F.array_join(F.transform(_cut("html", chunk), _chunk), "")
    http = F.lit(
        f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"
        f"Transfer-Encoding: chunked{END}{END}"
    )
    block = F.when(F.col("original").isNull(), F.concat(http, body, F.lit(f"0{END}{END}")))
    block = block.otherwise(http)
    made = rows.select(
        "page_id", "url", "digest", "bytes", "original", name.alias("id"), block.alias("block")
    )
    cut = made.withColumn("all", _cut("block", segment)).select(
        "*", F.size("all").alias("parts"), F.octet_length("block").alias("total"),
        F.posexplode("all").alias("before", "part"),
    ).withColumn("number", F.col("before") + 1)
    first, stored = F.col("number") == 1, F.col("original").isNull()
    last, alone = F.col("number") == F.col("parts"), F.col("parts") == 1
    kind = F.when(~first, "continuation").when(stored, "response").otherwise("revisit")
    later_id = F.concat(F.expr("substr(id, 1, length(id) - 1)"), F.lit(":"), "number", F.lit(">"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    has_page = F.col("page_id").isNotNull()
    # Null where the record does not have the line.
    lines = [
        F.lit("WARC/1.1"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.when(first, F.col("id")).otherwise(later_id)),
        _line("WARC-Date", F.lit("2024-02-10T00:00:00Z")),
        F.when(first, _line("WARC-Target-URI", target)),
        F.when(first & has_page, _line("X-Page-ID", F.col("page_id"))),
        F.when(first, _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"))),
        F.when(first, _line("X-Payload-Length", F.col("bytes"))),
        F.when(first & ~stored, _line("WARC-Profile", F.lit(REVISIT))),
        F.when(first & ~stored, _line("X-Refers-To-Page", F.col("original"))),
        F.when(~alone, _line("WARC-Segment-Number", F.col("number"))),
        F.when(~first, _line("WARC-Segment-Origin-ID", F.col("id"))),
        F.when(~first & last, _line("WARC-Segment-Total-Length", F.col("total"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("part")),
    ]
    return cut.select(F.concat(F.concat_ws(END, *lines), F.lit(END * 2), "part").alias("value"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _cut(text: str, size: int) -> Column:
    """Consecutive parts of ``size`` characters, the last may be shorter."""
    return F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def _chunk(text: Column) -> Column:
    return F.concat(F.lower(F.hex(F.octet_length(text))), F.lit(END), text, F.lit(END))


def write_archive(pages: DataFrame, folder: str) -> None:
    """Write ``pages`` as gzip WARC files."""
    record_texts(pages).write.option("lineSep", END * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(folder)


def inflated(content: bytes, window: int = WINDOW) -> Iterator[bytes]:
    """The content in pieces of at most ``window`` bytes, gzip members one after the other.

    EOFError where a member breaks off, zlib.error where it is damaged.
    """
    view, at = memoryview(content), 0
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(view), window):
            yield bytes(view[at : at + window])
        return
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            # What the last piece left, before more is taken.
            piece = member.unconsumed_tail or bytes(view[at : at + window])
            if not member.unconsumed_tail:
                at += len(piece)
            found = member.decompress(piece, window)
            if found:
                yield found
            elif not piece and not member.eof:
                raise EOFError
        at -= len(member.unused_data)
        # Padding.
        while at < len(view) and view[at] == 0:
            at += 1


def file_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with names in lower case, and block of every record of a file.

    Held are one record and a window. What cannot be read ends the file with headers that have an
    ``error``; all records before it are given.
    """
    pieces, held, broken = inflated(content), bytearray(), ""

    def more() -> bool:
        nonlocal broken
        try:
            held.extend(next(pieces))
            return True
        except StopIteration:
            return False
        except EOFError:
            broken = "cut off"
        except zlib.error:
            broken = "damaged"
        return False

    while True:
        while held[:2] == b"\r\n" or (len(held) < 2 and more()):
            if held[:2] == b"\r\n":
                del held[:2]
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if not more():
                if held or broken:
                    yield {"error": broken or "unreadable"}, b""
                return
        if held[:5] != b"WARC/":
            yield {"error": "unreadable"}, b""
            return
        headers = {}
        for line in held[:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        # Only this reader says what is wrong with a record.
        headers.pop("error", None)
        length = number_in(headers, "content-length")
        if length is None or length < 0:
            yield headers | {"error": "bad length"}, b""
            return
        stop = end + 4 + length
        while len(held) < stop:
            if not more():
                yield headers | {"error": broken or "bad length"}, b""
                return
        yield headers, bytes(held[end + 4 : stop])
        del held[:stop]


NUMBER = re.compile(r"-?[0-9]{1,19}", re.A)


def number_in(headers: dict[str, str], name: str) -> int | None:
    """The whole number of a header; None if there is none or it does not fit."""
    value = headers.get(name, "")
    found = int(value) if NUMBER.fullmatch(value) else None
    return found if found is not None and -(1 << 63) <= found < 1 << 63 else None


CHUNK_SIZE = re.compile(rb"[0-9a-fA-F]{1,15}")


def unchunked(body: bytes) -> bytes:
    """The body without its chunk framing; ValueError if the framing is broken."""
    found, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        stated = body[at:end].split(b";")[0].strip()
        if not CHUNK_SIZE.fullmatch(stated):
            raise ValueError("bad chunk size")
        size = int(stated, 16)
        if size == 0:
            return b"".join(found)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("no chunk end")
        found.append(body[end + 2 : at])
        at += 2


NUMBERS = ("x-page-id", "x-refers-to-page", "x-payload-length", "warc-segment-total-length")


def decoded(headers: dict[str, str], block: bytes) -> dict:
    """A row of ``RECORDS`` from the headers and the whole block of a record."""
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = headers.get("warc-type")
    bad = [name for name in NUMBERS if headers.get(name) and number_in(headers, name) is None]
    row = {
        "record_id": headers.get("warc-record-id"), "type": kind,
        "page_id": number_in(headers, "x-page-id"), "url": headers.get("warc-target-uri"),
        "refers_to": number_in(headers, "x-refers-to-page"), "digest": digest or None,
        "payload_bytes": number_in(headers, "x-payload-length"), "payload": None,
        "error": headers.get("error") or (f"bad {bad[0]}" if bad else None),
    }
    if kind == "response" and not row["error"]:
        head, _, body = block.partition(b"\r\n\r\n")
        try:
            payload = unchunked(body) if b"chunked" in head.lower() else body
            row["payload"], row["payload_bytes"] = payload, len(payload)
            found = hashlib.sha256(payload).hexdigest()
            if digest and found != digest:
                row["error"] = "digest"
            row["digest"] = found
        except ValueError as broken:
            row["error"] = str(broken)
    return row


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all files below ``folder``, segments joined; columns ``RECORDS``."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    names = [field.split()[0] for field in RECORDS.split(", ")]
    schema = pa.schema(
        [
            (name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
            for name, kind in (field.split() for field in RECORDS.split(", "))
        ]
    )
    parts_schema = (
        "origin string, number int, total bigint, headers map<string,string>, block binary"
    )

    def origin_of(headers: dict[str, str]) -> str | None:
        """The record that a segment belongs to; None of a record that is whole or unfit to be joined."""
        if "warc-segment-number" not in headers or "error" in headers:
            return None
        number, own = number_in(headers, "warc-segment-number"), headers.get("warc-record-id")
        origin = headers.get("warc-segment-origin-id", own)
        if number is None or not 1 <= number < 1 << 31 or not origin:
            headers["error"] = "bad warc-segment-number" if origin else "no record id"
            return None
        return origin

    def row_of(headers, block):
        row = decoded(headers, block)
        return row if with_payload else row | {"payload": None}

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in file_records(content.as_py()):
                    if origin_of(headers):
                        continue
                    rows.append(row_of(headers, block))
                    held += len(rows[-1]["payload"] or b"")
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    part_type = pa.schema(
        [
            ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
            ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()),
        ]
    )

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for headers, block in file_records(content.as_py()):
                    origin = origin_of(headers)
                    if not origin:
                        continue
                    row = {
                        "origin": origin, "number": number_in(headers, "warc-segment-number"),
                        "total": number_in(headers, "warc-segment-total-length"),
                        "headers": list(headers.items()), "block": block,
                    }
                    yield pa.RecordBatch.from_pylist([row], part_type)

    def together(group: pa.Table) -> pa.Table:
        parts = sorted(group.to_pylist(), key=lambda part: part["number"])
        block = b"".join(part["block"] for part in parts)
        total = next((part["total"] for part in parts if part["total"] is not None), None)
        headers = dict(parts[0]["headers"])
        if [part["number"] for part in parts] != list(range(1, len(parts) + 1)):
            headers["error"] = "segments"
        elif total != len(block):
            headers["error"] = "total length"
        return pa.Table.from_pylist([row_of(headers, block)], schema)

    joined = files.mapInArrow(segments, parts_schema).groupBy("origin").applyInArrow(
        together, RECORDS
    )
    return files.mapInArrow(whole, RECORDS).unionAll(joined).select(*names)

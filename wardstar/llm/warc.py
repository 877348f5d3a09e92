"""Web archives: written as segmented, chunked WARC records, read back and reassembled.

Writing: pages with equal payloads become one response and revisits of it. A response block is an
HTTP message with chunked transfer framing. A block beyond SEGMENT bytes goes out as a first
segment and continuation records, each a record of its own that may lie in any archive file, so
no record is large. Records are written by Spark's text writer with the record end of the format
as line separator; a lost executor leaves no half file.

Reading: whole archive files of bounded size are cut into records. Segments are grouped by the
identifier of their origin, ordered by number, joined, and held against the total length the last
one states; then the framing is decoded and the payload held against its digest. Pages are taken
together by origin only, so a group is the segments of one row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.operators.joins import lookup_join
from wardstar.session import fresh_path, stage

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

SEGMENT = 16 << 10
CHUNK = 4 << 10
FILE_RECORDS = 4000
MIN_REVISIT = 0


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("no chunk size")
        length = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not length:
            return b"".join(parts)
        if body[at + length : at + length + 2] != b"\r\n":
            raise ValueError("chunk of another length")
        parts.append(body[at : at + length])
        at += length + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its end."""
    lines = [f"{name}: {value}".encode() for name, value in headers if value is not None]
    return b"\r\n".join([VERSION, *lines, b"Content-Length: %d" % len(block), b"", b""]) + block


def clean_uri(url: str | None) -> str | None:
    """``url`` on one line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]+", "%20", url)


def _urn(page: int, row: str = "0") -> str:
    """The identifier of a record: ``row`` tells rows of one page apart."""
    return f"urn:page:{page}:{row}"


def response_records(page: int, url: str | None, payload: bytes, segment: int = SEGMENT, row: str = "0") -> list[bytes]:
    """The records of one page row: one, or a first segment and its continuations."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    several = len(pieces) > 1
    first: list[tuple[str, object]] = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", f"<{_urn(page, row)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", clean_uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Segment-Number", 1 if several else None),
    ]
    out = [record(first, pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        headers: list[tuple[str, object]] = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<{_urn(page, row)}:{number}>"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", f"<{_urn(page, row)}>"),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None),
        ]
        out.append(record(headers, piece))
    return out


def revisit_record(page: int, url: str | None, digest: str, refers_to: int, row: str = "0") -> bytes:
    """A record without payload; it refers to the response of that digest of page ``refers_to``."""
    return record(
        [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", f"<{_urn(page, row)}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", clean_uri(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", PROFILE),
        ],
        b"",
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive file."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:head].decode().split("\r\n")[1:]
        headers = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
        start = head + 4
        stop = start + int(headers["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has another length")
        yield headers, data[start:stop]
        at = stop + 4


def reassembled(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of one origin from its (number, total length or None, block), in any order.

    A repeated segment counts once. Raises ValueError if one is missing or the total is another.
    """
    found = {number: (total, block) for number, total, block in segments}
    if sorted(found) != list(range(1, len(found) + 1)):
        raise ValueError("a segment is missing")
    block = b"".join(found[n][1] for n in sorted(found))
    total = found[len(found)][0]
    if total is None if len(found) > 1 else False:
        raise ValueError("the last segment is missing")
    if total is not None and total != len(block):
        raise ValueError("segments have another total length")
    return block


def payload_of(block: bytes) -> bytes:
    """The decoded payload of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"\r\ntransfer-encoding:[ \t]*chunked[ \t]*(\r\n|$)", head, re.I):
        return unchunked(body)
    return body


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a task's records are kept or lost together, so these numbers tell all rows apart
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        out: list[bytes] = []
        for page, url, html, refers, digest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            row, number = f"{part}.{number}", number + 1
            if refers is None:
                out += response_records(page, url, (html or "").encode("utf-8", "surrogatepass"), row=row)
            else:
                out.append(revisit_record(page, url, digest, refers, row))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


@F.pandas_udf(T.StringType())
def _digests(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: digest_of((t or "").encode("utf-8", "surrogatepass")))


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = MIN_REVISIT
) -> None:
    """Write one WARC record per row of ``pages`` (more where it is segmented) below ``folder``.

    The payload is the html in UTF-8; null is empty. Of rows with equal payloads of at least
    ``least`` bytes the one with the smallest page id is the response. Every row gives a record of
    its own, however many share a page id: rows that repeat the response's page and payload are
    responses too. Rows without an id are left out. A table without rows gives no records.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{html}`").alias("html"),
    ).filter("page is not null")
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint")
    known = rows.select("page", F.xxhash64("html").alias("content"), _digests("html").alias("digest"), size.alias("size"))
    known = stage(known, "warc-digests")
    same = known.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    firsts = stage(same.filter("first <> last").select("digest", "first"), "warc-firsts")
    copies = lookup_join(known, firsts, "digest", "inner", spread=["page"])
    # a page may have rows of several payloads: its revisits are told apart by a hash of the content
    again = copies.filter("page <> first").select("page", "content", F.col("first").alias("refers"), "digest").distinct()
    hashed = rows.withColumn("content", F.xxhash64("html"))
    told = lookup_join(hashed, stage(again, "warc-again"), ["page", "content"], "left", spread=["page"])
    # a revisit carries no payload
    once = told.select(
        "page", "url", F.when(F.col("refers").isNull(), F.col("html")).alias("html"), "refers", "digest"
    )
    (
        once.mapInArrow(_records, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(folder)
    )


RECORD_SCHEMA = "origin string, page bigint, kind string, number int, total bigint, digest string, refers bigint, block binary"


def _page_of(urn: str | None) -> int | None:
    return int(urn.strip("<>").split(":")[2]) if urn else None


def _parse(segmented: bool):
    """The records of whole files: those that are segments, or those that are not."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def rows(data: bytes) -> Iterator[tuple]:
        for headers, block in parse_records(data):
            if ("warc-segment-number" in headers) == segmented:
                total = headers.get("warc-segment-total-length")
                origin = headers.get("warc-segment-origin-id") or headers["warc-record-id"]
                yield (
                    origin,
                    _page_of(origin),
                    headers["warc-type"],
                    int(headers.get("warc-segment-number", 1)),
                    int(total) if total else None,
                    headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    _page_of(headers.get("warc-refers-to")),
                    block,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = list(rows(content.as_py()))
                if found:
                    columns = zip(zip(*found, strict=True), types, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return run


READ_TYPE = T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("problem", T.StringType())])


@F.pandas_udf(READ_TYPE)
def _decoded(segments: pd.Series, digest: pd.Series) -> pd.DataFrame:
    out = []
    for parts, wanted in zip(segments, digest, strict=True):
        try:
            total = lambda p: None if pd.isna(p["total"]) else int(p["total"])
            payload = payload_of(reassembled([(p["number"], total(p), bytes(p["block"])) for p in parts]))
            if digest_of(payload) != wanted:
                raise ValueError("payload has another digest")
            out.append((payload, None))
        except ValueError as error:
            out.append((None, str(error)))
    return pd.DataFrame(out, columns=["payload", "problem"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page of the archives: page_id, record_type, payload, payload_digest, refers_to, problem.

    A revisit has no payload of its own. Every record that is no continuation gives a row, also
    where several have one page. A page whose segments are incomplete, or whose framing,
    length or digest is wrong, has a null payload and the problem in words.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("content")
    part = F.struct("number", "total", "block")
    columns = ["page", "kind", "digest", "refers", "parts"]
    # only segments need the other records of their origin
    whole = files.mapInArrow(_parse(False), RECORD_SCHEMA).withColumn("parts", F.array(part)).select(*columns)
    segments = files.mapInArrow(_parse(True), RECORD_SCHEMA)
    joined = segments.groupBy("origin").agg(
        F.max("page").alias("page"),
        F.max(F.when(F.col("kind") != "continuation", F.col("kind"))).alias("kind"),
        F.max("digest").alias("digest"),
        F.max("refers").alias("refers"),
        F.collect_list(part).alias("parts"),
    )
    pages = whole.unionByName(joined.select(*columns))
    read = pages.withColumn("got", F.when(F.col("refers").isNull(), _decoded("parts", "digest")))
    return read.select(
        F.col("page").alias("page_id"),
        F.col("kind").alias("record_type"),
        "got.payload",
        F.col("digest").alias("payload_digest"),
        F.col("refers").alias("refers_to"),
        "got.problem",
    )


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to and problem; a
    revisit has the length of the payload that it refers to.
    """
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write_archives(pages, folder, page_id, url, html)
    read = read_archives(spark, folder)
    narrow = stage(
        read.select("page_id", F.octet_length("payload").cast("bigint").alias("bytes"), "payload_digest", "record_type", "refers_to", "problem"),
        "warc-pages",
    )
    asked = narrow.filter("refers_to is not null").select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    sizes = narrow.filter("refers_to is null").join(asked, ["page_id", "payload_digest"], "left_semi")
    sizes = sizes.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("bytes").alias("of_first"))
    return lookup_join(narrow, sizes, ["refers_to", "payload_digest"], "left", spread=["page_id"]).select(
        "page_id", F.coalesce("bytes", "of_first").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "problem"
    )

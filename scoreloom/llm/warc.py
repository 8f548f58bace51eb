"""WARC transactions: write captures as records, read archives, join each transaction.

A capture is written as a ``response`` (or ``revisit``) record, a ``request`` record and a ``metadata``
record; the latter two name the first in ``WARC-Concurrent-To``. Spark's text writer writes the
archives (a record ends with an empty line pair, which is the writer's line separator), and its
binary reader reads them, so that any file system that Spark knows will do.

Archives of other writers are read as well: with one gzip member a record or one a file, or not compressed; with
header names in any case, blanks or none after the colon, and values over several lines. What cannot be read
becomes a row of its own that says why.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.sources.shared import fresh_path, publish

END = "\r\n\r\n"
HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to array<string>, refers_to_uri string, uri string, "
    "payload_digest string, payload_bytes long, payload string, fields map<string,string>, problem string"
)
DAMAGED = "damaged"  # the type of a row that stands for what could not be read
CAPTURES_PER_FILE = 20_000
BESIDE = 100  # records of a kind that a capture's row holds; side_records has all
PIECE = 1 << 16  # bytes that are decompressed at a time


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: five hex digits at a time are four base-32 digits."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id]
    for name, value in headers:
        # a header without a value is left out; line ends in a value would end the header
        clean = F.regexp_replace(value, r"[\r\n]+", " ")
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), clean), F.lit("")))
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("\r\nContent-Length: "), length, F.lit(END), block)


def write_archives(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    captured: str = "2024-01-01T00:00:00Z",
    captures_per_file: int = CAPTURES_PER_FILE,
) -> None:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as gzipped WARC files below ``path``.

    Among pages whose payloads are equal and have at least ``min_revisit_bytes`` bytes, the one with
    the smallest ``page_id`` is written as response and the others as revisits of it; smaller
    payloads are all responses. A revisit names the payload's digest and the address of the page
    that it refers to (profile identical-payload-digest). Rows that repeat the smallest ``page_id``
    are all responses. Record ids are new in each run, so archives of several runs may be read together. A file
    holds ``captures_per_file`` captures at most; readers hold one compressed file, so the number should shrink
    where pages are large.

    Only ids and digests are grouped. The page texts meet the digests in one join, whose
    repeated side holds the repeated digests only.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    # the place in the scan tells equal rows apart; it is used in this one write only
    rows = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        base32_sha1(payload.cast("binary")).alias("digest"),
        F.monotonically_increasing_id().alias("capture"),
    )
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    firsts = (
        rows.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    joined = rows.join(publish(firsts, "warc-firsts"), F.col("digest") == F.col("_digest"), "left")

    run = uuid.uuid4().hex

    def record_id(kind: str, capture: Column) -> Column:
        name = F.md5(F.concat(F.lit(f"{run} {kind} "), capture.cast("string")))
        parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    main_id = record_id("response", F.col("capture"))
    about = [
        ("WARC-Date", F.lit(captured)),
        ("WARC-Target-URI", F.col("url")),
    ]
    digest = [("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))]
    refers = [
        ("WARC-Profile", F.lit(REVISIT_PROFILE)),
        ("WARC-Refers-To-Target-URI", F.col("first.url")),
    ]
    beside = [("WARC-Concurrent-To", main_id)]
    request = F.concat(F.lit("GET "), F.coalesce("url", F.lit("")), F.lit(" HTTP/1.1\r\n\r\n"))
    page = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    is_revisit = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    records = F.array(
        F.when(is_revisit, _record("revisit", main_id, [*about, *digest, *refers], http)).otherwise(
            _record("response", main_id, [*about, *digest], F.concat(http, F.col("payload")))
        ),
        _record("request", record_id("request", F.col("capture")), [*about, *beside], request),
        _record("metadata", record_id("metadata", F.col("capture")), [*about, *beside], page),
    )
    (
        joined.select(F.explode(records).alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * captures_per_file)
        .text(path)
    )


def _plain_pieces(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive, piece by piece: of all its gzip members, or as they are where it is not compressed."""
    at, end = 0, len(content)
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + PIECE] for i in range(0, end, PIECE))
        return
    while at < end:
        member = zlib.decompressobj(wbits=31)
        while not member.eof and at < end:
            fed = content[at : at + PIECE]
            at += len(fed)
            while True:
                piece = member.decompress(fed, 16 * PIECE)
                if piece:
                    yield piece
                fed = member.unconsumed_tail
                if member.eof or not fed:
                    break
            at -= len(member.unused_data)
        if not member.eof:
            raise zlib.error("the last gzip member is cut off")
        while at < end and content[at] == 0:  # padding
            at += 1


class _Source:
    """Lines and blocks of a stream of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces = pieces
        self.held = b""
        self.at = 0

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held, self.at = self.held[self.at :] + piece, 0
        return bool(piece)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end."""
        start = self.at
        while (found := self.held.find(b"\n", start)) < 0:
            known = len(self.held) - self.at
            if not self._more():
                rest, self.at = self.held[self.at :], len(self.held)
                return rest.rstrip(b"\r") if rest else None
            start = known
        line, self.at = self.held[self.at : found], found + 1
        return line.rstrip(b"\r")

    def block(self, size: int) -> bytes:
        """The next bytes; fewer at the end."""
        parts, missing = [], size
        while missing:
            part = self.held[self.at : self.at + missing]
            self.at += len(part)
            parts.append(part)
            missing -= len(part)
            if missing and not self._more():
                break
        return b"".join(parts)


def _headers(lines: Iterator[bytes]) -> dict[str, list[str]]:
    """Values by lower-case name, in order; a line that begins with a blank continues the value before."""
    found: dict[str, list[str]] = {}
    last = None
    for raw in lines:
        line = raw.decode(errors="replace")
        if line[:1] in (" ", "\t") and last is not None:
            last[-1] = f"{last[-1]} {line.strip()}".strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = found.setdefault(name.strip().lower(), [])
            last.append(value.strip())
    return found


def _damaged(problem: str, record_id: str | None = None) -> tuple:
    return (DAMAGED, record_id, None, None, None, None, None, None, None, problem)


def _records(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """The records of one archive, cut at their Content-Length. After damage reading goes on at the next line that
    begins a record."""
    source = _Source(pieces)
    lost = False
    try:
        while (line := source.line()) is not None:
            if not line.startswith(b"WARC/"):
                if line.strip() and not lost:
                    lost = True
                    yield _damaged(f"no record begins at {line[:40]!r}")
                continue
            lost = False
            head = _headers(iter(lambda: source.line() or b"", b""))
            name = head.get("warc-record-id", [None])[0]
            length = head.get("content-length", [""])[0]
            if not length.isdecimal():
                yield _damaged("no Content-Length", name)
                continue
            block = source.block(int(length))
            if len(block) < int(length):
                yield _damaged(f"cut off after {len(block)} of {length} bytes", name)
            else:
                yield _record_row(head, name, block)
    except zlib.error as problem:
        yield _damaged(f"gzip: {problem}")


def _record_row(head: dict[str, list[str]], name: str | None, block: bytes) -> tuple:
    kind = head.get("warc-type", [""])[0].lower()
    digest = size = payload = None
    fields: dict[str, str] = {}
    stated = head.get("warc-payload-digest", [""])[0]
    sha1 = stated[5:].upper() if stated[:5].lower() == "sha1:" else None
    if kind == "response":
        body = block.partition(b"\r\n\r\n")[2]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if sha1 not in (None, digest):
            return _damaged(f"the payload's digest is {digest}, not {sha1}", name)
        size, payload = len(body), body.decode(errors="replace")
    elif kind == "revisit":
        digest = sha1
    elif kind == "metadata":
        fields = {key: values[0] for key, values in _headers(iter(block.splitlines())).items()}
    return (
        kind, name, head.get("warc-concurrent-to"), head.get("warc-refers-to-target-uri", [None])[0],
        head.get("warc-target-uri", [None])[0], digest, size, payload, fields, None,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; payload digests in SHA-1 are checked.

    What cannot be read is a row of type ``damaged`` with its ``problem``. A task holds one compressed file and one
    record at a time. ``payload`` is null without ``with_payload``; bytes that are not UTF-8 are replaced in it, not in
    its digest and size.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for row in _records(_plain_pieces(content)):
                    if not with_payload:
                        row = (*row[:7], None, *row[8:])
                    rows.append(row)
                    held += len(row[7] or "") + 200
                    if held > 4 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select("content").mapInPandas(parse, RECORD)


def side_records(records: DataFrame) -> DataFrame:
    """Every request and metadata record with the capture it names, once for each that it names: ``capture_id``, ``type``,
    ``record_id``, ``fields``."""
    beside = records.where("type IN ('request', 'metadata')")
    return beside.select(F.explode("concurrent_to").alias("capture_id"), "type", "record_id", "fields")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id``, ``uri``, ``main``, ``requests``, ``n_requests``, ``metadata``, ``n_metadata``, ``original``.

    ``main`` is the response or revisit. Requests and metadata records join it through ``concurrent_to``, as arrays
    in the order of their ids; they are empty where a capture has none, and hold the first ``BESIDE`` where it has more (the
    numbers count all, ``side_records`` lists all). ``original`` holds, for any capture, ``payload_bytes`` and
    ``page_id`` of the first response with the same payload digest. Damaged rows and other types are left out.
    """
    main = records.where("type in ('response', 'revisit')").select(
        "record_id",
        "uri",
        F.struct("type", "refers_to_uri", "payload_digest", "payload_bytes", "payload").alias("main"),
    )
    beside = side_records(records)
    place = F.row_number().over(Window.partitionBy("capture_id", "type").orderBy("record_id"))
    counts = beside.groupBy(F.col("capture_id").alias("record_id")).agg(
        F.count_if(F.col("type") == "request").alias("n_requests"),
        F.count_if(F.col("type") == "metadata").alias("n_metadata"),
    )

    def in_order(kind: str) -> Column:
        row = F.when(F.col("type") == kind, F.struct("place", "record_id", "fields"))
        sorted_rows = F.array_sort(F.collect_list(row), lambda a, b: a["place"] - b["place"])
        return F.transform(sorted_rows, lambda r: F.struct(r["record_id"].alias("record_id"), r["fields"].alias("fields")))

    first = beside.withColumn("place", place).where(F.col("place") <= BESIDE)
    arrays = first.groupBy("capture_id").agg(in_order("request").alias("requests"), in_order("metadata").alias("metadata"))
    arrays = arrays.withColumnRenamed("capture_id", "record_id")
    none = F.array().cast("array<struct<record_id:string,fields:map<string,string>>>")
    captures = (
        main.join(counts, "record_id", "left")
        .join(arrays, "record_id", "left")
        .select(
            "record_id",
            "uri",
            "main",
            F.coalesce("requests", none).alias("requests"),
            F.coalesce("n_requests", F.lit(0)).alias("n_requests"),
            F.coalesce("metadata", none).alias("metadata"),
            F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"),
        )
    )
    originals = (
        captures.where("main.type = 'response'")
        .groupBy(F.col("main.payload_digest").alias("_digest"))
        .agg(
            F.max("main.payload_bytes").alias("payload_bytes"),
            F.min(page_id()).alias("page_id"),
        )
        .select("_digest", F.struct("payload_bytes", "page_id").alias("original"))
    )
    return captures.join(originals, F.col("main.payload_digest") == F.col("_digest"), "left").drop(
        "_digest"
    )


def page_id() -> Column:
    """The page id in a capture's first metadata record that has one."""
    ids = F.transform("metadata", lambda r: F.try_element_at(r["fields"], F.lit("page-id")))
    return F.get(F.filter(ids, lambda i: i.isNotNull()), F.lit(0)).try_cast("long")


def capture_digests(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back and describe each capture.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. A null
    html is an empty payload; a null url leaves the header out; a row with a null ``page_id`` is
    written and returned with null, after all others when the first of equal payloads is
    chosen. Repeated rows are captures of their own. No rows give no rows. Further columns are
    ignored. Rows that repeat the ``page_id`` of a response are responses, too.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, min_revisit_bytes)
    records = publish(read_records(spark, path, with_payload=False), "warc-records")
    bytes_of = F.coalesce(F.col("main.payload_bytes"), F.col("original.payload_bytes"))
    return assemble(records).select(
        page_id().alias("page_id"),
        bytes_of.alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        F.when(F.col("main.type") == "revisit", F.col("original.page_id")).alias("refers_to"),
    )

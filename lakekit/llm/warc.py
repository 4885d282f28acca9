"""Web archives: records with deduplicated payloads, and a salvage reader that gets past damaged bytes.

A record is a version line, header lines, an empty line, a block of Content-Length bytes and two line ends. Records may
stand plain one after the other, or one or many in a gzip member. After a failed check the reader searches for the
next gzip member or version line that begins a valid record, and logs the bytes between as a gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import slices, utf8

VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
MIN_DUPLICATE_BYTES = 100
RECORDS_PER_FILE = 2_000
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
_HEADER = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r\n")


@dataclass(frozen=True)
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes


@dataclass(frozen=True)
class Gap:
    start: int
    end: int
    reason: str


class Damaged(ValueError):
    pass


def parse_record(data: bytes, start: int) -> Record:
    """The record that begins at `start`; raises Damaged if any check fails."""
    if data[start : start + len(VERSION)] != VERSION:
        raise Damaged("no version line")
    at = start + len(VERSION)
    headers: dict[str, str] = {}
    while data[at : at + 2] != b"\r\n":
        m = _HEADER.match(data, at)
        if not m:
            raise Damaged("bad header line")
        headers[m[1].decode("ascii").lower()] = m[2].decode("utf-8", "replace").rstrip()
        at = m.end()
    at += 2
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damaged("bad content length")
    end = at + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block does not end in two line ends")
    block = data[at:end]
    claimed = headers.get("warc-block-digest")
    if claimed and claimed != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise Damaged("block digest differs")
    return Record(start, end + 4, headers, block)


def open_member(data: bytes, start: int) -> tuple[bytes, int, str]:
    """(what the gzip member at `start` holds, its end, what is wrong with it if anything)."""
    reader, at, pieces, wrong = zlib.decompressobj(31), start, [], ""
    try:
        while at < len(data) and not reader.eof:
            pieces.append(reader.decompress(data[at : at + CHUNK]))
            at += CHUNK
    except zlib.error as error:
        wrong = f"bad gzip member: {error}"
    if not wrong and not reader.eof:
        wrong = "gzip member without an end"
    return b"".join(pieces), min(at, len(data)) - len(reader.unused_data), wrong


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All valid records of an archive in order, and the byte ranges in between that hold none.

    A gzip member may hold one record or many; they all have the member's range, the first one starting it. Of a damaged
    member, the records before the damage come back if their own digests hold; their range is empty, the member a gap.
    """
    at = lost = 0
    reason = ""
    marks = re.compile(re.escape(VERSION) + b"|" + re.escape(GZIP))
    while at < len(data):
        found: list[Record] = []
        try:
            if data.startswith(GZIP, at):
                plain, end, wrong = open_member(data, at)
                inner = [x for x in salvage(plain) if isinstance(x, Record)]
                if wrong:
                    found = [Record(lost, lost, x.headers, x.block) for x in inner if "warc-block-digest" in x.headers]
                    raise Damaged(wrong)
                if not plain and lost == at:
                    at = lost = end  # an empty archive
                    continue
                if not inner:
                    raise Damaged("gzip member without a record")
                found = [Record(at if i == 0 else end, end, x.headers, x.block) for i, x in enumerate(inner)]
            else:
                found = [parse_record(data, at)]
        except Damaged as error:
            yield from found
            reason = reason or str(error)
            following = marks.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost < at:
            yield Gap(lost, at, reason)
        yield from found
        at = lost = found[-1].end
        reason = ""
    if lost < len(data):
        yield Gap(lost, len(data), reason)


def with_duplicates(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = MIN_DUPLICATE_BYTES
) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to): refers_to is the smallest id with the same long payload.

    Smallest ids come from an aggregation; the join splits payloads that many pages have. NULL ids come after all
    others, and of rows with the smallest id all are responses.
    """
    payload = F.coalesce(pages[payload_col], F.lit(""))
    rows = pages.select(
        pages[id_col].alias("page_id"),
        pages[url_col].alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    long = rows.where(F.col("bytes") >= min_bytes)
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    linked = rows.join(firsts.select("digest", "first"), "digest", "left")
    refers = F.when((F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return linked.withColumn("refers_to", refers).drop("first")


def record_text(digest: Column) -> Column:
    """A record, from the columns of with_duplicates. A revisit has an empty block."""
    revisit = F.col("refers_to").isNotNull()
    clean_url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    def urn(key: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))

    absent = F.lit("")
    return F.concat(
        F.lit(VERSION.decode()),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("page_id").isNotNull(), line("WARC-Record-ID", urn(F.col("page_id")))).otherwise(absent),
        line("WARC-Target-URI", clean_url),
        line("WARC-Date", DATE),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, absent).otherwise(line("WARC-Block-Digest", F.concat(F.lit("sha256:"), digest))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")).otherwise(absent),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(absent),
        line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, absent).otherwise(F.col("payload")),
        F.lit("\r\n\r\n"),
    )


def gzip_member(record: bytes) -> bytes:
    """The record as a gzip member without its last byte, which is 0.

    It is the highest byte of the record's length. Records of 16 MB and more are followed by an empty member.
    """
    data = b""
    for part in (record, b""):
        packer = zlib.compressobj(wbits=31)
        data += packer.compress(part) + packer.flush()
        if data.endswith(b"\0"):
            break
    return data[:-1]


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_DUPLICATE_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Archives of one record per page, each a gzip member, by Spark's text writer, so any file system of Spark will do.

    NULL payloads are empty, NULL ids have no record id, line ends inside a url are left out. An empty table gives no
    records. Other columns don't matter.
    """
    rows = with_duplicates(pages, id_col, url_col, payload_col, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "value"):
            yield pa.RecordBatch.from_arrays([pa.array(map(gzip_member, utf8(batch, "value")), pa.binary())], ["value"])

    members = rows.select(record_text(F.col("digest")).alias("value")).mapInArrow(run, "value binary")
    # The writer ends each line, and so each member, with the zero byte; a cast to text leaves bytes as they are.
    writer = members.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none")
    writer.option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path)


READ_SCHEMA = (
    "file string, kind string, start long, end long, reason string, type string, record_id string, url string, "
    "payload_digest string, payload_bytes long, refers_to string, intact boolean, payload binary"
)
_URN = re.compile("<urn:page:(.*)>")


def read_archives(spark, path: str) -> DataFrame:
    """Every record and every gap of the archives in a folder, with its byte range; a file is read by one task.

    Records: type, record id, url, digest and length of the full payload, the id a revisit refers to, the payload itself
    (NULL for revisits), and whether a response's payload has the digest and length its header claims. Digest and length
    are computed from the payload for responses and taken from the header for revisits. Gaps: the first failed check.
    """

    def rows(name: str, data: bytes) -> Iterator[tuple]:
        for part in salvage(data):
            if isinstance(part, Gap):
                yield name, "gap", part.start, part.end, part.reason, *[None] * 8
                continue
            h = part.headers
            kind = h.get("warc-type")
            claimed = (h.get("warc-payload-digest") or "").removeprefix("sha256:")
            length = h.get("warc-payload-length", "")
            size = int(length) if length.isdigit() else None
            ids = [m[1] if (m := _URN.fullmatch(h.get(k, ""))) else None for k in ("warc-record-id", "warc-refers-to")]
            if kind == "revisit":
                found = (claimed or None, size, ids[1], None, None)
            else:
                digest = hashlib.sha256(part.block).hexdigest()
                intact = digest == claimed and size in (None, len(part.block))
                found = (digest, len(part.block), None, intact, part.block)
            yield name, "record", part.start, part.end, None, kind, ids[0], h.get("warc-target-uri"), *found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
                held, size = [], 0
                for row in rows(name, data):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size > 4 << 20 or len(held) >= 10_000:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, READ_SCHEMA)


_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.bool_(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names)


def oracle(pages: str = "pages") -> str:
    return f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
            sha256(coalesce(html, '')) AS payload_digest FROM {pages}),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
        r AS (SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL AS again FROM f)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first END AS refers_to FROM r"""

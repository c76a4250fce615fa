"""WARC archives: writing with revisits and segments, reading with segment reassembly.

Writing.  One record per page; its block is an HTTP response whose body is
chunked.  Among pages with equal payloads of ``REVISIT_BYTES`` or more the one
with the largest page_id becomes a response and the others revisit it.  A block
over the segment size is cut: the first part keeps the record's type, the rest
are continuation records that name their origin and segment number, the last of
them also the total length.  Archives are gzip files of records, written by
Spark's text writer with a record's closing line ends as the line separator, so
they land wherever the path's file system is and are committed like any output.

Reading.  Archives are parsed one file at a time, continuation records are
grouped by origin identifier and ordered by segment number, the total length is
verified, the chunked framing decoded and the payload's digest checked.  Files
are small (``RECORDS_PER_FILE``) and a group holds one record's segments, so
memory is bounded by a page.

Defined results: a null html is an empty payload; a null url is written as an
empty target; a null page_id stays null and is never referred to.  Rows that
share page_id and payload all keep the type that their page_id gives.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.runtime import materialize

REVISIT_BYTES = 1000
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 2000
_END = b"\r\n"
_DATE = "2024-01-01T00:00:00Z"


class ArchiveError(ValueError):
    """An archive breaks the format: a bad length, a missing segment or a wrong digest."""


# -- framing -----------------------------------------------------------------
def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in HTTP chunked transfer framing."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += [b"%x\r\n" % len(part), part, _END]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        eol = body.find(_END, at)
        if eol < 0:
            raise ArchiveError("chunk size line is cut off")
        try:
            size = int(body[at:eol].split(b";")[0], 16)
        except ValueError as e:
            raise ArchiveError("bad chunk size") from e
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != _END:
            raise ArchiveError("chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The decoded payload of an HTTP response block."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ArchiveError("no end of the HTTP headers")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _one_line(url: str | None) -> str:
    return " ".join((url or "").split())


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page, each without the two line ends that close it."""
    revisit = refers_to is not None
    shared = uuid.uuid5(uuid.NAMESPACE_URL, f"payload:{digest}")
    own = shared if not revisit and len(payload) >= REVISIT_BYTES and page_id is not None else uuid.uuid4()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
    block += b"\r\n" if revisit else b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    common = [("WARC-Target-URI", _one_line(url)), ("WARC-Date", _DATE)]
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", page_id)]
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:uuid:{shared}>"), ("X-Refers-To-Page-ID", refers_to)]
    if len(parts) > 1:
        headers.append(("WARC-Segment-Number", 1))
    yield _record([*headers, ("Content-Type", "application/http; msgtype=response")], parts[0])
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *common, ("WARC-Segment-Origin-ID", f"<urn:uuid:{own}>"), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an archive, gzip members or plain."""
    while archive[:2] == b"\x1f\x8b":
        plain = []
        while archive:
            d = zlib.decompressobj(31)
            plain.append(d.decompress(archive))
            archive = d.unused_data
        archive = b"".join(plain)
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise ArchiveError("no record where one should start")
        lines = archive[at:end].decode("utf-8").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        start = end + 4
        if archive[start + size : start + size + 4] != b"\r\n\r\n":
            raise ArchiveError("a record's length is wrong")
        yield headers, archive[start : start + size]
        at = start + size + 4


# -- Spark -------------------------------------------------------------------
def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the archives of ``pages`` (page_id, url, html) to a new folder."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("n"))
    # Which payloads occur twice: one row each, and only those, so what a page is joined with is small.
    again = materialize(
        keyed.where((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first_id"),
        "warc-again",
    )
    again = again.withColumnRenamed("digest", "again_digest")
    marked = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).join(again, F.col("digest") == F.col("again_digest"), "left").select("page_id", "url", "html", "digest", F.when((F.octet_length("html") >= REVISIT_BYTES) & (F.col("page_id") < F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                out = [x for row in zip(*(c.to_pylist() for c in part.columns)) for x in records_of(row[0], row[1], row[2].encode("utf-8", "surrogatepass"), row[3], row[4], segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = marked.mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("record")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_PARSED = "kind string, record_id string, page_id bigint, url string, digest string, refers_record string, refers_to bigint, origin string, segment int, total bigint, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in a folder, segments apart."""
    kinds = pa.schema([("kind", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("refers_record", pa.string()), ("refers_to", pa.int64()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows: list[tuple] = []
                for h, block in parse(archive.as_py()):
                    rows.append((h["warc-type"], h["warc-record-id"], number(h.get("x-page-id")), h.get("warc-target-uri"), (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None, h.get("warc-refers-to"), number(h.get("x-refers-to-page-id")), h.get("warc-segment-origin-id"), number(h.get("warc-segment-number")), number(h.get("warc-segment-total-length")), block))
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, _PARSED)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with whole blocks: continuation records grouped by origin, ordered, and their total length verified.

    A missing or repeated segment or a wrong total raises ArchiveError's message in the query.
    """
    heads = records.where("kind <> 'continuation'")
    whole = heads.where("segment is null")
    first = heads.where("segment is not null")
    rest = (
        records.where("kind = 'continuation'")
        .groupBy(F.col("origin").alias("of"))
        .agg(F.array_sort(F.collect_set(F.struct("segment", "total", "block"))).alias("parts"))
    )
    joined = first.join(rest, F.col("record_id") == F.col("of"), "left")
    numbers = F.transform("parts", lambda p: p["segment"])
    body = F.aggregate("parts", F.col("block"), lambda acc, p: F.concat(acc, p["block"]))
    total = F.element_at("parts", -1)["total"]
    sound = F.coalesce((numbers == F.sequence(F.lit(2), F.size("parts") + 1)) & (total == F.octet_length("body")), F.lit(False))
    checked = F.when(sound, F.col("body")).otherwise(F.raise_error(F.concat(F.lit("segments of "), F.col("record_id"), F.lit(" are missing or their total length is wrong"))).cast("binary"))
    built = joined.withColumn("body", body).withColumn("block", checked).select(*records.columns)
    return whole.unionByName(built)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages read back: page_id, url, payload_bytes, payload_digest, record_type, refers_to (see the module's docstring)."""
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_record", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, record_id, page_id, url, digest, refers_record, refers_to, block in zip(*(c.to_pylist() for c in batch.columns)):
                size = None
                if kind == "response":
                    payload = http_payload(block)
                    size, found = len(payload), hashlib.sha1(payload).hexdigest()
                    if digest and digest != found:
                        raise ArchiveError(f"the payload of {record_id} has another digest")
                    digest = found
                rows.append((page_id, url, record_id, kind, size, digest, refers_record, refers_to))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(out), out)], schema=out)

    whole = reassembled(read_records(spark, path)).select("kind", "record_id", "page_id", "url", "digest", "refers_record", "refers_to", "block")
    pages = whole.mapInArrow(run, "page_id bigint, url string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_record string, refers_to bigint")
    pages = materialize(pages, "warc-pages")
    # A revisit has no payload of its own: its length comes from the response that it names.
    named = materialize(pages.where("record_type = 'revisit'").select(F.col("refers_record").alias("named")).distinct(), "warc-named")
    origins = materialize(pages.where("record_type = 'response'").join(named, F.col("record_id") == F.col("named"), "left_semi").groupBy("record_id").agg(F.max("payload_bytes").alias("n"), F.max("payload_digest").alias("d")).select(F.col("record_id").alias("origin_id"), "n", "d"), "warc-origins")
    revisits = pages.where("record_type = 'revisit'").join(origins, (F.col("refers_record") == F.col("origin_id")) & (F.col("payload_digest") == F.col("d")), "left")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pages.where("record_type = 'response'").select(*columns).unionByName(revisits.select("page_id", "url", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))

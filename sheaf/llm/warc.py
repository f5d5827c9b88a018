"""WARC archives: writing captures, and assembling them again from their records.

Writing. A capture becomes three records: a ``request``, a ``response`` (or a
``revisit`` where an earlier page has the same payload) and ``metadata``; the
request and the metadata name the response as concurrent. All three are written by
one task into one archive. Spark's text writer puts the record separator of the
format (two line ends) behind every record, so the archives go to any file system
that Spark can write, through its commit protocol, and a lost executor leaves no
half archive behind.

Reading. Archives are gzip files, so each is read by one task from its start, as a
stream of pieces between separators; a record is joined from as many pieces as its
Content-Length asks for, so payloads may hold the separator, or whole records. No
archive is held in memory.

Assembly. Records are joined through their concurrent-to identifiers into one nested
row per capture; a revisit finds its payload through the record it refers to. All
records of a capture stand in one archive, so the archive is part of the join key and
identifiers that occur in several archives cannot mix.

Payloads are equal if their SHA-1 digests and lengths are. Of the pages with an equal
payload (of ``MIN_REVISIT`` bytes or more), the one with the smallest id is the
response and the others revisit it; a null id is larger than any other, and pages
that share the smallest id are all responses. Defined cases: a null html is an empty
payload, a null URL an empty target; an empty table gives no captures; repeated rows
are captures of their own.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import table

#: Payloads of fewer bytes are never written as revisits.
MIN_REVISIT = 0
#: What separates records, and what separates a record's header from its block.
SEPARATOR, BLANK = "\r\n\r\n", b"\r\n\r\n"
_VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")      # the name space of URLs (RFC 4122)
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '/'.join(map(str, parts)))}>"


def _clean(value: str | None) -> str:
    """A header value must not hold a line end."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> str:
    head = [_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {_DATE}",
            *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(head) + "\r\n\r\n" + block.decode()


def _captured(page_id, url, html, first_id, serial: str) -> list[str]:
    payload, target = (html or "").encode(), _clean(url)
    digest = _digest(payload)
    original = len(payload) < MIN_REVISIT or first_id == page_id
    # the first capture of a page in a task has the identifier that revisits refer to
    main = _record_id(digest, page_id, serial)
    about = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if original:
        kind, block = "response", http + payload
        about.append(("Content-Type", "application/http; msgtype=response"))
    else:
        kind, block = "revisit", http
        about += [("WARC-Refers-To", _record_id(digest, first_id, "")), ("WARC-Profile", _PROFILE),
                  ("Content-Type", "application/http; msgtype=response")]
    get = "GET /{} HTTP/1.1\r\n\r\n".format(target.split("://", 1)[-1].partition("/")[2]).encode()
    fields = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    concurrent = [("WARC-Concurrent-To", main), ("WARC-Target-URI", target)]
    return [_record("request", _record_id(main, "request"), [*concurrent, ("Content-Type", "application/http; msgtype=request")], get),
            _record(kind, main, about, block),
            _record("metadata", _record_id(main, "metadata"), [*concurrent, ("Content-Type", "application/warc-fields")], fields)]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a capture for every row of ``pages`` (id, url, html) to gzip archives under ``path``."""
    plain = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    key = F.unhex(F.sha1(F.col("html")))
    firsts = plain.groupBy(key.alias("first_key")).agg(F.min("page_id").alias("first_id"))
    joined = plain.withColumn("key", key).join(firsts, F.col("key") == F.col("first_key")).select("page_id", "url", "html", "first_id")

    def run(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            out = []
            for page_id, url, html, first_id in zip(*[c.to_pylist() for c in batch.columns]):
                # pages that repeat an id and a payload are told apart by a serial number
                name = (page_id, hashlib.sha1(html.encode()).digest())
                turn = seen[name] = seen.get(name, -1) + 1
                out += _captured(page_id, url, html, first_id, f"{part}-{turn}" if turn else "")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
    joined.mapInArrow(run, "value string").write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


_RECORD = ("archive string, type string, id string, concurrent string, refers_to string, uri string, digest string, "
           "payload_bytes bigint, found_digest string, page_id bigint")


def _parsed(archive: str, raw: bytes) -> tuple | None:
    head, _, block = raw.partition(BLANK)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    kind, payload = fields["WARC-Type"], block.partition(BLANK)[2]
    page = block.decode().partition("page-id:")[2].strip() if kind == "metadata" else ""
    return (archive, kind, fields["WARC-Record-ID"], fields.get("WARC-Concurrent-To"), fields.get("WARC-Refers-To"),
            fields.get("WARC-Target-URI"), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
            len(payload) if kind == "response" else None, _digest(payload) if kind == "response" else None,
            int(page) if page else None)


def _ended(archive: str | None, held: bytearray) -> None:
    if held.strip():
        raise ValueError(f"{archive} ends within a record")


def _length(head: bytes) -> int:
    return int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n", 1)[0])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def run(batches):
        archive, held, need = None, bytearray(), 0      # bytes not yet assigned to a record; its full length, once known
        for batch in batches:
            out = []
            for file, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != archive:
                    _ended(archive, held)
                    archive, held, need = file, bytearray(), 0
                held += piece.encode() + BLANK
                while held:
                    if not need:
                        head = held.find(BLANK)
                        need = head + 2 * len(BLANK) + _length(bytes(held[:head]))
                    if len(held) < need:
                        break
                    out.append(_parsed(archive, bytes(held[:need - len(BLANK)])))
                    del held[:need]
                    need = 0
                    if not held.strip():
                        break           # a separator that the reader found inside the end of a block
            columns = list(zip(*out)) if out else [()] * len(names)
            kinds = [pa.int64() if n in ("payload_bytes", "page_id") else pa.string() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        _ended(archive, held)
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("_metadata.file_path").alias("archive"), "value")
    return pieces.mapInArrow(run, _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: (page_id, request, response, metadata, payload_bytes, payload_digest, refers_to).

    ``request``, ``response`` and ``metadata`` are structs of the records; the
    response may be a revisit, whose payload is that of the record it refers to,
    and ``refers_to`` is then that record's page.
    """
    part = lambda kind: F.struct(*[F.col(c) for c in ("id", "uri", "archive")]).alias(kind)
    link = ["archive", "concurrent"]
    mains = records.filter(F.col("type").isin("response", "revisit"))
    main = mains.select("archive", F.col("id").alias("concurrent"), F.struct(
        "id", "type", "uri", "digest", "refers_to", "payload_bytes", "found_digest").alias("response"))
    request = records.filter(F.col("type") == "request").select(*link, part("request"))
    meta = records.filter(F.col("type") == "metadata").select(*link, F.struct("id", "page_id").alias("metadata"))
    captures = main.join(request, link, "left").join(meta, link, "left")
    # what revisits refer to: one response per identifier
    origin = (captures.filter(F.col("response.type") == "response").groupBy(F.col("concurrent").alias("origin")).agg(
        F.min("metadata.page_id").alias("origin_page"), F.max("response.payload_bytes").alias("origin_bytes"),
        F.max("response.found_digest").alias("origin_digest")))
    joined = captures.join(origin, F.col("response.refers_to") == F.col("origin"), "left")
    return joined.select(
        F.col("metadata.page_id").alias("page_id"), "request", "response", "metadata",
        F.coalesce("response.payload_bytes", "origin_bytes").alias("payload_bytes"),
        F.coalesce("response.found_digest", "origin_digest").alias("payload_digest"), F.col("origin_page").alias("refers_to"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/tables/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return assemble(read_records(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", F.col("response.type").alias("record_type"), "refers_to")

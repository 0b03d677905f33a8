"""WARC archives: one gzip member for each record, read back as a stream and verified."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.session import scratch_path, stored

CRLF = b"\r\n"
#: payloads below this size are always written whole
LEAST_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
BLOCK = 1 << 16
#: record id of a page without an id; an empty text is an id
NO_PAGE = "<urn:nopage>"


def _open(path: str, mode: str):
    """A plain stream in any store that Arrow knows by its URI; by itself Arrow would pack what is named .gz once more."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    return store.open_output_stream(place, compression=None) if mode == "w" else store.open_input_stream(place, compression=None)


def _folder(spark: SparkSession, path: str) -> str:
    """Makes the folder and returns its address: a path without a scheme belongs to the cluster's default store, not to an executor's disk."""
    from pyarrow import fs

    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    # Arrow takes a plain path for a local one, which it is here
    full = path if full.startswith("file:") else full
    store, inside = fs.FileSystem.from_uri(full)
    store.create_dir(inside, recursive=True)
    return full


def frame(kind: str, record: str | None, url: str, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """One record as its own gzip member: header lines, blank line, block, two line ends."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode() + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Record-ID: " + (NO_PAGE if record is None else f"<urn:page:{record}>"), f"WARC-Target-URI: {url}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + CRLF + CRLF
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + CRLF + CRLF) + packer.flush()


def members(stream, block: int = BLOCK) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as pieces of its content; holds one piece at a time.

    A member must be read to its end before the next one.  Raises on a cut or damaged member.
    """
    rest = stream.read(block)
    while rest:
        state = [zlib.decompressobj(31), rest]

        def pieces() -> Iterator[bytes]:
            unpack, data = state
            while True:
                if out := unpack.decompress(data, block):
                    yield out
                if unpack.eof:
                    state[1] = unpack.unused_data
                    return
                data = unpack.unconsumed_tail or stream.read(block)
                if not data and not out:
                    raise ValueError("the archive ends inside a record")

        yield pieces()
        rest = state[1] or stream.read(block)


def parse(pieces: Iterator[bytes]) -> dict:
    """One record: header fields, the payload and its verified digests.

    The block is as long as Content-Length says; what follows must be the two line ends.
    """
    data = bytearray()
    for piece in pieces:
        data += piece
        if (end := data.find(CRLF + CRLF)) >= 0:
            break
    else:
        raise ValueError("a record without end of header")
    first, *lines = bytes(data[:end]).decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a record: {first[:40]}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    del data[:end + 4]
    for piece in pieces:
        data += piece
    length = int(fields["content-length"])
    if len(data) != length + 4 or data[length:] != CRLF + CRLF:
        raise ValueError(f"record {fields['warc-record-id']}: {len(data)} bytes after the header, {length} announced")
    block = memoryview(data)[:length]
    if fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"record {fields['warc-record-id']}: block digest differs")
    http = bytes(data[:data.find(CRLF + CRLF)]).decode()
    size = int(next(x for x in http.split("\r\n") if x.lower().startswith("content-length: "))[16:])
    payload = bytes(block[len(http.encode()) + 4:])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['warc-record-id']}: payload differs from its length or digest")
    named = lambda x: x.removeprefix("<urn:page:").removesuffix(">") if x and x != NO_PAGE else None
    return {"record": named(fields["warc-record-id"]), "url": fields["warc-target-uri"], "record_type": kind,
            "refers_to": named(fields.get("warc-refers-to")), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Which pages are written whole: ``page_id, url, payload, size, digest, refers_to``.

    Of equal payloads of at least ``least`` bytes the smallest page_id is the response.  First
    pages come from an aggregate that combines before the shuffle; the join back to the pages
    is an ordinary one, which adaptive execution splits where one payload holds many pages.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    first = rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("match")).agg(F.min("page_id").alias("first"))
    # small payloads get a key of their own, so they neither match nor meet in one place
    key = F.when(F.col("size") >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest"))))
    joined = rows.withColumn("match", key).join(first, "match", "left")
    return joined.select("page_id", "url", "payload", "size", "digest",
                         F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the planned records and returns a stored list of archives: ``path, records, bytes``.

    Each task writes archives of its own under new names, and begins another one beyond
    ``archive_bytes``; a repeated task leaves files that no list names.
    """
    folder = _folder(records.sparkSession, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, path, count, size = None, "", 0, 0
        try:
            for batch in batches:
                for page, url, payload, length, digest, refers in batch.itertuples(index=False, name=None):
                    if out is None:
                        path, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = _open(path, "w")
                    whole = refers is None
                    data = frame("response" if whole else "revisit", page, url.replace("\r", "%0D").replace("\n", "%0A"),
                                 bytes(payload) if whole else b"", length, digest, refers)
                    out.write(data)
                    count, size = count + 1, size + len(data)
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        yield pd.DataFrame({"path": [path], "records": [count], "bytes": [size]})
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pd.DataFrame({"path": [path], "records": [count], "bytes": [size]})

    rows = records.select(F.col("page_id").cast("string"), "url", "payload", "size", "digest", F.col("refers_to").cast("string"))
    return stored(rows.mapInPandas(write, "path string, records long, bytes long"), "warc-list")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the listed archives, in order of each archive.

    Each archive is read once, from front to back, a block at a time; a task holds one record.
    Framing, block and payload digests are verified, and the number of records must be the listed one.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["record", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            for path, expected in zip(batch["path"], batch["records"]):
                found, held, seen = [], 0, 0
                with _open(path, "r") as stream:
                    for member in members(stream):
                        record = parse(member)
                        found.append(record)
                        held, seen = held + record["payload_bytes"], seen + 1
                        if held >= 64 * BLOCK or len(found) >= 5000:
                            yield pd.DataFrame(found, columns=columns)
                            found, held = [], 0
                if seen != expected:
                    raise ValueError(f"{path}: {seen} records, {expected} written")
                if found:
                    yield pd.DataFrame(found, columns=columns)

    # a task for each archive; adaptive execution would put all these small rows into one
    spread = archives.select("path", "records").repartition(max(1, archives.count()))
    return spread.mapInPandas(read, "record string, url string, record_type string, refers_to string, payload_bytes long, "
                                    "payload_digest string, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written as archives and read back: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``.

    A null html is an empty payload, a null url an empty address; payloads below 100 bytes are
    always responses.  Rows with one page_id and equal payloads are responses both; a null
    page_id reads back as null.  Line ends in an address are written as %0D and %0A.  Other columns go.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records = read_archives(write_archives(plan_records(pages), folder))
    return records.select(F.col("record").cast(kind).alias("page_id"), "url", "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
                          "payload_bytes", "payload_digest", "payload")


def op4_warc(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH rows AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM rows)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
"""

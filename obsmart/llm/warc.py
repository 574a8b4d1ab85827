"""WARC archives: written with an index, read back by byte ranges.

Writing marks one record of each payload as the response and the others as
revisits of it, puts every record into its own gzip member, and returns the
index: file, offset, length, URL and digest of each record. Reading starts from
the index alone: the wanted records are sorted by file and offset, neighbours
become one read, and each member is parsed on its own.

Only (digest, largest page_id) of payloads that occur more than once is joined
back; equal payloads are combined in each task before they are shuffled, so
a payload on a third of all pages is one row there.

Cases: a null html is an empty payload; a null url is written as ``urn:page:``
and the page_id; rows that repeat a page_id and its payload are the same page
to the rule, so each of them is a response; a null page_id is smaller than any
other; an empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import partition_id, partitions, ship_code, stage, table
from obsmart.session import fresh_dir

#: Bytes after which an archive file is closed.
FILE_BYTES = 64 << 20
#: The longest single read, and the widest gap that a read passes over.
READ_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: The date of all records; a fixed one, so that reruns write the same bytes.
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

INDEX = "path string, offset long, length long, url string, payload_digest string, record_type string, page_id long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page/{page_id}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as its own gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
        head.append(f"Page-Refers-To: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    text = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(text, compresslevel=6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record fields, HTTP fields, payload) of one gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if base32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write archives below ``folder``; returns the index, already stored.

    File names are new in every attempt and only those in the index are read.
    """
    ship_code(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", html.alias("payload"))
    digested = pages.withColumn("sha1", F.unhex(F.sha1("payload")))
    repeated = digested.groupBy("sha1").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stage(repeated.select("sha1", "kept"), "warc-repeated")
    marked = digested.join(repeated, "sha1", "left").select("page_id", "url", "payload", "sha1", "kept")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    marked = marked.withColumn("revisit", revisit)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        out, path, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, sha1, kept, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= file_bytes:
                        if out:
                            out.close()
                        path, at = f"{root}/{partition_id():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(path, compression=None)
                    digest = base64.b32encode(sha1).decode()
                    target = " ".join((url or f"urn:page:{page_id}").split())
                    member = record(page_id, target, payload, digest, kept, again)
                    out.write(member)
                    rows.append((path, at, len(member), url, digest, "revisit" if again else "response", page_id))
                    at += len(member)
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["path", "offset", "length", "url", "payload_digest", "record_type", "page_id"],
                )
        finally:
            if out:
                out.close()

    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root)
    return stage(marked.mapInArrow(put, INDEX), "warc-index")


def read(selected: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to) of the selected index rows; a revisit carries no payload but the
    size and digest of the full one."""
    spark = selected.sparkSession
    ship_code(spark)
    ranges = selected.select("path", "offset", "length", F.floor(F.col("offset") / READ_BYTES).alias("stretch"))
    dealt = ranges.repartition(partitions(spark), "path", "stretch").sortWithinPartitions("path", "offset").drop("stretch")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)

        def fetch(path: str, run: list[tuple[int, int]]) -> pa.RecordBatch:
            first, last = run[0][0], run[-1][0] + run[-1][1]
            with store.open_input_file(path) as f:
                span = f.read_at(last - first, first)
            out: list[tuple] = []
            for offset, length in run:
                fields, http, payload = parse(span[offset - first : offset - first + length])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = fields["WARC-Type"]
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
                page, refers = fields.get("Page-ID"), fields.get("Page-Refers-To")
                out.append(
                    (
                        None if page is None else int(page), fields["WARC-Target-URI"], payload if kind == "response" else None,
                        int(http["Content-Length"]), digest, kind, None if refers is None else int(refers),
                    )
                )
            types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        path, run = "", []
        for batch in batches:
            for p, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                far = run and (
                    p != path or offset - run[-1][0] - run[-1][1] > GAP_BYTES or offset + length - run[0][0] > READ_BYTES
                )
                if far:
                    yield fetch(path, run)
                    run = []
                path = p
                run.append((offset, length))
        if run:
            yield fetch(path, run)

    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return dealt.mapInArrow(get, schema)


def op8_warc_index(spark, folder: str) -> DataFrame:
    """Per page, from the archives: size and digest of its payload, and what it revisits."""
    archives = fresh_dir(spark, "warc")
    index = write(table(spark, folder, "pages"), archives)
    return read(index, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH digested AS (
  SELECT page_id, sha1(coalesce(html, '')) AS hex, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS kept FROM digested)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM marked
"""

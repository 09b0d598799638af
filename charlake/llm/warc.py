"""WARC archives: a gzip member for each record, written by tasks and read back one record after another.

`write_archives` writes a response record for each page, or a revisit record where another page with a
larger id has the same payload. `read_archives` streams each archive: members are inflated piece by
piece, a record's block is framed by its Content-Length, and block and payload digests are checked; a
broken member, frame or digest raises an error. Memory holds one record.

A task writes one archive under a name with its attempt, and only archives of attempts that ended are
listed, so a lost executor leaves at most an unlisted file. Archives lie in the shared folder.

NULL html: an empty payload. NULL url: the record's own id as address. NULL page_id: kept, never referred
to; such pages revisit the largest id of their payload if there is one. Repeated rows of the largest id
are responses all. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from charlake.llm.common import sendable
from charlake.llm.registry import query, table
from charlake.operators.scratch import new_path, written

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # records carry one date, so that the same pages give the same archives
ID = "urn:page:"

LEVEL = 6
READ_BYTES = 1 << 18
# Payloads at least this long are stored once; shorter ones are always stored.
LEAST_SHARED = 0

_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + member.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, response: int | None) -> bytes:
    """The response record of a page, or its revisit of the page `response`."""
    own = f"{ID}{'' if page_id is None else page_id}"
    fields = {
        "WARC-Record-ID": f"<{own}>",
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else own,
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
    }
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if response is None:
        return record("response", fields, http + payload)
    return record("revisit", fields | {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{ID}{response}>"}, http)


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages below `folder`; the list of archives: archive, records, bytes."""
    body = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"), F.sha1(body).alias("sha1"))
    shared = F.octet_length("body") >= LEAST_SHARED
    # Digests alone are summed up; only those that several pages share come back to the pages. A list of them that is
    # short enough is sent to where the pages lie, so that no body moves and a hot payload stays spread.
    last = rows.where(shared).groupBy("sha1").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(sendable(last, "shared-payloads"), "sha1", "left")
    response = F.when(shared & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    joined = joined.select("page_id", "url", "body", response.alias("response"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        n = size = 0
        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            info = record("warcinfo", {"WARC-Record-ID": f"<urn:archive:{name}>", "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
            size += out.write(info)
            for batch in batches:
                for page_id, url, payload, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    size += out.write(page_record(page_id, url, payload, response))
                    n += 1
        yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n], "bytes": [size]})

    return written(joined.mapInArrow(run, "archive string, records long, bytes long"), "archives")


def members(stream) -> Iterator[bytes]:
    """The inflated members of a stream of gzip members, one after another."""
    rest = b""
    while True:
        if not rest:
            rest = stream.read(READ_BYTES)
            if not rest:
                return
        inflater, parts = zlib.decompressobj(31), []
        while not inflater.eof:
            if not rest:
                rest = stream.read(READ_BYTES)
                if not rest:
                    raise ValueError("an archive ends inside a member")
            parts.append(inflater.decompress(rest))
            rest = inflater.unused_data if inflater.eof else b""
        yield b"".join(parts)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record; the block's digest is checked."""
    head, found, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or not version.startswith("WARC/"):
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is not framed by its Content-Length")
    stated = fields.get("warc-block-digest")
    if stated and stated != f"sha1:{digest(block)}":
        raise ValueError(f"record {fields.get('warc-record-id')} has another block digest than its header states")
    return fields, block


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{ID}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def page_row(fields: dict[str, str], block: bytes) -> dict:
    """A response's or revisit's row; the payload of a response is checked against its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)[1])
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or digest(payload) != stated):
        raise ValueError(f"record {fields['warc-record-id']} has another payload than its header states")
    return {
        "page_id": _page(fields["warc-record-id"]), "record_type": fields["warc-type"], "url": fields["warc-target-uri"],
        "refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": size, "payload_digest": stated,
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for each response and revisit record of the listed archives; each archive is read by one task."""
    schema = _RECORDS if with_payload else _RECORDS.remove(_RECORDS.get_field_index("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = _filesystem(uri)
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        fields, block = parsed(member)
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        row = page_row(fields, block)
                        rows.append({k: row[k] for k in schema.names})
                        held += 200 + (len(block) if with_payload else 0)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = {"int64": "long", "string": "string", "binary": "binary"}
    return archives.select("archive").repartition(tasks).mapInArrow(run, ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema))


_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS last, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), 'string_agg', '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = last OR payload_bytes < {LEAST_SHARED} THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last OR payload_bytes < {LEAST_SHARED} THEN NULL ELSE last END AS refers_to
FROM d
"""


@query("op9_warc", _SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    rows = read_archives(archives, with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

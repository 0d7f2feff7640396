"""WARC archives with a two-level capture index.

Archives: one gzip member per record, so a record is one byte range. Of captures
with equal payloads the one with the smallest ``page_id`` is a ``response``, the
others are ``revisit`` records that refer to it and carry no payload.

Index: captures are sorted by reversed-host URL key (``com,example,www)/path``)
and ``page_id`` into parts, one a partition. A part holds compressed blocks of
``BLOCK_LINES`` lines and, at its end, a sparse directory: the first key, offset
and length of each block. The list of parts with their first keys (one entry a
partition) is all that a reader holds in memory.

Lookup: a key finds its parts in the list, its blocks by binary search in the
part's directory, and then takes only those blocks by range reads. Records are
read in the order of their archives, neighbouring ranges at once.

How it runs: payload digests alone are grouped (with partial aggregation) to
find copies; texts move at most once, when there are many copies to mark. A key
whose captures fill several parts is looked up in each of them by another task.
Files are written under attempt names and moved, so lost tasks can run again.

Cases with a defined result: a NULL html is an empty payload; a NULL url has the
empty key; a NULL ``page_id`` is a response of its own; rows that repeat a
``page_id`` with an equal payload are all responses (or all revisits of a smaller
one); payloads below ``least_bytes`` are all responses; very long payloads are
one record; an empty table writes nothing; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import zlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapecraft.llm.files import RangeReader, write_file

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
READ_BYTES = 8 << 20
#: Bytes of records that one task reads back, about, where there are enough for every core.
TASK_BYTES = 256 << 20
GZIP_LEVEL = 4
#: WARC-Date of records whose table has no fetch time.
NO_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "urlkey string, page_id long, archive string, offset long, length long"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.Example.com:80/a?b#c`` is ``com,example,www)/a?b``."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:] or "/"
    host = host.removesuffix(":80").removesuffix(":443").rstrip(".")
    key = ",".join(reversed(host.split("."))) + ")" + path
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in key)


def _record(kind: str, page_id, url, digest: str, refers_to, payload: bytes) -> bytes:
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {NO_DATE}",
            f"WARC-Target-URI: {json.dumps(url or '', ensure_ascii=False)[1:-1]}", f"WARC-Payload-Digest: sha1:{digest}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload if kind == "response" else http
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(member: bytes) -> dict:
    """Headers and payload of one gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def _page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name else None


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_copies(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: the smallest page with an equal payload, NULL if it is the page itself."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digests = (pages.filter(F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes)
               .select("page_id", F.sha2(payload, 256).alias("digest")))
    groups = (digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
              .filter("refers_to < last").select("digest", "refers_to"))
    copies = digests.join(groups, "digest").filter("page_id > refers_to").distinct()
    keyed = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"))
    return keyed.join(copies, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def _write_archives(batches, folder):
    task = TaskContext.get().partitionId()
    rows = ((a, b, c, d) for batch in batches for a, b, c, d in zip(*(batch.column(k).to_pylist() for k in range(4))))
    number, row = 0, next(rows, None)
    while row is not None:
        name = f"archive-{task:06d}-{number:04d}.warc.gz"
        found = []

        def members():
            nonlocal row
            offset = 0
            while row is not None and offset < ARCHIVE_BYTES:
                page_id, url, html, refers_to = row
                payload = (html or "").encode()
                kind = "response" if refers_to is None else "revisit"
                member = gzip.compress(_record(kind, page_id, url, _sha1(payload), refers_to, payload), GZIP_LEVEL, mtime=0)
                found.append((url_key(url), page_id, name, offset, len(member)))
                offset += len(member)
                row = next(rows, None)
                yield member

        write_file(f"{folder}/{name}", members())
        number += 1
        for at in range(0, len(found), 20_000):
            yield _captures(found[at:at + 20_000])


def _captures(rows) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["urlkey", "page_id", "archive", "offset", "length"])


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write the archives; returns their captures (``urlkey, page_id, archive, offset, length``), read from a table."""
    marked = mark_copies(pages, least_bytes)
    marked.mapInArrow(lambda batches: _write_archives(batches, folder), CAPTURE).write.mode("overwrite").parquet(
        f"{folder}/captures")
    return pages.sparkSession.read.schema(CAPTURE).parquet(f"{folder}/captures")


def _write_part(batches, folder):
    part = TaskContext.get().partitionId()
    directory, rows = [], 0

    def blocks():
        nonlocal rows
        offset, lines, first = 0, [], None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if first is None:
                    first = row[0]
                lines.append("\t".join("" if x is None else str(x) for x in row))
                rows += 1
                if len(lines) == BLOCK_LINES:
                    block = zlib.compress("\n".join(lines).encode())
                    directory.append((first, offset, len(block)))
                    offset += len(block)
                    lines, first = [], None
                    yield block
        if lines:
            block = zlib.compress("\n".join(lines).encode())
            directory.append((first, offset, len(block)))
            yield block
        foot = zlib.compress(json.dumps(directory).encode())
        yield foot + struct.pack("<Q", len(foot))

    batches = iter(batches)
    head = next((b for b in batches if b.num_rows), None)
    if head is not None:
        rest = batches
        batches = (b for some in ([head], rest) for b in some)
        uri = f"{folder}/index-{part:06d}.cdz"
        write_file(uri, blocks())
        yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([uri]), pa.array([rows], pa.int64())],
                                         names=["first", "uri", "rows"])


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, str]]:
    """Write the sorted index parts; returns the list of parts as (first key, file), in order."""
    order = ["urlkey", "page_id", "archive", "offset"]
    parts = (captures.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(lambda batches: _write_part(batches, folder), "first string, uri string, rows long"))
    return sorted((r["first"], r["uri"]) for r in parts.collect())


def _keys_in_parts(batches, firsts):
    for batch in batches:
        out = []
        for key in {url_key(u) for u in batch.column(0).to_pylist()}:
            # captures of a key may begin in the part before the first one that starts with it
            for part in range(max(bisect.bisect_left(firsts, key) - 1, 0), bisect.bisect_right(firsts, key)):
                out.append((part, key))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([k for _, k in out])],
                                             names=["part", "urlkey"])


class IndexPart:
    """One part of the index: its directory in memory, its blocks by range reads."""

    def __init__(self, uri: str, reader: RangeReader | None = None):
        self.uri, self.reader = uri, reader or RangeReader()
        size = self.reader.size(uri)
        (foot,) = struct.unpack("<Q", self.reader.read(uri, size - 8, 8))
        self.directory = json.loads(zlib.decompress(self.reader.read(uri, size - 8 - foot, foot)))
        self.firsts = [x[0] for x in self.directory]
        self.held = (-1, [])

    def block(self, k: int) -> list[list[str]]:
        if self.held[0] != k:
            _, offset, length = self.directory[k]
            lines = zlib.decompress(self.reader.read(self.uri, offset, length)).decode().split("\n")
            self.held = (k, [x.split("\t") for x in lines])
        return self.held[1]

    def find(self, key: str):
        """Captures of one key, from the blocks that may hold it."""
        for k in range(max(bisect.bisect_left(self.firsts, key) - 1, 0), bisect.bisect_right(self.firsts, key)):
            rows = self.block(k)
            for row in rows[bisect.bisect_left(rows, key, key=lambda r: r[0]):]:
                if row[0] != key:
                    break
                yield row[0], int(row[1]) if row[1] else None, row[2], int(row[3]), int(row[4])


def lookup(urls: DataFrame, parts: list[tuple[str, str]]) -> DataFrame:
    """All captures of the URLs in the first column, through the index."""
    firsts, files = [p[0] for p in parts], [p[1] for p in parts]
    if not parts:
        return urls.sparkSession.createDataFrame([], CAPTURE)

    def search(part: pd.DataFrame) -> pd.DataFrame:
        index = IndexPart(files[int(part["part"].iloc[0])])
        found = [row for key in sorted(part["urlkey"]) for row in index.find(key)]
        frame = pd.DataFrame(found, columns=["urlkey", "page_id", "archive", "offset", "length"])
        return frame.astype({"page_id": "Int64"})

    keys = urls.select(urls.columns[0]).mapInArrow(lambda batches: _keys_in_parts(batches, firsts), "part int, urlkey string")
    return keys.distinct().repartition(len(parts), "part").groupBy("part").applyInPandas(search, CAPTURE)


def _read_records(batches, folder):
    reader = RangeReader()
    for batch in batches:
        archive, offset, length = (batch.column(k).to_pylist() for k in range(3))
        out, k = [], 0
        while k < len(archive):
            last = k + 1
            while (last < len(archive) and archive[last] == archive[k] and offset[last] == offset[last - 1] + length[last - 1]
                   and offset[last] + length[last] - offset[k] <= READ_BYTES):
                last += 1
            data = reader.read(f"{folder}/{archive[k]}", offset[k], offset[last - 1] + length[last - 1] - offset[k])
            for i in range(k, last):
                record = parse_record(data[offset[i] - offset[k]:offset[i] - offset[k] + length[i]])
                kind, digest = record["WARC-Type"], record["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and _sha1(record["payload"]) != digest:
                    raise ValueError(f"{archive[i]} at {offset[i]}: the payload does not have its digest")
                out.append((_page_of(record["WARC-Record-ID"]), len(record["payload"]) if kind == "response" else None,
                            digest, kind, _page_of(record["WARC-Refers-To"]) if kind == "revisit" else None))
            k = last
        if out:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_captures(captures: DataFrame, folder: str) -> DataFrame:
    """The records at the captures' byte ranges; a revisit's ``payload_bytes`` is that of its response."""
    spark = captures.sparkSession
    captures.select("archive", "offset", "length").write.mode("overwrite").parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    # tasks by the bytes of the records that they read, not of these rows
    volume = found.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // TASK_BYTES))
    ordered = found.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    ordered.mapInArrow(lambda batches: _read_records(batches, folder), schema).write.mode("overwrite").parquet(
        f"{folder}/records")
    records = spark.read.schema(schema).parquet(f"{folder}/records")
    revisits = records.filter("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    sizes = (records.filter("record_type = 'response'").join(wanted, ["page_id", "payload_digest"], "left_semi")
             .groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
             .withColumnRenamed("page_id", "refers_to"))
    resolved = (revisits.drop("payload_bytes").join(sizes, ["refers_to", "payload_digest"])
                .select("page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
    return records.filter("record_type = 'response'").unionByName(resolved)


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages, build the index, look every URL up and read its records back."""
    captures = write_archives(pages, folder, least_bytes)
    parts = write_index(captures, folder)
    return read_captures(lookup(pages.select("url"), parts), folder)

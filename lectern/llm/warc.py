"""Deterministic sharded WARC writer, and a reader.

Records are range-sorted by id, digest and address into shards, whose ends follow from the records alone. A shard's
task rolls its files by compressed size, one gzip member for each record, and writes each under a temporary name before
renaming it. Nothing in a file depends on time, host, attempt or how the input is partitioned, so the same table and
number of shards give the same bytes under the same names.
The manifest, one line for each file with its digest, is renamed into place last and commits the whole;
readers open the files that it lists and nothing else.

Files are written through pyarrow's file systems (local or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import id_key, partitions, range_of, range_starts, sized_join, small_batches

ROLL_BYTES = 16 << 20
#: The same in every record: the input has no times.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:lectern:warc")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with the payload, or a revisit of the page refers_to, whose block is the HTTP header alone."""
    digest = base32_sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))] if revisit else []),
        *([("X-Page", str(page_id))] if page_id is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = f"software: lectern\r\nformat: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Shard:
    """The files of one task."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.shard, self.roll, self.made, self.out = shard, roll, 0, None

    def open(self) -> None:
        self.name = f"pages-{self.shard:06d}-{self.made:05d}.warc.gz"
        self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}"
        self.out, self.size, self.digest, self.ids = self.files.open_output_stream(self.temporary), 0, hashlib.sha256(), []
        self.put(_info(self.name))

    def put(self, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        self.out.write(packed)
        self.digest.update(packed)
        self.size += len(packed)

    def add(self, page_id: int | None, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.open()
        self.put(data)
        self.ids = [*self.ids[:1], page_id]
        self.count = self.count + 1 if len(self.ids) > 1 else 1
        if self.size >= self.roll:
            yield self.close()

    def _has(self, final: str) -> bool:
        if self.files.get_file_info(final).type == fs.FileType.NotFound:
            return False
        there = hashlib.sha256()
        with self.files.open_input_stream(final, compression=None) as f:
            while part := f.read(1 << 20):
                there.update(part)
        if there.digest() == self.digest.digest():
            return True
        self.files.delete_file(final)  # of an abandoned write of other records
        return False

    def close(self) -> tuple:
        self.out.close()
        final = f"{self.folder}/{self.name}"
        if self._has(final):  # an earlier attempt's, with the same bytes: it stays
            self.files.delete_file(self.temporary)
        else:
            self.files.move(self.temporary, final)
        self.out, self.made = None, self.made + 1
        return self.name, self.count, self.size, self.digest.hexdigest(), self.ids[0], self.ids[-1]


def write_warc(pages: DataFrame, folder: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes a record for each row of pages to WARC files in folder, and then the manifest.

    Of rows with equal payloads those with the largest id are responses, the others revisit it. A null html is
    an empty payload; a null url becomes urn:page:ID; a null id is smaller than all others (and a response only if
    no row with its payload has an id). Rows that repeat id and payload get the same record id. Other columns
    aren't read. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.sha2("html", 256))
    heads = rows.groupBy("key").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "head")
    n = shards or partitions(spark)
    place = lambda df: F.concat(id_key(df["page_id"]), df["key"])
    starts = range_starts(rows.select(place(rows).alias("key")), n)
    rows = sized_join(rows, heads, "key", "left")
    dealt = rows.withColumn("shard", range_of(spark, place(rows), starts)["number"])
    dealt = dealt.repartitionById(n, F.col("shard")).sortWithinPartitions("page_id", "key", F.col("url").asc_nulls_first()).drop("key")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None

        def listed() -> Iterator[tuple]:
            nonlocal shard
            for batch in batches:
                for page_id, url, html, head, number in zip(*(batch[k].to_pylist() for k in ("page_id", "url", "html", "head", "shard"))):
                    shard = shard or _Shard(folder, number, roll_bytes)
                    yield from shard.add(page_id, record(page_id, url, html.encode(), head, head is not None and head != page_id))
            if shard and shard.out is not None:
                yield shard.close()

        for row in listed():
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("file", "records", "bytes", "sha256", "first_id", "last_id"), row)}, pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())]))

    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path(f"{folder}/manifest")):
        raise FileExistsError(f"{folder} already has a manifest")
    temporary = f"{folder}/.manifest-{uuid.uuid4().hex}"
    dealt.mapInArrow(put, MANIFEST).write.json(temporary)
    store.rename(path(temporary), path(f"{folder}/manifest"))


def records_of(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed WARC stream; checks lengths and block digests."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:60]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            headers[k] = v.strip()
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['WARC-Record-ID']} is cut off")
        if (want := headers.get("WARC-Block-Digest")) and want != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
        yield headers, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """RECORD rows of the files in folder's manifest; the payload of a revisit is null, its length and digest aren't."""
    small_batches(spark)
    manifest = spark.read.schema(MANIFEST).json(f"{folder}/manifest")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = fs.FileSystem.from_uri(folder)
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        number = lambda x: None if x is None else int(x)
        for name in (f for batch in batches for f in batch["file"].to_pylist()):
            rows, held = [], 0
            with files.open_input_stream(f"{place}/{name}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as stream:
                for headers, block in records_of(stream):
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size, digest = int(re.search(rb"Content-Length: (\d+)", head)[1]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
                    rows.append((number(headers.get("X-Page")), headers["WARC-Target-URI"], headers["WARC-Type"], number(headers.get("X-Refers-To-Page")), size, digest, None if revisit else payload))
                    held += len(block)
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    return manifest.select("file").repartition(partitions(spark)).mapInArrow(get, RECORD)

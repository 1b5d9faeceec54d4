"""Deterministic sharded WARC writer and its reader.

Records are range-sorted, each range is written by one task into gzip files
(one member per record) that roll over at a compressed size. A task writes
under a temporary name and renames a closed file to a name that holds its
content's digest; the manifest, written last, lists the files that count. A
failed or repeated task leaves at most files that no manifest names.

Records with equal payloads are kept once: the smallest page_id is the
response, the others are revisits that name it. Defined results: a null html
is the empty payload; a null page_id comes after all others and is a response
only where no record of its payload has an id; rows that share the smallest
id are all responses; an empty table gives an empty manifest; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialised, shared_folder, small_batches, table

SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str):
    """(pyarrow file system, path in it) of a Hadoop-style location."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\x00".join(map(repr, parts))).urn


def record_bytes(page_id, url, payload: bytes, refers_to, digest: str) -> bytes:
    """One WARC/1.1 record. The HTTP headers keep the payload's length also in
    a revisit, whose block ends with them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{record_id(page_id, url, digest)}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def clean(url) -> str:
    """A header value cannot hold line ends; null is written as the empty URI."""
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)  # header without time or name: equal bytes on every run
    return z.compress(data) + z.flush()


class RollingFiles:
    """Files of one shard, written under temporary names and renamed when closed."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.folder = file_system(folder)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None
        self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)

    def add(self, member: bytes):
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary/{self.shard:06d}-{self.number:05d}-{uuid.uuid4().hex}"
            self.out, self.digest, self.size, self.records = self.fs.open_output_stream(self.temporary), hashlib.sha256(), 0, 0
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1
        return self.close() if self.size >= self.roll_bytes else None

    def close(self):
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        name = f"shard-{self.shard:06d}-{self.number:05d}-{self.digest.hexdigest()[:16]}.warc.gz"
        self.fs.move(self.temporary, f"{self.folder}/{name}")
        self.number += 1
        return (name, self.shard, self.number - 1, self.records, self.size, self.digest.hexdigest())


MANIFEST = "file string, shard int, number int, records long, bytes long, sha256 string"


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest (hex), refers_to (null for responses)."""
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("_sha", F.sha1(F.encode("html", "UTF-8")))
    groups = own.groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = materialised(groups.where("_n > 1 AND _first IS NOT NULL").select("_sha", "_first"), "repeated")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("_first"))
    return own.join(repeated, "_sha", "left").select("page_id", "url", "html", "_sha", F.when(later, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder``; returns the manifest."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    rows = marked(pages).repartitionByRange(shards, F.col("page_id").asc_nulls_last(), "url", "_sha") \
                        .sortWithinPartitions(F.col("page_id").asc_nulls_last(), "url", "_sha")

    def write(batches):
        files = RollingFiles(folder, TaskContext.get().partitionId(), roll_bytes)
        closed = []
        for whole in batches:
            for b in small_batches(whole, "html"):
                for page_id, url, html, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    payload = html.encode()
                    closed.append(files.add(gzip_member(record_bytes(page_id, url, payload, refers_to, base32_sha1(payload)))))
        closed.append(files.close())
        closed = [c for c in closed if c]
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([c[i] for c in closed], t) for i, t in enumerate(types)], names=names)

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def members(stream, chunk: int = 1 << 20):
    """The decompressed gzip members of a stream, one at a time."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            return
        parts.append(z.decompress(data))
        if z.eof:
            rest = z.unused_data
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []


def parse(record: bytes) -> dict:
    """Header fields and payload of a record; raises ValueError if a digest or
    length does not hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
    if fields["WARC-Type"] == "response" and (len(payload) != length or f"sha1:{base32_sha1(payload)}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return fields | {"payload": payload, "payload_bytes": length}


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the files that the manifest names, with digests checked."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    files = manifest.count()
    shape = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads)

    def rows(batches):
        fs, root = file_system(folder)
        for batch in batches:
            for name, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                out, held, seen = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for r in map(parse, members(stream)):
                        number = lambda k: int(r[k]) if k in r else None
                        out.append((number("X-Page-ID"), r["WARC-Target-URI"], r["payload_bytes"], r["WARC-Payload-Digest"][5:],
                                    r["WARC-Type"], number("X-Refers-To-Page-ID")) + (r["payload"],) * payloads)
                        held, seen = held + len(r["payload"]) * payloads, seen + 1
                        if len(out) >= 10_000 or held >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), shape)], schema=shape)
                            out, held = [], 0
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records, the manifest says {records}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), shape)], schema=shape)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return manifest.select("file", "records").repartition(max(1, files)).mapInArrow(rows, schema + ", payload binary" * payloads)


def query(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).drop("url")

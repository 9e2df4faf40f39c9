"""WARC archives through a chunked record table.

A payload is a run of rows (record, chunk number, bytes), so neither writer
nor reader ever holds a whole record: each keeps one chunk and a running
SHA-1. Records with the payload of another, larger-numbered record become
``revisit`` records that name it and repeat its digest and length.

Archives are gzip files with a member per record, written below the shared
folder by the tasks themselves. A task names its file anew on every attempt
and only files of finished tasks are listed, so a retried task leaves no
record twice. Reading starts from that list.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are never
merged; rows that share the largest id of a payload group are all responses; a
null id is written as an empty name and read as null (it is never referred to
unless all ids of its group are null, when all are responses); a null address
is left out; an empty table writes no archive and reads as no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave.llm import common as C
from stockweave.session import work_dir

MIN_BYTES = 1000
CHUNK_BYTES = 64 * 1024
DATE = "2000-01-01T00:00:00Z"
#: Bytes of chunk rows a reader holds before it hands them on.
HELD_BYTES = 4 << 20
SALTS = 16


def revisits(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """id, digest and refers_to of the records that repeat the payload of a larger id.

    Groups with at most one id drop out before the join; a payload that many
    records share is spread over salts.
    """
    seen = C.staged(
        records.select("id", F.sha1("payload").alias("digest"), F.length("payload").alias("bytes")).filter(F.col("bytes") >= min_bytes).drop("bytes"),
        "warc-digests",
    )
    kept = seen.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    spread = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = seen.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return (
        salted.join(spread, ["digest", "salt"])
        .filter(~F.col("id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
        .select("id", "digest", "refers_to")
        .distinct()
    )


def chunks(records: DataFrame, repeats: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table to write: one row per chunk, chunk 0 always there, rows of a record in order."""
    rows = records.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.length("payload").cast("long"))
    again = repeats.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), "refers_to")
    rows = rows.join(again, F.col("id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    last = F.greatest(F.lit(0), F.ceil(F.length(body) / F.lit(chunk_bytes)).cast("int") - 1)
    return rows.withColumn("last", last).select(
        F.col("id").cast("string").alias("id"), "url", "digest", "bytes", F.col("refers_to").cast("string").alias("refers_to"), "last",
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("chunk_no"), body.alias("body"),
    ).select(
        "id", "url", "digest", "bytes", "refers_to", "last", "chunk_no",
        F.substring("body", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("chunk"),
    )


def _name(record: str | None) -> str:
    return f"<urn:record:{quote(record or '', safe='')}>"


def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def _head(row: dict) -> bytes:
    again = row["refers_to"] is not None
    http = _http(row["bytes"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: {_name(row['id'])}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(row['url'], safe=chr(37) + '/:?#[]@!$&()*+,;=~-._' + chr(39))}"] if row["url"] else []),
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if again else []),
        *([f"WARC-Refers-To: {_name(row['refers_to'])}"] if again else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + (0 if again else row['bytes'])}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(table: DataFrame, folder: str) -> DataFrame:
    """Write the chunk table as archives; returns path, records and bytes of each archive, itself staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        out, path, packer, digest, records = None, "", None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    files, root = fs.FileSystem.from_uri(folder)
                    files.create_dir(root, recursive=True)
                    path = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{root}/{path}", compression=None)
                if row["chunk_no"] == 0:
                    packer, digest = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
                    out.write(packer.compress(_head(row)))
                digest.update(row["chunk"])
                out.write(packer.compress(row["chunk"]))
                if row["chunk_no"] == row["last"]:
                    if row["refers_to"] is None and digest.hexdigest() != row["digest"]:
                        raise ValueError(f"record {row['id']}: its chunks do not add up to its digest")
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    records += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": records, "bytes": size}])

    return C.staged(table.mapInArrow(run, "path string, records long, bytes long"), "warc-list")


class _Stream:
    """Decompressed bytes of a file of gzip members, taken piece by piece."""

    def __init__(self, raw, step: int):
        self.raw, self.step, self.buffer, self.packed, self.unpacker = raw, step, b"", b"", None

    def _more(self) -> bool:
        while True:
            if self.unpacker is None or self.unpacker.eof:
                self.packed = (self.unpacker.unused_data if self.unpacker else b"") or self.raw.read(self.step)
                if not self.packed:
                    return False
                self.unpacker = zlib.decompressobj(31)
            elif self.unpacker.unconsumed_tail:
                self.packed = self.unpacker.unconsumed_tail
            else:
                self.packed = self.raw.read(self.step)
                if not self.packed:
                    raise ValueError("an archive ends within a record")
            got = self.unpacker.decompress(self.packed, self.step)
            if got:
                self.buffer += got
                return True

    def head(self) -> dict[str, str] | None:
        """Header lines up to the empty one; None at the end of the file."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError("an archive ends within a header")
                return None
        lines, self.buffer = self.buffer[:end].decode().split("\r\n"), self.buffer[end + 4 :]
        return {"": lines[0], "size": str(end + 4)} | {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("an archive ends within a record")
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got


def _plain(name: str | None) -> str | None:
    return unquote(name[len("<urn:record:") : -1]) or None if name else None


def _records(raw, chunk_bytes: int, with_data: bool) -> Iterator[dict]:
    """Chunk rows of one archive."""
    stream = _Stream(raw, chunk_bytes)
    while (head := stream.head()) is not None:
        if head[""] not in ("WARC/1.0", "WARC/1.1"):
            raise ValueError(f"no record starts with {head['']!r}")
        http = stream.head()
        left = int(head["content-length"]) - int(http["size"])
        said = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        row = {"id": _plain(head["warc-record-id"]), "url": head.get("warc-target-uri"), "record_type": head["warc-type"], "refers_to": _plain(head.get("warc-refers-to"))}
        digest, at, no = hashlib.sha1(), 0, 0
        while True:
            data = stream.take(min(chunk_bytes, left))
            left, at = left - len(data), at + len(data)
            digest.update(data)
            again = row["record_type"] == "revisit"
            # A revisit stands for the payload it refers to: the stated length and digest are those of the full payload.
            yield row | {
                "chunk_no": no, "chunk": data if with_data else None, "bytes_so_far": int(http["content-length"]) if again else at,
                "digest_so_far": said if again else digest.hexdigest(), "last": left == 0,
            }
            no += 1
            if left == 0:
                break
        if row["record_type"] == "response" and (digest.hexdigest() != said or at != int(http["content-length"])):
            raise ValueError(f"record {row['id']}: its payload does not have the stated digest")
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"record {row['id']} does not end where it should")


CHUNK_SCHEMA = "id string, url string, record_type string, refers_to string, chunk_no int, chunk binary, bytes_so_far long, digest_so_far string, last boolean"


def read(archives: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of the listed archives, with the length and digest of each record up to each chunk.

    ``with_data=False`` leaves the bytes out of the rows; they are still read and digested.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        schema = pa.schema([
            ("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("chunk_no", pa.int32()),
            ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()),
        ])
        files, root = fs.FileSystem.from_uri(folder)
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(f"{root}/{path}", compression=None) as raw:
                    for row in _records(raw, chunk_bytes, with_data):
                        rows.append(row)
                        held += 256 + len(row["chunk"] or b"")
                        if held >= HELD_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    spread = archives.select("path").repartition(C.partitions(archives.sparkSession), "path")
    return spread.mapInArrow(run, CHUNK_SCHEMA)


def shared_folder(spark: SparkSession, purpose: str = "warc") -> str:
    """A fresh folder below the shared one, as an address both Spark and Arrow resolve alike."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark, purpose))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write every page to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    kind = pages.schema[key].dataType
    records = pages.select(
        F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")
    )
    folder = shared_folder(pages.sparkSession)
    listed = write(chunks(records, revisits(records), chunk_bytes), folder)
    return read(listed, folder, chunk_bytes, with_data=False).filter("last").select(
        F.col("id").cast(kind).alias(key), F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )

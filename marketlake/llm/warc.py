"""WARC archives: one gzip member per record, and a sequential reader.

Of pages with equal payloads the one with the largest page_id is stored whole (response); the others are revisit records
that name it and carry the HTTP head only. Payloads under least_bytes are all stored whole. The reader inflates member
after member from a stream, frames each record by Content-Length and verifies the payload digest of every response.

Defined results: null html is an empty payload; rows tied at the largest page_id are all responses; a null page_id never
is referred to unless the whole group has none, then each of its rows is a response; line breaks in a URL are escaped and
a null URL becomes `urn:x-page:` and the id; whole payloads are stored, however long, one at a time in memory; other columns,
with whatever names, are ignored; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, run_dir, save, small, small_batches

DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes | None) -> bytes:
    """One WARC record; payload None makes a revisit."""
    target = (url or f"urn:x-page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if payload is None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, inflated one after the other; holds one member at a time."""
    data, inflate, out = b"", None, []
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                break
        if inflate is None:
            inflate = zlib.decompressobj(wbits=31)
        out.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            yield b"".join(out)
            inflate, out = None, []
    if inflate is not None:
        raise ValueError("the archive ends within a gzip member")


def parse(member: bytes) -> dict:
    """Fields of one record, framed by Content-Length, its digest verified."""
    head, found, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: Content-Length doesn't frame the record")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't have its digest")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:x-page:").removesuffix(">")) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, "url": fields["WARC-Target-URI"], "payload": payload,
    }


def write_archives(pages: DataFrame, out_dir: str, least_bytes: int = 0, file_bytes: int = 256 << 20, level: int = 1) -> DataFrame:
    """Write page_id, url, html as WARC files; returns the manifest (path, n_records)."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.unhex(F.sha1("html"))).withColumn("size", F.octet_length("html").cast("long"))
    # ids and digests alone are grouped and, of payloads that repeat, few enough to be sent to every task; beyond, pages are
    # shuffled by digest
    first = pages.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper")
    rows = pages.join(small(save(first, "warc-keepers")), "digest", "left")
    again = (F.col("size") >= least_bytes) & (F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("keeper"))
    rows = rows.withColumn("again", F.coalesce(again, F.lit(False)))
    rows = rows.select("page_id", "url", "digest", "size", F.when(F.col("again"), F.col("keeper")).alias("refers_to"), F.when(~F.col("again"), F.col("html")).alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = file_system(out_dir)
        f, name, size, n, seq = None, "", 0, 0, 0
        for batch in batches:
            for page_id, url, digest, length, refers_to, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if f is None:
                    fs.create_dir(root)
                    name = f"{root}/{task.partitionId():06d}-{seq:05d}-{task.taskAttemptId()}.warc.gz"
                    f, size, n, seq = fs.open_output_stream(name, compression=None), 0, 0, seq + 1
                payload = None if html is None else html.encode()
                deflate = zlib.compressobj(level, wbits=31)
                data = deflate.compress(record(page_id, url, base64.b32encode(digest).decode(), length, refers_to, payload)) + deflate.flush()
                f.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    f.close()
                    yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]})
                    f = None
        if f is not None:
            f.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]})

    small_batches(pages.sparkSession)
    return save(rows.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_archives(manifest: DataFrame, out_dir: str, payloads: bool = False) -> DataFrame:
    """Every record of the listed archives; with payloads, the payload bytes and URL too."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["url", "payload"] if payloads else [])]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payloads

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(out_dir)
        for frame in frames:
            for path in frame["path"]:
                rows = []
                with fs.open_input_stream(path, compression=None) as f:
                    for member in members(f):
                        row = parse(member)
                        rows.append([row[k] for k in names])
                        if len(rows) >= (64 if payloads else 4096):
                            yield frame_of(rows)
                            rows = []
                if rows:
                    yield frame_of(rows)

    def frame_of(rows: list[list]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({k: "Int64" for k in ("page_id", "payload_bytes", "refers_to")})

    spark = manifest.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(n, "path").mapInPandas(read, schema)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read the archives back."""
    out_dir = run_dir(spark, "warc")
    return read_archives(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), out_dir), out_dir)

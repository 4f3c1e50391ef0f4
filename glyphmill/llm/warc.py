"""Deterministic, sharded WARC archives.

Records are range-sorted by key, so each task writes one run of keys. A file
is rolled when its compressed size passes a limit, is written under a hidden
name and renamed when whole, and the manifest that names the files is a table
written at the end. Headers, ids and digests are made anew from the rows, so
the same rows give the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._bytes import tidied
from glyphmill.llm._spark import keep, open_folder, shared_dir

CRLF = b"\r\n"
_CONTROL = re.compile("[\x00-\x1f\x7f]")
_READ = 1 << 15
#: Fixed value of the format: the profile of a revisit with an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcParams:
    #: Compressed bytes after which a file is closed.
    file_bytes: int = 16 << 20
    #: Payload bytes of a writing task, about.
    bytes_per_task: int = 32 << 20
    #: Every record's date: archives made twice from the same rows are equal.
    date: str = "2000-01-01T00:00:00Z"
    #: Smallest payload that may be a revisit.
    min_revisit: int = 0
    level: int = 4


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'warc-record:{key}')}>"


def _header_value(text: str) -> str:
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", text)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {_header_value(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + 2 * CRLF + block + 2 * CRLF


def page_record(key, url, payload: bytes, digest: str, refers_to, params: WarcParams) -> bytes:
    """A response with its payload, or a revisit that names the response which holds it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Record-ID", record_id(key)), ("WARC-Date", params.date)]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Source-Key", "" if key is None else str(key)), ("WARC-Payload-Length", str(len(payload)))]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    if refers_to is None:
        block = http + payload
        return record("response", [*headers, ("WARC-Block-Digest", f"sha1:{payload_digest(block)}")], block)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("WARC-Refers-To-Key", str(refers_to)), ("WARC-Block-Digest", f"sha1:{payload_digest(http)}")]
    return record("revisit", headers, http)


def gzip_member(raw: bytes, level: int) -> bytes:
    """One gzip member without a time or a name."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def read_records(raw: bytes):
    """(headers, block) of each record of a file of gzip members."""
    view, at = memoryview(raw), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:  # in small reads, as what is left over from one is copied
            if at >= len(view):
                raise ValueError("a gzip member is cut short")
            parts.append(unpacker.decompress(view[at : at + _READ]))
            at = min(len(view), at + _READ) - len(unpacker.unused_data)
        whole = b"".join(parts)
        head, _, rest = whole.partition(2 * CRLF)
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line) | {line[:-1]: "" for line in lines[1:] if line.endswith(":")}
        yield headers, rest[: int(headers["Content-Length"])]


class WarcFile:
    def __init__(self, folder: str, name: str, params: WarcParams):
        self.files, self.root = open_folder(folder)
        self.name, self.params = name, params
        self.hidden = f"{self.root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.hidden, compression=None)
        self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
        info = f"software: glyphmill\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
        self._put(record("warcinfo", [("WARC-Record-ID", record_id(name)), ("WARC-Date", params.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
        self.records = 0

    def _put(self, raw: bytes) -> None:
        member = gzip_member(raw, self.params.level)
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1

    def add(self, *page) -> None:
        self._put(page_record(*page, self.params))

    def close(self) -> dict:
        self.out.close()
        self.files.move(self.hidden, f"{self.root}/{self.name}")
        return {"file": self.name, "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()}


def write_warc(pages: DataFrame, folder: str, params: WarcParams = WarcParams(), key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record a row and return the manifest (file, records, bytes, sha256).

    Of rows with equal payloads of at least min_revisit bytes the largest key is
    the response and the others revisit it. A null html is an empty payload; a
    null url gives no target; rows with a null key are responses of their own;
    repeated rows are written each, those of the response's key all as
    responses; an empty table makes no file; other columns are ignored.
    Which record holds a payload is decided on (key, digest) pairs only, so
    no task gathers the pages of one payload.
    """
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("u"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("p"))
    sizes = rows.agg(F.sum(F.octet_length("p"))).first()[0] or 0
    digests = rows.where("k is not null").select("k", F.octet_length("p").alias("n"), F.sha1("p").alias("d"))
    digests = digests.where(F.col("n") >= params.min_revisit)
    heads = digests.groupBy("d", "n").agg(F.max("k").alias("head"), F.count(F.lit(1)).alias("same")).where("same > 1")
    refers = digests.join(heads, ["d", "n"]).where("k <> head").groupBy("k", "d").agg(F.max("head").alias("head"))
    # a reference travels as a row of its own with its page's key and is sorted before the page: one exchange of the payloads
    notes = refers.select("k", F.lit(None).cast("string").alias("u"), F.unhex("d").alias("p"), "head")
    dealt = rows.withColumn("head", F.lit(None).cast("long")).unionByName(notes)
    dealt = dealt.repartitionByRange(max(1, -(-sizes // params.bytes_per_task)), "k").sortWithinPartitions("k", F.col("head").isNull(), "u", "p")

    def write(batches):
        task, part, out, owner, known = TaskContext.get().partitionId(), 0, None, None, {}
        for batch in batches:
            for k, u, p, head in zip(*(batch.column(i) for i in range(4))):
                k, payload = k.as_py(), p.as_py()
                if k != owner:
                    owner, known = k, {}
                if head.is_valid:
                    known[payload] = head.as_py()
                    continue
                if out is None:
                    out = WarcFile(folder, f"part-{task:06d}-{part:04d}.warc.gz", params)
                sha = hashlib.sha1(payload).digest()
                out.add(k, u.as_py(), payload, base64.b32encode(sha).decode(), known.get(sha))
                if out.bytes >= params.file_bytes:
                    yield pa.RecordBatch.from_pylist([out.close()])
                    out, part = None, part + 1
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.close()])

    return keep(dealt.mapInArrow(tidied(write), "file string, records long, bytes long, sha256 string"), f"{folder}/_manifest")


def read_warc(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """One row a record of the manifest's files: page_id, url, payload_bytes, payload_digest, record_type, refers_to, file.

    A response's length and digest are computed from its block and must equal
    its header's; a file whose bytes differ from the manifest's is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    files = files.join(manifest.select("file", "sha256"), "file")

    def parse(batches):
        for batch in batches:
            for name, raw, sha in zip(batch.column("file").to_pylist(), batch.column("content"), batch.column("sha256").to_pylist()):
                raw = raw.as_py()
                if hashlib.sha256(raw).hexdigest() != sha:
                    raise ValueError(f"{name} is not the file that the manifest names")
                rows = []
                for headers, block in read_records(raw):
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["WARC-Payload-Length"])
                    if kind == "response":
                        payload = block.partition(2 * CRLF)[2]
                        if (payload_digest(payload), len(payload)) != (digest, size):
                            raise ValueError(f"{headers['WARC-Record-ID']} does not hold its payload")
                    key, head = headers.get("WARC-Source-Key"), headers.get("WARC-Refers-To-Key")
                    rows.append({"page_id": int(key) if key else None, "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": int(head) if head else None, "url": headers.get("WARC-Target-URI"), "file": name})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string())]))

    return files.mapInArrow(tidied(parse), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string")


def op3_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    manifest = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_warc(spark, folder, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

"""WARC records in a chunked record table (operator 6).

An archive is a table of (record, chunk number, bytes) rows: a record's bytes,
headers first, are cut into chunks of bounded size, so an oversized payload is
never one value on the way out or in. Each chunk carries the SHA-1 of the payload up
to its end; the reader recomputes it chunk by chunk and refuses a record whose
digests differ or whose chunks are not all there.

Of records with equal payloads the one with the largest id is a response; the
others are revisits that name it and carry its headers without the payload.

Cases: a null payload is empty; a null url is an empty target; null ids are
written as records of their own, after which no revisit names them; repeated
ids are separate records (of equal payloads and equal largest ids exactly one
stays a response); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CHUNK_BYTES = 1 << 18
BATCH_BYTES = 1 << 23
END = b"\r\n\r\n"


def digest32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def payload_digests(pages: DataFrame) -> DataFrame:
    """(_k, _id, _digest, _bytes): SHA-1 over slices of the value's own buffer."""
    def go(batches):
        for b in batches:
            data, off = C.text_buffers(b.column(2))
            out, off = [], off.tolist()
            for i in range(len(off) - 1):
                h = hashlib.sha1()
                for a in range(off[i], off[i + 1], CHUNK_BYTES):
                    h.update(data[a:min(a + CHUNK_BYTES, off[i + 1])])
                out.append(digest32(h))
            size = [y - x for x, y in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out), pa.array(size, pa.int64())], ["_k", "_id", "_digest", "_bytes"])
    return pages.select("_k", "_id", "_payload").mapInArrow(go, "_k long, _id long, _digest string, _bytes long")


def plan_records(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(_k, _digest, _bytes, _refers, _refers_k): the response each revisit refers to, else null."""
    best = (digests.where((F.col("_bytes") >= min_bytes) & F.col("_id").isNotNull()).groupBy("_digest", "_bytes")
            .agg(F.max(F.struct("_id", "_k")).alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
            .select("_digest", "_bytes", F.col("_top._id").alias("_top_id"), F.col("_top._k").alias("_top_k")))
    own = digests.join(best, ["_digest", "_bytes"], "left")
    revisit = F.col("_top_k").isNotNull() & (F.col("_top_k") != F.col("_k")) & F.col("_id").isNotNull()
    return own.select("_k", "_digest", "_bytes", F.when(revisit, F.col("_top_id")).alias("_refers"))


def _record_uri(k: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=k % (1 << 128))}>"


def _head(kind: str, k: int, page, url: str, digest: str, n: int, refers) -> bytes:
    """WARC and HTTP header lines before the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_uri(k)}", f"WARC-Target-URI: {url}",
             "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Page-Id: {'' if page is None else page}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers}"]
    lines.append(f"Content-Length: {len(block) + (n if kind == 'response' else 0)}")
    return "\r\n".join(lines).encode() + END + block


CHUNKS = pa.schema([("_k", pa.int64()), ("_chunk", pa.int32()), ("_chunks", pa.int32()), ("_data", pa.binary()), ("_running", pa.string())])
CHUNKS_SQL = "_k long, _chunk int, _chunks int, _data binary, _running string"


def _cuts(lead: int, payload: int, size: int):
    """Byte ranges of a record's chunks; the first one holds all header lines."""
    total, lo = lead + payload + len(END), 0
    while lo < total:
        hi = min(total, max(lo + size, lead))
        yield lo, hi
        lo = hi


def record_chunks(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of each planned record (_k, _id, _url, _digest, _bytes, _refers, _payload)."""
    def go(batches):
        for b in batches:
            data, off = C.text_buffers(b.column(6))
            off = off.tolist()
            out, held = [], 0
            meta = zip(*(b.column(i).to_pylist() for i in range(6)), strict=True)
            for i, (k, page, url, digest, n, refers) in enumerate(meta):
                kind = "response" if refers is None else "revisit"
                url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                lead = _head(kind, k, page, url, digest, n, refers)
                end = off[i + 1] if kind == "response" else off[i]
                h, chunks = hashlib.sha1(), list(_cuts(len(lead), end - off[i], chunk_bytes))
                for c, (lo, hi) in enumerate(chunks):
                    take = data[off[i] + max(0, lo - len(lead)):min(end, off[i] + max(0, hi - len(lead)))]
                    h.update(take)
                    tail = END[max(0, lo - len(lead) - (end - off[i])):max(0, hi - len(lead) - (end - off[i]))]
                    out.append((k, c, len(chunks), lead[lo:hi] + take.tobytes() + tail, digest32(h)))
                    held += hi - lo
                    if held > BATCH_BYTES:
                        yield to_batch(out)
                        out, held = [], 0
            if out:
                yield to_batch(out)

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CHUNKS.types)], schema=CHUNKS)

    return rows.select("_k", "_id", "_url", "_digest", "_bytes", "_refers", "_payload").mapInArrow(go, CHUNKS_SQL)


def write_archive(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write the records of all pages to the chunk table `out`."""
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        F.col(payload_col).cast("string").alias("_payload"))
    ids = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    if ids.where("_n > 1 or _id is null").limit(1).count():
        rows = C.stored(rows.withColumn("_k", F.monotonically_increasing_id()), "records")
    else:
        rows = rows.withColumn("_k", F.col("_id"))
    digests = C.stored(payload_digests(rows), "digests")
    plan = plan_records(digests, min_bytes)
    record_chunks(rows.join(plan, "_k"), chunk_bytes).write.parquet(out)


RECORDS_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RECORD_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())


class _Reader:
    """Parses one record from its chunks, holding the header lines only."""

    def __init__(self):
        self.sha, self.head, self.seen, self.next = hashlib.sha1(), b"", 0, 0

    def feed(self, chunk: int, data: bytes, running: str) -> None:
        if chunk != self.next:
            raise ValueError(f"chunk {chunk} where {self.next} is due")
        self.next += 1
        if chunk == 0:
            a = data.index(END)
            self.warc = dict(x.split(": ", 1) for x in data[:a].decode().split("\r\n")[1:])
            b = data.index(END, a + 4)
            self.http = dict(x.split(": ", 1) for x in data[a + 4:b].decode().split("\r\n")[1:])
            self.left = int(self.warc["Content-Length"]) - (b + 4 - a - 4)
            data = data[b + 4:]
        take = data[:self.left]
        self.sha.update(take)
        self.left -= len(take)
        self.seen += len(take)
        if digest32(self.sha) != running:
            raise ValueError(f"digest of {self.warc['WARC-Record-ID']} differs at chunk {chunk}")

    def record(self) -> tuple:
        kind = self.warc["WARC-Type"]
        digest = self.warc["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.left or (kind == "response" and digest != digest32(self.sha)):
            raise ValueError(f"record {self.warc['WARC-Record-ID']} is not whole")
        page, refers = self.warc["X-Page-Id"], self.warc.get("X-Refers-To-Page-Id")
        return (int(page) if page else None, int(self.http["Content-Length"]), digest, kind, int(refers) if refers else None)


def read_archive(spark, out: str) -> DataFrame:
    """One row per record, read from the chunk table. Records of one chunk are
    parsed where they lie; the chunks of longer ones are brought together in order."""
    def go(batches):
        key, reader, chunks = None, None, 0
        for b in batches:
            rows = []
            for k, c, n, data, running in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if c == 0:
                    if reader is not None and reader.next != chunks:
                        raise ValueError(f"record {key} lacks chunks")
                    key, reader, chunks = k, _Reader(), n
                if reader is None or k != key:
                    raise ValueError(f"record {k} lacks its first chunk")
                reader.feed(c, data, running)
                if c == n - 1:
                    rows.append(reader.record())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_TYPES)],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if reader is not None and reader.next != chunks:
            raise ValueError(f"record {key} lacks chunks")

    table = spark.read.schema(CHUNKS_SQL).parquet(out)
    one = table.where("_chunks = 1").mapInArrow(go, RECORDS_SQL)
    more = table.where("_chunks > 1").repartition("_k").sortWithinPartitions("_k", "_chunk").mapInArrow(go, RECORDS_SQL)
    return one.unionByName(more)

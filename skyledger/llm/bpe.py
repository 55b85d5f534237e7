"""Byte-level BPE encoding and decoding by overlapping chunks (operator 5).

A text longer than one chunk is cut into chunks that overlap. Chunks are
pre-tokenised in parallel, each from its own start; where the pre-token
boundaries of a chunk and its successor meet inside their overlap the two have
resynchronised, and the text is cut there. A match of the pattern depends only
on the text from its start on, so from a common boundary on both agree. The
pieces between cuts are encoded in parallel, put in order and decoded by
concatenating the bytes of their ids.

If an overlap holds no common boundary (one pre-token longer than the overlap),
the open piece goes on and its boundaries are taken from its last cut.

Cases: a null or empty text has no ids; null or repeated ids give one row per
input row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
#: a boundary this near to a chunk's end may move with the text behind it ('l before another l)
UNSURE = 1


class Coder:
    """Encoder and decoder of one rank file; `path` and `pattern` are parameters."""

    _made: dict = {}

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            table[i] = token
        self.length = np.array([len(t) for t in table], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)

    @classmethod
    def get(cls, path: str, pattern: str) -> "Coder":
        """One coder per worker process."""
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]

    def encode(self, piece: str) -> np.ndarray:
        return self.library.encode_to_numpy(piece, disallowed_special=()).astype("<u4", copy=False)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return self.bytes[C.ragged(self.first[ids], self.length[ids])].tobytes()


def chunk_rows(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(_k, _i, _chunk) of every text longer than one chunk, dealt out by chunk."""
    n = F.ceil(F.length("_text") / F.lit(chunk)).cast("int")
    return (texts.where(F.length("_text") > chunk)
            .select("_k", F.col("_text"), F.explode(F.sequence(F.lit(0), n - 1)).alias("_i"))
            .select("_k", "_i", F.substring(F.col("_text"), F.col("_i") * chunk + 1, F.lit(chunk + overlap)).alias("_chunk"))
            .repartition(F.col("_k"), F.col("_i")))


def chunk_boundaries(rows: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Adds the boundaries of each chunk inside the overlaps with its neighbours,
    as positions from the start of the overlap."""
    def go(batches):
        coder = Coder.get(path, pattern)
        for b in batches:
            head, tail = [], []
            for text in b.column(2).to_pylist():
                cut = coder.boundaries(text)
                head.append([p for p in cut if p < overlap])
                tail.append([p - chunk for p in cut if chunk <= p < len(text) - UNSURE])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))],
                ["_k", "_i", "_chunk", "_head", "_tail"])
    return rows.mapInArrow(go, "_k long, _i int, _chunk string, _head array<int>, _tail array<int>")


def stitch(rows: DataFrame, path: str, pattern: str, overlap: int) -> DataFrame:
    """(_k, _p, _piece): the texts cut at the first common boundary of each overlap.

    Rows stream in order of (text, chunk); only the open piece is held."""
    def go(batches):
        coder = Coder.get(path, pattern)
        key = piece = tail = None
        p, out = 0, []

        def rows_out():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.string())], ["_k", "_p", "_piece"])

        for b in batches:
            for k, text, head, last in zip(*(b.column(x).to_pylist() for x in (0, 2, 3, 4)), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, p, piece))
                    key, piece, tail, p = k, text, last, 0
                    continue
                over = min(overlap, len(text))  # the open piece ends with what this chunk starts with
                base = len(piece) - over
                if tail is None:  # no common boundary last time: take them from the last cut
                    tail = [x - base for x in coder.boundaries(piece) if base <= x < len(piece) - UNSURE]
                # white space is matched by what follows it: no cut behind it
                common = {x for x in set(tail).intersection(head) if x < over and not piece[base + x - 1].isspace()}
                if common:
                    cut = min(common)
                    if base + cut:
                        out.append((key, p, piece[:base + cut]))
                        p += 1
                    piece, tail = text[cut:], last
                else:
                    piece, tail = piece + text[over:], None
            if out:
                yield rows_out()
                out = []
        if key is not None:
            out.append((key, p, piece))
            yield rows_out()

    ordered = rows.repartition("_k").sortWithinPartitions("_k", "_i")
    return ordered.mapInArrow(go, "_k long, _p int, _piece string")


def encode_pieces(pieces: DataFrame, path: str, pattern: str) -> DataFrame:
    """(_k, _p, _ids): ids of each piece as little-endian unsigned 32-bit integers."""
    def go(batches):
        coder = Coder.get(path, pattern)
        for b in batches:
            ids = [coder.encode(t or "").tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["_k", "_p", "_ids"])
    return pieces.mapInArrow(go, "_k long, _p int, _ids binary")


def long_text_ids(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(_k, _p, _ids) of the texts longer than one chunk, in ordered pieces."""
    rows = chunk_boundaries(chunk_rows(texts, chunk, overlap), path, pattern, chunk, overlap)
    pieces = stitch(rows, path, pattern, overlap).repartition(F.col("_k"), F.col("_p"))
    return encode_pieces(pieces, path, pattern)


def short_text_ids(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK_CHARS) -> DataFrame:
    """(_k, _p, _ids) of the texts of one chunk (null: empty)."""
    rows = (texts.where(F.coalesce(F.length("_text"), F.lit(0)) <= chunk)
            .select("_k", F.lit(0).cast("int").alias("_p"), F.coalesce("_text", F.lit("")).alias("_piece")))
    return encode_pieces(rows, path, pattern)


DIGESTS = "_k long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """Count and digests of the ids and of the decoded bytes of each text; rows of
    a text must follow each other in order."""
    def go(batches):
        coder = Coder.get(path, pattern)
        key, n, h, d, out = None, 0, None, None, []
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(2)):
                if k != key:
                    if key is not None:
                        out.append((key, n, h.hexdigest(), d.hexdigest()))
                    key, n, h, d = k, 0, hashlib.sha256(), hashlib.sha256()
                raw = raw.as_buffer()
                part = np.frombuffer(raw, dtype="<u4")
                n += len(part)
                h.update(raw)
                d.update(coder.decode(part))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("_k", "n_tokens", "ids_sha256", "decoded_sha256"), r)) for r in out])
                out = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("_k", "n_tokens", "ids_sha256", "decoded_sha256"), (key, n, h.hexdigest(), d.hexdigest())))])
    return ids.mapInArrow(go, DIGESTS)


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per input row.

    Texts of one chunk never leave their task. Only chunks and ids of longer
    texts are shuffled; digests stream over a text's pieces in order."""
    texts, keys = C.keyed_texts(docs, id_col, text_col)
    short = digests(short_text_ids(texts, path, pattern, chunk), path, pattern)
    long = digests(long_text_ids(texts, path, pattern, chunk, overlap).repartition("_k").sortWithinPartitions("_k", "_p"), path, pattern)
    out = short.unionByName(long)
    out = out.withColumnRenamed("_k", "doc_id") if keys is None else out.join(keys, "_k").select(
        F.col("_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
    return out

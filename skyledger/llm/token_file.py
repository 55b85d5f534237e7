"""Token-id files in Simple-8b (operator 4).

A file row is one group of up to 65,536 ids of consecutive documents. Its
payload holds blocks of 4,096 ids, each packed into 64-bit words on its own, and
the word offset of every block, so that all blocks can be decoded at once with
array operations. The top four bits of a word select how many ids of how many
bits follow; a value over 60 bits is an escape: its word only marks the place
and the value stands in the group's exception list.

Rows are written in ascending id order: texts are dealt out by id range, sorted
inside each range and encoded in streams; a part's rows carry the ids before
them in their part, and the totals of the parts (one number each) give the
global start. Parquet is the container because only Spark's writers reach every
kind of store.

Cases: a null or empty text has the end id only; a null id sorts first;
repeated ids keep all their rows (equal ids in order of their text); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

GROUP_IDS = 1 << 16
BLOCK_IDS = 1 << 12
#: (ids in a word, bits of each) by selector; fixed values of the format. 0 is the escape.
SELECTORS = ((1, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([c for c, _ in SELECTORS], dtype=np.int64)
MAGIC = b"S8B1"


def bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits of each unsigned value, exactly."""
    if not len(x) or int(x.max()) < 1 << 53:
        return np.frexp(x.astype(np.float64))[1].astype(np.uint8)
    high = x >> np.uint64(32)
    low = np.frexp((x & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, low).astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """Payload of up to GROUP_IDS unsigned values."""
    n = len(ids)
    x = ids.astype(np.uint64)
    blocks = -(-n // BLOCK_IDS)
    wide = np.full((blocks, BLOCK_IDS + 120), 255, dtype=np.uint8)  # 255: no id here, fits nothing
    bits = np.full(blocks * BLOCK_IDS, 255, dtype=np.uint8)
    bits[:n] = bit_lengths(x)
    wide[:, :BLOCK_IDS] = bits.reshape(blocks, BLOCK_IDS)
    sel = np.zeros((blocks, BLOCK_IDS), dtype=np.uint8)
    most, have = wide, 1
    for s in range(15, 0, -1):  # from one id a word to 120: the last that fits wins
        c, b = SELECTORS[s]
        while have < c:  # most[i] = largest of the next `have` lengths
            step = min(have, c - have)
            longer = np.full_like(wide, 255)
            longer[:, :wide.shape[1] - step] = np.maximum(most[:, :wide.shape[1] - step], most[:, step:])
            most, have = longer, have + step
        sel[most[:, :BLOCK_IDS] <= b] = s
    flat = sel.ravel()
    size = COUNTS[flat].tolist()
    at, first_word = [], []
    for k in range(blocks):
        first_word.append(len(at))
        i, end = k * BLOCK_IDS, min(n, (k + 1) * BLOCK_IDS)
        while i < end:
            at.append(i)
            i += size[i]
    first_word.append(len(at))
    at = np.array(at, dtype=np.int64)
    chosen = flat[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        c, b = SELECTORS[s]
        own = np.flatnonzero(chosen == s)
        if len(own):
            shifts = np.arange(c, dtype=np.uint64) * np.uint64(b)
            words[own] |= np.bitwise_or.reduce(x[at[own][:, None] + np.arange(c)] << shifts, axis=1)
    exceptions = x[at[chosen == 0]]
    head = np.array([n, blocks, len(words), len(exceptions)], dtype="<u4")
    return b"".join((MAGIC, head.tobytes(), np.array(first_word, dtype="<u4").tobytes(), words.astype("<u8").tobytes(), exceptions.astype("<u8").tobytes()))


def unpack(payload: bytes, block: int | None = None) -> np.ndarray:
    """The values of a payload, or of one of its blocks (found by its offset)."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b payload")
    n, blocks, n_words, n_exc = (int(v) for v in np.frombuffer(payload, "<u4", 4, 4))
    first = np.frombuffer(payload, "<u4", blocks + 1, 20).astype(np.int64)
    at = 20 + 4 * (blocks + 1)
    words = np.frombuffer(payload, "<u8", n_words, at)
    exceptions = np.frombuffer(payload, "<u8", n_exc, at + 8 * n_words)
    if block is not None:
        skipped = int((words[:first[block]] >> np.uint64(60) == 0).sum())
        words, exceptions = words[first[block]:first[block + 1]], exceptions[skipped:]
        n = min(BLOCK_IDS, n - block * BLOCK_IDS)
    sel = (words >> np.uint64(60)).astype(np.int64)
    start = np.cumsum(COUNTS[sel]) - COUNTS[sel]
    out = np.zeros(n, dtype=np.uint64)
    for s in range(2, 16):
        c, b = SELECTORS[s]
        own = np.flatnonzero(sel == s)
        if len(own):
            shifts = np.arange(c, dtype=np.uint64) * np.uint64(b)
            out[start[own][:, None] + np.arange(c)] = (words[own][:, None] >> shifts) & np.uint64((1 << b) - 1)
    own = start[sel == 0]
    out[own] = exceptions[:len(own)]
    return out


class Splitter:
    """Matches of the byte-level pattern (public_tokenizers.PATTERN) in many texts at
    once: letters, digits, spaces and other signs form runs; a single blank joins
    the run behind it, white space keeps its last sign apart from a run behind it,
    and 's 't 're 've 'm 'll 'd stand alone."""

    SPACE, LETTER, DIGIT, OTHER = range(4)

    def __init__(self):
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.kind = np.full(0x110000, self.OTHER, dtype=np.uint8)
        for kind, pattern in ((self.SPACE, r"\s"), (self.LETTER, r"\p{L}"), (self.DIGIT, r"\p{N}")):
            found = "".join(regex.findall(pattern + "+", every))
            self.kind[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind

    def kinds(self, data: np.ndarray) -> np.ndarray:
        """Kind of the character that each byte belongs to."""
        out = self.kind[:256][data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            first = data[lead]
            size = 2 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
            cp = (first & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))).astype(np.int64)
            for k in range(1, 4):
                more = size > k
                cp[more] = cp[more] << 6 | (data[lead[more] + k] & 0x3F)
            kind = self.kind[cp]
            out[lead] = kind
            for k in range(1, 4):
                more = size > k
                out[lead[more] + k] = kind[more]
        return out

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First byte of every match."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        kind = self.kinds(data)
        head = np.zeros(n, bool)  # first bytes of texts
        head[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        run = head.copy()
        run[1:] |= kind[1:] != kind[:-1]
        out = run.copy()
        # a run behind a blank starts with it; behind other white space, its last sign stands alone
        behind = np.flatnonzero(run & ~head & (kind != self.SPACE))
        behind = behind[kind[behind - 1] == self.SPACE]
        out[behind[data[behind - 1] == 0x20]] = False
        last = behind - 1
        for _ in range(3):
            last = last - ((data[last] & 0xC0) == 0x80)
        out[last] = True
        # contractions
        q = np.flatnonzero((data == 0x27) & run)
        q = q[q + 1 < n]
        q = q[out[q] & run[q + 1] & ~head[q + 1] & (kind[q + 1] == self.LETTER)]
        if len(q):
            a = data[q + 1]
            inside = q + 2 < n
            b = np.where(inside, data[np.minimum(q + 2, n - 1)], 0)
            b[inside & head[np.minimum(q + 2, n - 1)]] = 0
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            one = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
            out[q[one | two] + 1] = False
            for mask, size in ((one, 1), (two & ~one, 2)):
                nxt = q[mask] + 1 + size
                nxt = nxt[nxt < n]
                nxt = nxt[~run[nxt]]  # the letters behind the contraction
                out[nxt] = True
        return np.flatnonzero(out)


class TokenIds:
    """Ids of texts by the tokenizers library, each distinct match encoded once.

    Byte-level merges never cross a match of the pattern, so the ids of a text
    are those of its matches in order. Known matches are kept by a 64-bit hash
    and their length, in sorted arrays; they are forgotten at `limit` entries."""

    _made: dict = {}

    def __init__(self, path: str, limit: int = 2_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.library.get_vocab()
        # a byte-level token has one sign for each byte
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.split, self.limit = Splitter(), limit
        self._clear()

    def _clear(self):
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.main, self.recent = none, none  # (sorted hashes, place of the ids, number of ids)

    @classmethod
    def get(cls, path: str) -> "TokenIds":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _learn(self, h: np.ndarray, new: list[str], n_bytes: np.ndarray):
        size = np.zeros(len(new), np.int32)
        groups = [new[i:i + 256] for i in range(0, len(new), 256)]
        codes = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)]
        for g, c in enumerate(codes):  # a match ends where the bytes of its ids do
            ends = np.searchsorted(np.cumsum(self.bytes_of[c]), np.cumsum(n_bytes[256 * g:256 * g + 256])) + 1
            size[256 * g:256 * g + 256] = np.diff(ends, prepend=0)
        flat = np.concatenate(codes)
        if len(flat) != size.sum():
            raise ValueError("the ids of a match do not end with its bytes")
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used:self.used + len(flat)] = flat
        place = self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.recent = self._merged(self.recent, (h, place, size))
        if len(self.recent[0]) > 1 << 17:
            self.main = self._merged(self.main, self.recent)
            self.recent = tuple(x[:0] for x in self.recent)

    @staticmethod
    def _merged(a, b):
        o = np.argsort(np.concatenate((a[0], b[0])), kind="stable")
        return tuple(np.concatenate((x, y))[o] for x, y in zip(a, b))

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, place, size) of sorted hashes."""
        known, place, size = np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        for keys, p, n in (self.main, self.recent):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                known |= hit
                place[hit], size[hit] = p[at[hit]], n[at[hit]]
        return known, place, size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        if len(self.main[0]) > self.limit:
            self._clear()
        start = self.split.starts(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        end = np.append(start[1:], len(data))
        h, inverse = np.unique(C.run_hashes(data, start, end), return_inverse=True)
        sample = np.empty(len(h), np.int64)
        sample[inverse] = np.arange(len(start))
        known, place, size = self._find(h)
        if not known.all():
            new = np.flatnonzero(~known)
            a, b = start[sample[new]], end[sample[new]]
            raw = data.tobytes()
            self._learn(h[new], [raw[x:y].decode() for x, y in zip(a.tolist(), b.tolist())], b - a)
            known, place, size = self._find(h)
        n = size[inverse]
        total = np.concatenate(([0], np.cumsum(n)))
        return self.ids[C.ragged(place[inverse], n)], np.diff(total[np.searchsorted(start, offsets)])


ROWS = "_part int, _group int, _first long, _ord array<long>, _ids array<long>, _seg array<int>, _n array<int>, _words binary"


def write_token_file(docs: DataFrame, out: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the ids to `out` in ascending id order."""
    def go(batches):
        coder, part = TokenIds.get(path), TaskContext.get().partitionId()
        group, first, ordinal = 0, 0, 0
        held, meta = [], []  # ids and (ordinal, id, segment, n) of the open group
        size = 0

        def close():
            nonlocal group, first, held, meta, size
            row = {"_part": part, "_group": group, "_first": first, "_ord": [m[0] for m in meta], "_ids": [m[1] for m in meta],
                   "_seg": [m[2] for m in meta], "_n": [m[3] for m in meta], "_words": pack(np.concatenate(held))}
            group, first, held, meta, size = group + 1, first + size, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            keys, (data, off) = b.column(0).to_pylist(), C.text_buffers(b.column(1))
            for lo, hi in C.chunks(off):
                flat, number = coder.encode(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                at = 0
                for i, n in zip(keys[lo:hi], number.tolist()):
                    codes, at = np.append(flat[at:at + n], np.uint32(end_id)), at + n
                    seg = 0
                    while len(codes):
                        take = codes[:GROUP_IDS - size]
                        held.append(take)
                        meta.append((ordinal, i, seg, len(take)))
                        size, codes, seg = size + len(take), codes[len(take):], seg + 1
                        if size == GROUP_IDS:
                            yield close()
                    ordinal += 1
        if size:
            yield close()

    schema = pa.schema([("_part", pa.int32()), ("_group", pa.int32()), ("_first", pa.int64()), ("_ord", pa.list_(pa.int64())),
                        ("_ids", pa.list_(pa.int64())), ("_seg", pa.list_(pa.int32())), ("_n", pa.list_(pa.int32())), ("_words", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, "_id").sortWithinPartitions("_id", "_text").mapInArrow(go, ROWS).write.parquet(out)


def crc32_join(a: int, b: int, n: int) -> int:
    """CRC-32 of two byte strings in a row from the CRCs of each and the second's length."""
    def times(m, v):
        s, i = 0, 0
        while v:
            if v & 1:
                s ^= m[i]
            v >>= 1
            i += 1
        return s

    zero_bit = [0xEDB88320] + [1 << i for i in range(31)]  # effect of one zero bit
    m = zero_bit
    for _ in range(3):
        m = [times(m, v) for v in m]  # of one zero byte
    while n:
        if n & 1:
            a = times(m, a)
        n >>= 1
        if n:
            m = [times(m, v) for v in m]
    return a ^ b


SEGMENTS = "_part int, _ord long, doc_id long, _seg int, _at long, _n long, _crc long"


def read_token_file(spark, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the file."""
    files = spark.read.parquet(out)
    totals = [(r["_part"], r["_t"]) for r in files.groupBy("_part").agg(
        F.sum(F.aggregate("_n", F.lit(0).cast("long"), lambda s, v: s + v)).alias("_t")).collect()]  # one row per part
    offsets, before = [], 0
    for part, t in sorted(totals):
        offsets.append((part, before))
        before += t

    def go(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["_words"]).astype("<u4")
                at, rows = 0, []
                for o, i, s, n in zip(r["_ord"], r["_ids"], r["_seg"], r["_n"]):
                    rows.append((r["_part"], o, i, s, r["_first"] + at, n, zlib.crc32(ids[at:at + n].tobytes())))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["_part", "_ord", "doc_id", "_seg", "_at", "_n", "_crc"])

    def joined(batches):
        for b in batches:
            crc = []
            for segs in b.column(3).to_pylist():
                c = segs[0]["_crc"]
                for s in segs[1:]:
                    c = crc32_join(c, s["_crc"], 4 * s["_n"])
                crc.append(c)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    segs = files.mapInArrow(go, SEGMENTS)
    docs = segs.groupBy("_part", "_ord").agg(
        F.first("doc_id").alias("doc_id"), F.min("_at").alias("_at"), F.sum("_n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("_seg", "_n", "_crc"))).alias("_segs"))
    parts = spark.createDataFrame(offsets, "_part int, _before long")
    rows = docs.join(parts, "_part").select("doc_id", (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "_segs")
    return rows.mapInArrow(joined, "doc_id long, start long, n_tokens long, ids_crc32 long")

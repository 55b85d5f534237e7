"""Quality rules with n-gram perplexity (operator 7).

A model of byte 6-grams with modified Kneser-Ney smoothing is counted by Spark over
every document. Bytes are taken as they are (no classes), the whole gram is its key (no
hashing) and the number of grams has no ceiling: counts, lower orders, discounts and
probabilities are tables, grouped and joined by Spark. Tasks look them up in sorted files of
about PART_ROWS grams that the tasks of an executor share. A document is scored by what the others have: a gram that
occurs in it alone counts as unseen, or long grams would know every text by heart.
A document's perplexity is held against a lower and an upper bound of its language; documents
outside are rejected. Plain counters (words, symbols, repeated lines and windows) come out of
the same pass as the score.

Six bytes reach over word borders and span three letters of two-byte scripts. A model of
words would have to move more than the text itself (README).

Cases: a null or empty text has no words, so it fails the base rule; a null
language is a language of its own; null and repeated ids are scored row by
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

ORDER = 4
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BAND = 6.0          # half-width of the perplexity band, in robust standard deviations
NOISE_WORDS = 100   # words over which the noise of a short text equals the spread between texts
MIN_SPREAD = 0.15   # least spread of a band in nats a word, about half of what clean texts of a language show: near copies narrow it no further
PRIOR_ROWS = 20     # distinct texts of a language that weigh as much in its band as all languages together
WINDOW = 5
SYMBOLS = b"#*$%&|<>"


# --- a small model over 64 classes, whole in one process: a plain one to compare with, no part of the operator ---
def _classes() -> np.ndarray:
    """Byte -> one of 64 classes (0 is the start of a text). Fixed by rule: lower-case
    letters apart, capitals together, digits together, common marks apart, UTF-8
    lead and continuation bytes by their low bits."""
    t = np.zeros(256, dtype=np.uint32)
    t[:] = 1
    for i, c in enumerate(range(ord("a"), ord("z") + 1)):
        t[c] = 2 + i
    t[ord("A"):ord("Z") + 1] = 28
    t[ord("0"):ord("9") + 1] = 29
    for i, c in enumerate(b" \n.,!?-'\"#*$%&|<>"):
        t[c] = 30 + i
    t[0x80:0xC0] = 48 + (np.arange(0x40) & 7)
    t[0xC0:0x100] = 56 + (np.arange(0x40) & 7)
    return t


CLASSES = _classes()


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed gram of classes ending at each byte, row of each byte)."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    c = CLASSES[data]
    key = c.copy()
    for k in range(1, ORDER):
        if len(c) > k:
            key[k:] |= np.where(row[k:] == row[:-k], c[:-k], 0).astype(np.uint32) << np.uint32(6 * k)
    return key, row


def _discount_of(few: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3+ (index 0 unused) from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(x) for x in few)
    if min(n1, n2, n3, n4) == 0:
        return np.array([0, 0.5, 0.75, 0.9])  # too little data for the estimate
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.99, 1.99, 2.99])


def _discounts(c: np.ndarray) -> np.ndarray:
    return _discount_of([(c == i).sum() for i in (1, 2, 3, 4)])


class Model:
    """Sorted packed grams of each order with log probability, and log back-off
    weight of each context. Built from the counted grams of the highest order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        k, c = keys[order].astype(np.int64), counts[order].astype(np.float64)
        levels = [(k, c)]
        for n in range(ORDER - 1, 0, -1):  # continuation counts of the lower orders
            k, c = np.unique(levels[-1][0] & ((1 << (6 * n)) - 1), return_counts=True)
            levels.append((k, c.astype(np.float64)))
        self.keys, self.logp, self.back = [], [], []
        prob = None
        for n, (k, c) in enumerate(reversed(levels), start=1):
            d = _discounts(c)[np.minimum(c, 3).astype(int)]
            ctx, inv = np.unique(k >> 6, return_inverse=True)
            tot = np.bincount(inv, weights=c)
            gamma = np.bincount(inv, weights=d) / tot
            lower = np.full(len(k), 1 / 64) if n == 1 else prob[np.searchsorted(self.keys[-1], k & ((1 << (6 * (n - 1))) - 1))]
            prob = (c - d) / tot[inv] + gamma[inv] * lower
            self.keys.append(k)
            self.logp.append(np.log(prob).astype(np.float32))
            self.back.append((ctx, np.log(gamma).astype(np.float32)))

    def lookup(self, k: np.ndarray) -> np.ndarray:
        """Log probability of each packed gram; an unseen one backs off."""
        out = np.zeros(len(k), dtype=np.float64)
        todo = np.arange(len(k))
        k = k.astype(np.int64)
        for n in range(ORDER, 0, -1):
            sub = k[todo] & ((1 << (6 * n)) - 1)
            at = np.searchsorted(self.keys[n - 1], sub)
            at[at == len(self.keys[n - 1])] = 0
            hit = self.keys[n - 1][at] == sub if len(self.keys[n - 1]) else np.zeros(len(sub), bool)
            out[todo[hit]] += self.logp[n - 1][at[hit]]
            todo, sub = todo[~hit], sub[~hit]
            if not len(todo):
                return out
            ctx, g = self.back[n - 1]
            at = np.minimum(np.searchsorted(ctx, sub >> 6), len(ctx) - 1)
            same = ctx[at] == sub >> 6
            out[todo[same]] += g[at[same]]
        out[todo] += np.log(1 / 64)
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sum of log probabilities per row."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(n)
        key, row = grams(data, offsets)
        both = np.sort(key.astype(np.uint64) << np.uint64(32) | row.astype(np.uint64))
        head = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        num = np.diff(np.append(head, len(both)))
        both = both[head]
        k = (both >> np.uint64(32)).astype(np.int64)
        new = np.concatenate(([True], k[1:] != k[:-1]))
        lp = self.lookup(k[new])[np.cumsum(new) - 1]
        return np.bincount((both & np.uint64(0xFFFFFFFF)).astype(np.int64), weights=lp * num, minlength=n)


# --- the model of the operator -------------------------------------------------------------------
DEPTH = 6              # bytes of a gram
START = 0xFF           # stands before a text; no byte of UTF-8
PART_ROWS = 1 << 22    # grams of a file of the model (20 bytes each)
PIECE_BYTES = 1 << 17  # of text handled at once: some arrays hold eight bytes for each
ROW_BITS = 64 - 8 * DEPTH  # a gram and the row it stands in are sorted as one number


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the DEPTH bytes ending at each byte as a number, row of each byte)."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    c = data.astype(np.uint64)
    key = c.copy()
    for k in range(1, DEPTH):
        key[:k] |= np.uint64(START) << np.uint64(8 * k)
        if len(c) > k:
            key[k:] |= np.where(row[k:] == row[:-k], c[:-k], np.uint64(START)) << np.uint64(8 * k)
    return key, row


MERGE_AT = 1 << 18  # counted grams that wait to be merged into a task's sorted table
FLUSH_AT = 1 << 18  # grams of such a table at which Spark takes it over


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams of all parts with the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    total = np.zeros(len(keys), dtype=np.int64)
    np.add.at(total, at, np.concatenate([n for _, n in parts]))
    return keys, total


def _count_batches(batches, grams_of=grams):
    """Counts of a task as sorted arrays, by the grams that occur and not all that may. Spark sums them; a table that
    has grown goes to it early, so that the worker's memory is bounded."""
    parts, waiting = [], 0
    for b in batches:
        data, off = C.text_buffers(b.column(0))
        for lo, hi in C.chunks(off, PIECE_BYTES):
            d = data[off[lo]:off[hi]]
            if not len(d):
                continue
            k, n = np.unique(grams_of(d, off[lo:hi + 1] - off[lo])[0], return_counts=True)
            parts.append((k, n))
            waiting += len(k)
            if waiting >= MERGE_AT:
                parts, waiting = [_merged(parts)], 0
                if len(parts[0][0]) >= FLUSH_AT:
                    yield from _count_rows(*parts.pop())
    if parts:
        yield from _count_rows(*_merged(parts))


def _count_rows(k: np.ndarray, n: np.ndarray):
    for a in range(0, len(k), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(k[a:a + (1 << 16)].astype(np.int64)), pa.array(n[a:a + (1 << 16)])], ["gram", "n"])


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over all texts: combined per task, then summed by gram."""
    part = docs.select(F.col(text_col).cast("string")).mapInArrow(lambda batches: _count_batches(batches, byte_grams), "gram long, n long")
    return part.groupBy("gram").agg(F.sum("n").alias("n"))


def _contexts(rows: DataFrame, d: np.ndarray) -> DataFrame:
    """(gram, left, followed) of the contexts of counted grams: the mass that discounts leave to lower orders, and how
    often the context was followed. A context has at most 256 followers, so no key of these shuffles is large."""
    times = [F.sum((F.col("n") == i).cast("long")) for i in (1, 2)]
    more = F.sum((F.col("n") > 2).cast("long"))
    return (rows.groupBy(F.shiftright("gram", 8).alias("gram"))
            .agg(F.sum("n").alias("total"), ((d[1] * times[0] + d[2] * times[1] + d[3] * more) / F.sum("n")).alias("left"), F.sum("raw").alias("followed")))


def _probabilities(rows: DataFrame, contexts: DataFrame, lower: DataFrame | None, size: int, d: np.ndarray) -> DataFrame:
    """(gram, raw, p): interpolated modified Kneser-Ney probability of the last byte of each gram behind the others."""
    own = F.when(F.col("n") == 1, F.lit(d[1])).when(F.col("n") == 2, F.lit(d[2])).otherwise(F.lit(d[3]))
    at = (rows.withColumn("_ctx", F.shiftright("gram", 8)).join(contexts.select(F.col("gram").alias("_ctx"), "total", "left"), "_ctx")
          .select("gram", "raw", ((F.col("n") - own) / F.col("total")).alias("_own"), "left"))
    if lower is None:
        return at.select("gram", "raw", (F.col("_own") + F.col("left") / 256).alias("p"))
    at = at.withColumn("_low", F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1)))
    return (at.join(lower.select(F.col("gram").alias("_low"), F.col("p").alias("_lower")), "_low")
            .select("gram", "raw", (F.col("_own") + F.col("left") * F.col("_lower")).alias("p")))


def tables(counted: DataFrame) -> tuple[list[DataFrame], float]:
    """For 1 to DEPTH bytes (gram, raw, logp, back): how often a gram occurs, the log probability of its last byte
    and, as a context, the logarithm of what it leaves to lower orders; and that of the empty context. The counts `n` of
    lower orders are the numbers of different bytes before a gram. The discounts of an order come from four sums."""
    levels = [counted.withColumn("raw", F.col("n"))]
    for size in range(DEPTH - 1, 0, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1))
        levels.append(C.stored(levels[-1].groupBy(low.alias("gram")).agg(F.count(F.lit(1)).alias("n"), F.sum("raw").alias("raw")), "grams"))
    known, context, empty = [], [], 0.0
    for size, rows in enumerate(reversed(levels), start=1):
        few = rows.agg(*[F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)]).first()
        d = _discount_of([x or 0 for x in few])
        context.append(C.stored(_contexts(rows, d), "contexts"))
        known.append(C.stored(_probabilities(rows, context[-1], known[-1] if known else None, size, d), "probabilities"))
        if size == 1:
            left = context[0].first()
            empty = float(np.log(left["left"])) if left else 0.0
    out = []
    for size in range(DEPTH):
        rows = known[size].select("gram", "raw", F.log("p").cast("float").alias("logp"))
        if size + 1 < DEPTH:  # the context before a text ends at no byte: it has no probability
            rows = (rows.join(context[size + 1].select("gram", F.log("left").cast("float").alias("back"), "followed"), "gram", "full")
                    .select("gram", F.coalesce("raw", "followed").alias("raw"), F.coalesce("logp", F.lit(0)).cast("float").alias("logp"),
                            F.coalesce("back", F.lit(0)).cast("float").alias("back")))
        else:
            rows = rows.withColumn("back", F.lit(0).cast("float"))
        out.append(rows.withColumn("raw", F.least("raw", F.lit((1 << 31) - 1)).cast("int")))
    return out, empty


class Parts:
    """The grams of each size in parts by remainder: files that Spark brings to every executor once, mapped and not
    loaded by its tasks, which share their pages.

    A text does not speak for itself: a gram that occurs nowhere else counts as unseen, as does a context, and the
    text is scored by the longest gram that others have, behind the mass that longer contexts of others leave.
    """

    COLUMNS = (("gram", np.int64), ("raw", np.int32), ("logp", np.float32), ("back", np.float32))

    def __init__(self, spark, levels: list[DataFrame], empty: float):
        self.empty, self.shared = empty, []
        for table in levels:
            table = C.stored(table, "model")
            n = -(-table.count() // PART_ROWS) | 1  # odd: the remainder takes part of every byte
            self.shared.append([self._send(spark, table.where(F.pmod("gram", F.lit(n)) == i)) for i in range(n)])

    @staticmethod
    def _send(spark, part: DataFrame) -> tuple[str, int]:
        """Name and length of a part, which goes through the driver alone."""
        rows = part.toArrow()
        order = np.argsort(rows.column("gram").to_numpy())
        path = os.path.join(tempfile.mkdtemp(prefix="grams-"), f"grams-{uuid.uuid4().hex}")
        with open(path, "wb") as f:
            for name, kind in Parts.COLUMNS:
                rows.column(name).to_numpy()[order].astype(kind).tofile(f)
        spark.sparkContext.addFile(path)
        return os.path.basename(path), len(order)

    @staticmethod
    def _columns(name: str, length: int) -> list[np.ndarray]:
        path, at, out = SparkFiles.get(name), 0, []
        for _, kind in Parts.COLUMNS:
            out.append(np.asarray(np.memmap(path, kind, "r", at, (length,))) if length else np.zeros(0, kind))
            at += length * np.dtype(kind).itemsize
        return out

    @property
    def parts(self) -> int:
        return max(len(x) for x in self.shared)

    def _look_up(self, size: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(raw, logp, back) of sorted grams of a size; a gram that was not counted is an error."""
        shared = self.shared[size - 1]
        out = np.zeros(len(wanted), np.int64), np.zeros(len(wanted)), np.zeros(len(wanted))
        for i, part in enumerate(shared):
            keys, *values = self._columns(*part)
            here = np.flatnonzero(wanted % np.uint64(len(shared)) == np.uint64(i)) if len(shared) > 1 else slice(None)
            mine = wanted[here].astype(np.int64)
            at = np.searchsorted(keys, mine)
            if len(mine) and (at[-1] == len(keys) or (keys[at] != mine).any()):
                raise ValueError("a text that was not counted is scored")
            for to, value in zip(out, values):
                to[here] = value[at]
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sum of log probabilities of each row."""
        total = np.zeros(len(offsets) - 1)
        gram, row, times = _row_grams(data, offsets)
        ctx, crow, ctimes = gram[:0], row[:0], times[:0]  # contexts of grams that others do not have
        for size in range(DEPTH, 0, -1):
            keys = np.unique(np.concatenate((gram, ctx))) if len(ctx) else _distinct(gram)
            raw, logp, back = self._look_up(size, keys)
            at = np.searchsorted(keys, ctx)
            others = raw[at] > ctimes
            _add(total, crow[others], (ctimes * back[at])[others])
            at = np.searchsorted(keys, gram)
            others = raw[at] > times
            _add(total, row[others], (times * logp[at])[others])
            gram, row, times = gram[~others], row[~others], times[~others]
            ctx, crow, ctimes = _grouped(gram >> np.uint64(8), row, times)
            gram, row, times = _grouped(gram & np.uint64((1 << 8 * (size - 1)) - 1), row, times)
        _add(total, row, times * (self.empty - np.log(256)))
        return total


def _add(total: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    total += np.bincount(row, weights=values, minlength=len(total))


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered


def _grouped(gram: np.ndarray, row: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, row, times) with each gram of a row once, by gram."""
    both, at = np.unique(gram << np.uint64(ROW_BITS) | row.astype(np.uint64), return_inverse=True)
    return both >> np.uint64(ROW_BITS), (both & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64), np.bincount(at, weights=times, minlength=len(both)).astype(np.int64)


def _row_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_grouped` grams of DEPTH bytes."""
    key, row = byte_grams(data, offsets)
    both = np.sort(key << np.uint64(ROW_BITS) | row.astype(np.uint64))
    head = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    times = np.diff(np.append(head, len(both)))
    both = both[head]
    return both >> np.uint64(ROW_BITS), (both & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64), times


def fit(docs: DataFrame, text_col: str = "text") -> Parts:
    """Model over all documents."""
    counted = C.stored(count_grams(docs, text_col), "grams")
    return Parts(docs.sparkSession, *tables(counted))


def counters(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counters of each row."""
    n = len(offsets) - 1
    w = C.Words(data, offsets)
    per_row = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
    chars = ~C.SPACE[data] & ((data & 0xC0) != 0x80)
    sym = np.zeros(256, bool)
    sym[list(SYMBOLS)] = True
    # lines: runs between line feeds that hold a word
    newline = np.zeros(256, bool)
    newline[10] = True
    ln = C.Words(data, offsets, newline)
    full = np.searchsorted(w.start, ln.end) > np.searchsorted(w.start, ln.start)
    # a row's repeats: its lines less its distinct lines
    lines = np.bincount(ln.row[full], minlength=n)
    r, h = ln.row[full], ln.hashes()[full]
    o = np.lexsort((h, r))
    first = np.ones(len(o), bool)
    first[1:] = (r[o][1:] != r[o][:-1]) | (h[o][1:] != h[o][:-1])
    dup_lines = lines - np.bincount(r[o][first], minlength=n)
    # words inside a 5-word window that its text holds twice or more
    at, win = C.window_hashes(w.hashes(), w.row, WINDOW)
    key = C.mix(win ^ C.mix(w.row[at].astype(np.uint64) + np.uint64(1)))
    o = np.argsort(key)
    s = key[o]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    again = at[o[same[1:] | same[:-1]]]
    step = np.bincount(again, minlength=len(w.start) + 1) - np.bincount(again + WINDOW, minlength=len(w.start) + 1)[:len(w.start) + 1]
    covered = np.cumsum(step)[:len(w.start)] > 0
    repeat = np.bincount(w.row[covered], minlength=n) if len(w.start) else np.zeros(n, np.int64)
    return {"n_words": w.count, "word_chars": per_row(chars), "n_symbols": per_row(sym[data]),
            "n_dup_lines": dup_lines, "n_repeat_words": repeat}


COUNTERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _pieces(offsets: np.ndarray):
    """`C.chunks` of no more rows than a row number has bits for."""
    for lo, hi in C.chunks(offsets, PIECE_BYTES):
        for a in range(lo, hi, 1 << ROW_BITS):
            yield a, min(hi, a + (1 << ROW_BITS))


def annotate(docs: DataFrame, model: Parts, text_col: str = "text") -> DataFrame:
    """All columns of `docs` plus `_q_<counter>` and `_q_logp` (summed log probability)."""
    at = docs.columns.index(text_col)
    names = docs.columns + [f"_q_{c}" for c in COUNTERS] + ["_q_logp"]
    schema = T.StructType(docs.schema.fields + [T.StructField(f"_q_{c}", T.LongType()) for c in COUNTERS]
                          + [T.StructField("_q_logp", T.DoubleType())])

    def go(batches):
        for b in batches:
            data, off = C.text_buffers(b.column(at))
            for lo, hi in _pieces(off):
                d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                c = counters(d, o)
                part = b.slice(lo, hi - lo)
                cols = [part.column(i) for i in range(part.num_columns)]
                cols += [pa.array(c[k].astype(np.int64)) for k in COUNTERS] + [pa.array(model.score(d, o))]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(go, schema)


def base_failed() -> F.Column:
    return (F.col("_q_n_words") < MIN_WORDS) | (100 * F.col("_q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q_n_words"))


def _cost() -> F.Column:
    """Mean negative log probability per word: the logarithm of the perplexity."""
    return -F.col("_q_logp") / F.greatest(F.col("_q_n_words"), F.lit(1))


def distinct_costs(scored: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(_b_lang, _b_cost) of every distinct text of a language that passes the base
    rules: copies count once, so no copy group can hold the quartiles. Texts are told
    apart by 64-bit hash (a collision costs the quartiles one row)."""
    return (scored.where(~base_failed()).groupBy(F.col(lang_col).alias("_b_lang"), F.xxhash64(text_col).alias("_b_text"))
            .agg(F.min(_cost()).alias("_b_cost")).select("_b_lang", "_b_cost"))


def perplexity_bands(costs: DataFrame) -> DataFrame:
    """(lang, mid, spread) over `distinct_costs`: median of the log perplexity and its
    interquartile range as a standard deviation, MIN_SPREAD at least. A language of n
    texts counts n parts, all languages together PRIOR_ROWS: each language has a band,
    and no verdict jumps when it reaches some size."""
    q = F.percentile_approx("_b_cost", [0.25, 0.5, 0.75], 2000)
    low, mid, high = costs.agg(q.alias("_q")).first()["_q"] or (0.0, 0.0, 0.0)
    own = F.col("_b_rows") / (F.col("_b_rows") + PRIOR_ROWS)
    spread = own * (F.col("_q")[2] - F.col("_q")[0]) + (1 - own) * F.lit(high - low)
    return (costs.groupBy("_b_lang").agg(q.alias("_q"), F.count(F.lit(1)).alias("_b_rows"))
            .select("_b_lang", (own * F.col("_q")[1] + (1 - own) * F.lit(mid)).alias("_b_mid"),
                    F.greatest(spread / 1.349, F.lit(MIN_SPREAD)).alias("_b_spread")))


def with_verdict(scored: DataFrame, bands: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Adds `_q_base_failed` and `_q_kept`. The band of a document of n words is
    mid -+ BAND * spread * sqrt(1 + NOISE_WORDS / n): the mean over few words varies more."""
    half = BAND * F.col("_b_spread") * F.sqrt(1 + NOISE_WORDS / F.greatest(F.col("_q_n_words"), F.lit(1)))
    inside = F.coalesce(F.abs(_cost() - F.col("_b_mid")) <= half, F.lit(False))  # only a language without a text that passes has no band
    return (scored.join(bands, F.col(lang_col).eqNullSafe(F.col("_b_lang")), "left")
            .withColumn("_q_base_failed", base_failed()).withColumn("_q_kept", ~F.col("_q_base_failed") & inside)
            .drop("_b_lang", "_b_mid", "_b_spread"))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All columns of `docs` plus `_q_*` counters, `_q_base_failed` and `_q_kept`.

    Three passes: count the grams, score narrow rows for the bands (written to
    the shared folder), score and judge the whole rows. No row is shuffled with
    its text; the bands are joined by size statistics of a stored table.
    """
    model = fit(docs, text_col)
    narrow = annotate(docs.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text")), model, "_text")
    costs = C.stored(distinct_costs(narrow, "_lang", "_text"), "costs")
    bands = C.stored(perplexity_bands(costs), "bands")
    return with_verdict(annotate(docs, model, text_col), bands, lang_col)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: counters, log perplexity per word, base_failed, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    return judge(rows).select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in COUNTERS],
                              _cost().alias("log_perplexity"), F.col("_q_base_failed").alias("base_failed"),
                              F.col("_q_kept").alias("kept"))


def keep_clean(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, with their columns unchanged (whatever their names)."""
    return C.shielded(docs, lambda d, text, lang: judge(d, text, lang).where("_q_kept").select(*d.columns), text_col, lang_col)

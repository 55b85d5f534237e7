"""Repeated passages by prefix-partitioned window hashes (operator 8).

A window is a run of WINDOW words of one document. Every window whose word
sequence also starts anywhere else is a repeat; the words it covers go.

1. Anchors. Of the ANCHOR-word runs of each window the one with the smallest
   hash is its anchor (equal windows have equal anchors, about 8 % of all
   positions are one). A window whose anchor is found once is no repeat, so only
   the documents with an anchor that is found again go on, and of these only the
   suffixes whose own anchor is found again.
2. Groups. A suffix goes to the group of its prefix. Prefixes have variable
   length: of 8 words, or of 16, 24 or all 35 where the shorter prefix starts so
   many suffixes that its group would outgrow a task.
3. Windows. A group's suffixes are sorted by (prefix hash, hash of all 35 words)
   and each is compared with its neighbour: equal ones are places of a repeat.
   No tree is built: there is no order of words, no common prefix and no node
   deeper than 35, which the removal does not ask for. Nothing of a group is held
   but the last row.
4. Runs of places join to the maximal repeats of each document.

Equal suffixes of one chunk of text meet before the shuffle: they are known
repeats at once and only one of them goes on, as a mark for the other chunks.
So a passage held by a third of all documents costs one row per chunk.
Of texts with equal words only one goes through the groups.
Words are compared by 64-bit hashes, windows by two of them.

Cases: a null or empty text has no words and keeps none; a text under 35 words
has no window; null or repeated ids are separate documents with one row each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 35
ANCHOR = 12
PREFIXES = (8, 16, 24)
GROUP_ROWS = 50_000      # suffixes of one prefix from which a longer prefix is taken
SALTS = 32               # parts into which the copies of one text are dealt
LOCAL_ROWS = 8           # occurrences in one chunk from which a prefix is reported

_LABEL = 0x51ED270B27


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def own_anchors(h: np.ndarray, row: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each window, word position of its anchor, hashes by position); the
    leftmost of equal minima."""
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, np.zeros(0, np.uint64)
    at, g = C.window_hashes(h, row, ANCHOR)
    full = np.full(len(h) - ANCHOR + 1, np.uint64(2**64 - 1))
    full[at] = g
    place = np.arange(len(full), dtype=np.uint64)
    low = _sliding_min(full >> np.uint64(30) << np.uint64(30) | place, window - ANCHOR + 1)
    starts = np.flatnonzero(row[window - 1:] == row[:len(h) - window + 1])
    return starts, (low[starts] & np.uint64((1 << 30) - 1)).astype(np.int64), full


def anchors(h: np.ndarray, row: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the anchors of all windows."""
    _, own, full = own_anchors(h, row, window)
    own = np.unique(own)
    return own, full[own]


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each key, mask of rows whose key occurs again) within a chunk."""
    o = np.argsort(key, kind="stable")
    s = key[o]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    again = np.zeros(len(s), bool)
    again[:-1] |= ~new[1:]
    again |= ~new
    first, known = np.zeros(len(s), bool), np.zeros(len(s), bool)
    first[o], known[o] = new, again
    return first, known


def _chunks(batch, key: int, text: int):
    """(keys, words, hashes) of each chunk of a batch."""
    data, off = C.text_buffers(batch.column(text))
    for lo, hi in C.chunks(off):
        w = C.Words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        yield batch.column(key).slice(lo, hi - lo).to_numpy(), w, w.hashes(), lo, hi


def _table(names: str, arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names.split())


def anchor_rows(texts: DataFrame, known: bool, window: int) -> DataFrame:
    """known: (_k, _pos) of anchors found again in their own chunk; else the rows
    (_fp, _k, _pos) that must be held against other chunks, _pos -1 for a mark."""
    def go(batches):
        for b in batches:
            for ids, w, h, _, _ in _chunks(b, 0, 1):
                at, fp = anchors(h, w.row, window)
                first, again = _split(fp)
                k, pos = ids[w.row[at]], (at - w.first[w.row[at]]).astype(np.int32)
                if known:
                    yield _table("_k _pos", (k[again], pos[again]))
                else:
                    yield _table("_fp _k _pos", (fp[first].view(np.int64), k[first], np.where(again, np.int32(-1), pos)[first].astype(np.int32)))
    return texts.select("_k", "_text").mapInArrow(go, "_k long, _pos int" if known else "_fp long, _k long, _pos int")


def _by_text(k: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """(_k, _starts): positions as one packed list per document."""
    o = np.lexsort((pos, k))
    k, pos = k[o], pos[o].astype("<i4")
    head = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
    end = np.append(head[1:], len(k))
    return pa.RecordBatch.from_arrays([pa.array(k[head]), pa.array([pos[x:y].tobytes() for x, y in zip(head, end)], pa.binary())], ["_k", "_starts"])


def found_again(rows: DataFrame, keys: list[str], packed: bool = False) -> DataFrame:
    """(_k, _pos) of the rows whose keys occur in another row, or (_k, _starts) with
    the positions of a batch packed by document: one comparison with each
    neighbour of the sorted stream."""
    width = len(keys)
    put = _by_text if packed else (lambda k, pos: _table("_k _pos", (k, pos)))

    def go(batches):
        last = None  # (keys, k, pos, already known) of the last row seen
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key = np.stack([b.column(i).to_numpy() for i in range(width)], axis=1)
            k, pos = b.column(width).to_numpy(), b.column(width + 1).to_numpy()
            same = (key[1:] == key[:-1]).all(axis=1)
            hit = np.zeros(n, bool)
            hit[1:] |= same
            hit[:-1] |= same
            if last is not None and (last[0] == key[0]).all():
                hit[0] = True
                if not last[3] and last[2] >= 0:
                    yield put(np.array([last[1]]), np.array([last[2]], np.int32))
            out = hit & (pos >= 0)
            yield put(k[out], pos[out])
            last = (key[-1], k[-1], pos[-1], hit[-1])

    ordered = rows.repartition(*keys[:1]).sortWithinPartitions(*keys).select(*keys, "_k", "_pos")
    return ordered.mapInArrow(go, "_k long, _starts binary" if packed else "_k long, _pos int")


class Suffixes:
    """Windows of a chunk whose own anchor is one of the given places, with their labels."""

    def __init__(self, w: C.Words, h: np.ndarray, places: pa.ListArray, window: int):
        count = np.diff(places.offsets.to_numpy())
        mask = np.zeros(len(h) + 1, bool)
        mask[np.repeat(w.first[:-1], count) + places.flatten().to_numpy()] = True
        starts, own, _ = own_anchors(h, w.row, window)
        self.at = starts[mask[own]]
        self.row, self.pos = w.row[self.at], (self.at - w.first[w.row[self.at]]).astype(np.int32)
        self._h, self._row, self.window = h, w.row, window
        self.label = self.hashes(window, _LABEL)

    def hashes(self, n: int, salt: int = 0) -> np.ndarray:
        """Hash of the first n words of each suffix."""
        at, x = C.window_hashes(self._h, self._row, n, salt)
        return x[np.searchsorted(at, self.at)] if len(self.at) else np.zeros(0, np.uint64)

    def prefixes(self, heavy: list[np.ndarray], lengths) -> np.ndarray:
        """Prefix hash of each suffix: of the shortest length that is not heavy."""
        out = self.hashes(lengths[0])
        for i in range(len(lengths)):
            if not len(heavy[i]):
                break
            here = self.hashes(lengths[i])
            long = np.isin(here, heavy[i])
            if not long.any():
                break
            more = self.hashes(lengths[i + 1] if i + 1 < len(lengths) else self.window)
            out = np.where(long, more, out)
        return out


def heavy_prefixes(affected: DataFrame, window: int, lengths, group_rows: int) -> list[np.ndarray]:
    """Per length the prefixes that start more than `group_rows` suffixes. A prefix is
    reported by a chunk that holds LOCAL_ROWS of it, so a heavy one has at least
    that share of a chunk's suffixes: their number is bounded whatever the input."""
    def go(batches):
        for b in batches:
            for _, w, h, lo, hi in _chunks(b, 0, 1):
                s = Suffixes(w, h, b.column(2).slice(lo, hi - lo), window)
                for i, n in enumerate(lengths):
                    k, c = np.unique(s.hashes(n), return_counts=True)
                    k, c = k[c >= LOCAL_ROWS], c[c >= LOCAL_ROWS]
                    yield _table("_len _prefix _n", (np.full(len(k), i, np.int32), k.view(np.int64), c))
    rows = affected.select("_k", "_text", "_places").mapInArrow(go, "_len int, _prefix long, _n long")
    got = rows.groupBy("_len", "_prefix").agg(F.sum("_n").alias("_n")).where(F.col("_n") > group_rows).select("_len", "_prefix").collect()
    return [np.sort(np.array([r["_prefix"] for r in got if r["_len"] == i], dtype=np.int64)).view(np.uint64) for i in range(len(lengths))]


def suffix_rows(affected: DataFrame, known: bool, heavy: list[np.ndarray], window: int, lengths) -> DataFrame:
    """known: (_k, _starts) of suffixes equal to another of their chunk; else the
    rows (_prefix, _label, _k, _pos) for the groups, _pos -1 for a mark."""
    shared = affected.sparkSession.sparkContext.broadcast(heavy)

    def go(batches):
        for b in batches:
            marks = np.array(b.column(3).to_pylist(), dtype=bool)
            for ids, w, h, lo, hi in _chunks(b, 0, 1):
                s = Suffixes(w, h, b.column(2).slice(lo, hi - lo), window)
                first, again = _split(s.label)
                mark = marks[lo:hi][s.row]  # of a text that stands for its copies: its places are settled
                if known:
                    again &= ~mark
                    cut = np.searchsorted(s.row[again], np.arange(hi - lo + 1))
                    pos = s.pos[again]
                    rows = [(int(ids[i]), pos[cut[i]:cut[i + 1]].astype("<i4").tobytes()) for i in range(hi - lo) if cut[i + 1] > cut[i]]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["_k", "_starts"])
                else:
                    prefix = s.prefixes(shared.value, lengths)[first]
                    yield _table("_prefix _label _k _pos", (prefix.view(np.int64), s.label[first].view(np.int64), ids[s.row[first]],
                                                            np.where(again | mark, np.int32(-1), s.pos)[first].astype(np.int32)))
    return affected.select("_k", "_text", "_places", "_mark").mapInArrow(
        go, "_k long, _starts binary" if known else "_prefix long, _label long, _k long, _pos int")


def summaries(texts: DataFrame, window: int) -> DataFrame:
    """(_k, _n, _all, _rep): number of words and digest of all words of each row, and
    for texts of a window or more with an equal word sequence elsewhere the smallest key of these."""
    def whole(batches):
        for b in batches:
            n, digest = [], []
            for t in b.column(1):  # the words of one text at a time
                w = (t.as_py() or "").encode().split()
                n.append(len(w))
                digest.append(hashlib.sha256(b" ".join(w)).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary())], ["_k", "_n", "_all"])

    rows = C.stored(texts.select("_k", "_text").mapInArrow(whole, "_k long, _n long, _all binary"), "summaries")
    copies = (rows.where(F.col("_n") >= window).groupBy("_all").agg(F.min("_k").alias("_rep"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
              .select("_all", "_rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))  # a text may have very many copies
    return rows.withColumn("_salt", F.pmod(F.xxhash64("_k"), F.lit(SALTS)).cast("int")).join(copies, ["_all", "_salt"], "left").select("_k", "_n", "_all", "_rep")


def repeats(texts: DataFrame, window: int = WINDOW, lengths=PREFIXES, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, documents with an anchor found again (_k, _text, _places, _mark),
    their repeats (_k, _starts): packed start words of all repeated windows).

    A text with copies is repeated as a whole: it has no row in the repeats. One
    of its copies goes on to mark the repeats of other texts."""
    lengths = tuple(n for n in lengths if n < window)
    every = C.stored(summaries(texts, window), "every")
    places = (anchor_rows(texts, True, window).unionByName(found_again(anchor_rows(texts, False, window), ["_fp"]))
              .groupBy("_k").agg(F.collect_list("_pos").alias("_places")))  # at most one per few words of a text
    places = (places.join(every.select("_k", "_rep"), "_k").where("_rep is null or _rep = _k")
              .select("_k", "_places", F.col("_rep").isNotNull().alias("_mark")))
    affected = C.stored(texts.join(places, "_k").select("_k", "_text", "_places", "_mark"), "affected")
    heavy = heavy_prefixes(affected, window, lengths, group_rows)
    leaves = found_again(suffix_rows(affected, False, heavy, window, lengths), ["_prefix", "_label"], packed=True)
    return every, affected.where("not _mark"), suffix_rows(affected, True, heavy, window, lengths).unionByName(leaves)


def _covered(n: int, packed: list[bytes], window: int) -> np.ndarray:
    s = np.frombuffer(b"".join(packed), "<i4")
    step = np.bincount(s, minlength=n + 1) - np.bincount(s + window, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, start_word, end_word) of every maximal run of repeated words."""
    texts, keys = C.keyed_texts(docs, id_col, text_col)
    every, affected, starts = repeats(texts, window)

    def go(batches):
        for b in batches:
            out = []
            for k, text, packed in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                c = _covered(len((text or "").encode().split()), packed, window).astype(np.int8)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], c, [0]))))
                out += [(k, int(x), int(y)) for x, y in zip(edge[::2], edge[1::2])]
            if out:
                yield _table("_k start_word end_word", [np.array(x, dtype=np.int64) for x in zip(*out)])
    rows = (affected.select("_k", "_text").join(starts.groupBy("_k").agg(F.collect_list("_starts").alias("_s")), "_k")
            .mapInArrow(go, "_k long, start_word long, end_word long"))
    rows = rows.unionByName(every.where("_rep is not null").select("_k", F.lit(0).cast("long").alias("start_word"), F.col("_n").alias("end_word")))
    if keys is None:
        return rows.withColumnRenamed("_k", "doc_id")
    return rows.join(keys, "_k").select(F.col("_id").alias("doc_id"), "start_word", "end_word")


def _kept(affected: DataFrame, starts: DataFrame, window: int, with_text: bool) -> DataFrame:
    """(_k, _n, _removed, _sha, _kept text or null) of the documents with a repeat."""
    def go(batches):
        for b in batches:
            out = []
            for k, text, packed in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                words = (text or "").encode().split()
                c = _covered(len(words), packed, window)
                kept = b" ".join([w for w, x in zip(words, c.tolist()) if not x])
                out.append((k, len(words), int(c.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                                 ["_k", "_n", "_removed", "_sha", "_kept"])
    packed = starts.groupBy("_k").agg(F.collect_list("_starts").alias("_s"))
    return affected.select("_k", "_text").join(packed, "_k").mapInArrow(go, "_k long, _n long, _removed long, _sha string, _kept string")


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per input row."""
    texts, keys = C.keyed_texts(docs, id_col, text_col)
    every, affected, starts = repeats(texts, window)
    cut = _kept(affected, starts, window, False).select("_k", "_removed", "_sha")
    rows = every.join(cut, "_k", "left")
    if keys is not None:
        rows = rows.join(keys, "_k")
    copy = F.col("_rep").isNotNull()
    return rows.select(F.col("_k" if keys is None else "_id").alias("doc_id"), F.col("_n").alias("n_words"),
                       F.when(copy, F.col("_n")).otherwise(F.coalesce("_removed", F.lit(0).cast("long"))).alias("n_removed"),
                       F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("_sha", F.lower(F.hex("_all")))).alias("kept_sha256"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without the words of repeated windows; the words left of a
    changed text are joined by single spaces, other texts and columns (whatever their names) stay."""
    return C.shielded(docs, lambda d, i, t: _cut_repeats(d, i, t, window), id_col, text_col)


def _cut_repeats(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    texts, keys = C.keyed_texts(docs, id_col, text_col)
    if keys is not None:  # ids that repeat or are null: number the whole rows
        numbered = C.stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        out = _cut_repeats(numbered.drop(id_col).withColumnRenamed("_row", "_rid"), "_rid", text_col, window)
        return (out.withColumnRenamed("_rid", "_row").join(numbered.select("_row", id_col), "_row").select(*docs.columns))
    every, affected, starts = repeats(texts, window)
    cut = (_kept(affected, starts, window, True).select(F.col("_k").alias("_cut"), "_kept")
           .unionByName(every.where("_rep is not null").select(F.col("_k").alias("_cut"), F.lit("").alias("_kept"))))
    return (docs.join(C.stored(cut, "cut"), F.col(id_col).cast("long") == F.col("_cut"), "left")
            .select(*[F.coalesce("_kept", F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns]))

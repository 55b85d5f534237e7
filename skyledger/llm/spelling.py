"""Spelling variants of a corpus vocabulary, found in bidirectional FM-indexes.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. The error lies in one half of the searched word, so the other half occurs in
the near word as it stands: at its start (first half) or at its end (second half).
That gives a search scheme of two searches over the text `$word$word$...$`:

  1. match `$` and the first half exactly, extend to the right over the second half
     and `$`, allowing one error;
  2. match `$` and the second half exactly, read backwards, extend to the left over the
     first half and `$`, allowing one error.

A state of a search is a pair of suffix-rank intervals of equal size, one in the index
of the text and one in that of the reversed text; an extension by a symbol narrows
the one by rank queries and moves the other by the number of smaller symbols
(wavelet matrix). A search that has matched a whole `$word$` holds one suffix; as the
words are sorted, its rank in the text is the word's number.

Halves have MIN_HALF code points at least, so the words of search 1 share their first
MIN_HALF code points with the searched word and those of search 2 their last. Words are
dealt to blocks by that start (or end): all its words are in one block, which is at the
same time the index and the queries. A start of more than BLOCK words is split into
parts, and each part is searched for each part of its words. All searches of a block
advance together, one symbol a step, as arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_LENGTH = 6         # code points of a word of the vocabulary
MIN_HALF = MIN_LENGTH // 2
MIN_COUNT = 5          # occurrences of a word of the vocabulary
FORM_RATIO = 5         # a form occurs so many times as often
BLOCK = 40_000         # words of an index
CELLS = 1 << 18        # symbols of the words searched together
COUNT_BYTES = 1 << 22  # text counted at once

# --- counting -------------------------------------------------------------------------
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
_LEAD = 0xC3  # U+00C0 to U+00FF are exactly the two-byte sequences with this first byte
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[[*range(65, 91), *range(97, 123), _LEAD]] = False


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Maximal runs `[A-Za-z\\u00C0-\\u00FF]+` with A-Z lower-cased, and the row of each."""
    low = _UPPER[data]
    kind = low.copy()
    kind[1:][data[:-1] == _LEAD] = 97  # the second byte of such a letter counts as a letter
    words = C.Words(kind, offsets, _OUTSIDE)
    length = words.end - words.start
    at = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
    text = low[~_OUTSIDE[kind]]
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(text))), words.row


def count_batch(ids: list, column, modulus: int, min_length: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of some texts. The runs of a document that its hash picks lose a code point."""
    data, offsets = C.text_buffers(column)
    for a, b in C.chunks(offsets, COUNT_BYTES):
        found, row = runs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        long = pc.greater_equal(pc.utf8_length(found), min_length).to_numpy(zero_copy_only=False)
        coded = found.filter(pa.array(long)).dictionary_encode()
        words = coded.dictionary
        if not len(words):
            continue
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pair, n = np.unique(row[long] * len(words) + code, return_counts=True)
        doc, code = np.divmod(pair, len(words))
        utf8 = words.cast(pa.large_binary()).to_pylist()
        prefix = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids[a:b]]
        h = np.fromiter((zlib.crc32(utf8[c], prefix[d]) for d, c in zip(doc.tolist(), code.tolist())), np.int64, len(code))
        hit = h % modulus == 0
        total = np.bincount(code[~hit], weights=n[~hit], minlength=len(words)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.record_batch([words.take(pa.array(some)).cast(pa.string()), pa.array(total[some])], names=["word", "n"])
        cut = []
        for c, x in zip(code[hit].tolist(), h[hit].tolist()):
            w = utf8[c].decode()
            cut.append(w[:x % len(w)] + w[x % len(w) + 1:])
        if cut:
            yield pa.record_batch([pa.array(cut, pa.string()), pa.array(n[hit].astype(np.int64))], names=["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, modulus: int = 199) -> DataFrame:
    """(word, n): distinct words of all whole texts with at least `min_length` code points and `min_count` occurrences."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from count_batch(batch.column(0).to_pylist(), batch.column(1), modulus, min_length)
    texts = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")).where(F.col(f"`{text_col}`") != "")
    counts = texts.mapInArrow(task, "word string, n long").where(F.length("word") >= min_length)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- index ----------------------------------------------------------------------------
END, DELIMITER, FIRST = 0, 1, 2  # symbols: end of the text, word delimiter, letters from here on


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the compared length."""
    n, rank, width = len(text), text.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (max(n, int(rank.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        step = np.zeros(n, np.int64)
        step[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class Wavelet:
    """Rank and smaller-symbol counts over a Burrows-Wheeler transform, one bit of the symbols a level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, (n_symbols - 1).bit_length())
        self.zeros, now = [], symbols
        for bit in range(self.bits - 1, -1, -1):
            zero = (now >> bit) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(zero))).astype(np.int32))
            now = np.concatenate((now[zero], now[~zero]))
        # where each symbol starts after the last level, to turn places there into ranks
        self.start = {int(s): int(i) for s, i in zip(*np.unique(now, return_index=True))}
        self.base = np.array([self.start.get(s, 0) for s in range(n_symbols)], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=n_symbols))))[:-1]

    def narrow(self, low: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size) of the interval of `symbol` + pattern, and how many of the rows have a smaller symbol."""
        a, b = low.copy(), low + size
        smaller = np.zeros(len(a), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            za, zb = zeros[a].astype(np.int64), zeros[b].astype(np.int64)
            smaller += np.where(one, zb - za, 0)
            a = np.where(one, zeros[-1] + a - za, za)
            b = np.where(one, zeros[-1] + b - zb, zb)
        return self.first[symbol] + a - self.base[symbol], b - a, smaller


class BiIndex:
    """Both FM-indexes of `$w1$w2$...$`, the words in order; `narrow(right, ...)` extends matches by a symbol."""

    def __init__(self, words: list[np.ndarray], n_symbols: int):
        parts = [np.array([DELIMITER])]
        for w in words:
            parts += [w, parts[0]]
        self.text = np.concatenate(parts)
        self.n_symbols, self.size = n_symbols, len(self.text) + 1
        self._waves: dict[bool, Wavelet] = {}

    def wave(self, right: bool) -> Wavelet:
        """Index for extensions to the right (of the reversed text) or to the left (of the text), built when first used."""
        if right not in self._waves:
            text = np.append(self.text[::-1] if right else self.text, END)
            order = suffix_array(text)
            self._waves[right] = Wavelet(text[order - 1], self.n_symbols)
        return self._waves[right]

    def narrow(self, right: bool, here: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """Synchronised intervals after one more symbol: (start in this direction's index, start in the other's, size)."""
        low, n, smaller = self.wave(right).narrow(here, size, symbol)
        return low, other + smaller, n

    def word(self, right: bool, here: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Numbers of the words whose whole `$word$` was matched: suffix ranks in the text after the end and the last delimiter."""
        return (other if right else here) - 2


# --- search ----------------------------------------------------------------------------
def search(index: BiIndex, words: list[np.ndarray], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word found) of every indexed word with one error in the later half, as read in this direction.

    `words` are read from left to right (search 1) or from right to left (search 2);
    a symbol that the index has not is -1.
    """
    n = len(words)
    length = np.array([len(w) for w in words], dtype=np.int64)
    half = length // 2 if right else length - length // 2   # symbols matched exactly
    pattern = np.full((n, int(length.max()) + 2), DELIMITER, dtype=np.int64)
    for i, w in enumerate(words):
        pattern[i, 1:1 + len(w)] = w if right else w[::-1]
    q = np.arange(n)
    here, other, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, index.size)
    for t in range(int(half.max()) + 1):
        go = (t <= half[q]) & (size > 0)
        go &= pattern[q, t] >= 0
        size[(t <= half[q]) & ~go] = 0
        here[go], other[go], size[go] = index.narrow(right, here[go], other[go], size[go], pattern[q[go], t])
    q, at, error = q[size > 0], half[size > 0] + 1, np.zeros(int((size > 0).sum()), bool)
    here, other, size = here[size > 0], other[size > 0], size[size > 0]
    letters = np.arange(FIRST, index.n_symbols)
    found_q, found_w = [], []
    while len(q):
        done = at == length[q] + 2
        hit = done & error
        found_q.append(q[hit])
        found_w.append(index.word(right, here[hit], other[hit]))
        q, at, error, here, other, size = (x[~done] for x in (q, at, error, here, other, size))
        want = pattern[q, at]
        same = np.flatnonzero(want >= 0)
        moved = [_extended(index, right, q[same], at[same] + 1, error[same], here[same], other[same], size[same], want[same])]
        clean = np.flatnonzero(~error)
        # any other letter: instead of the wanted one, or before it
        each, letter = np.repeat(clean, len(letters)), np.tile(letters, len(clean))
        differs = letter != want[each]
        each, letter = each[differs], letter[differs]
        put = _extended(index, right, q[each], at[each], np.ones(len(each), bool), here[each], other[each], size[each], letter)
        moved.append(put)
        inside = pattern[put[0], put[1]] != DELIMITER
        replaced = [x[inside] for x in put]
        replaced[1] = replaced[1] + 1
        moved.append(replaced)
        # the wanted letter is missing (of equal letters in a row only the last is left out)
        gone = clean[(want[clean] != DELIMITER)]
        gone = gone[pattern[q[gone], at[gone] + 1] != want[gone]]
        moved.append([q[gone], at[gone] + 1, np.ones(len(gone), bool), here[gone], other[gone], size[gone]])
        q, at, error, here, other, size = (np.concatenate(x) for x in zip(*moved))
    return np.concatenate(found_q or [q]), np.concatenate(found_w or [q])


def _extended(index: BiIndex, right: bool, q, at, error, here, other, size, symbol) -> list[np.ndarray]:
    here, other, size = index.narrow(right, here, other, size, symbol)
    live = size > 0
    return [x[live] for x in (q, at, error, here, other, size)]


def _coded(words: list[str], alphabet: np.ndarray) -> list[np.ndarray]:
    """Symbols of the words; a letter outside the alphabet is -1."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    at = np.searchsorted(alphabet, flat)
    code = np.where(alphabet[np.minimum(at, len(alphabet) - 1)] == flat, at + FIRST, -1)
    return np.split(code, np.cumsum([len(w) for w in words])[:-1])


def near_words(indexed: list[str], queries: list[str], right: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query number, indexed word number) pairs of one search, each once; `indexed` is in code-point order."""
    alphabet = np.unique(np.frombuffer("".join(indexed).encode("utf-32-le"), dtype=np.uint32)).astype(np.int64)
    index = BiIndex(_coded(indexed, alphabet), FIRST + len(alphabet))
    coded = _coded(queries, alphabet)
    order = np.argsort([len(w) for w in coded], kind="stable")
    a = 0
    while a < len(order):  # words of like length together, so that a long one does not widen all
        b = a + 1
        while b < len(order) and (b + 1 - a) * (len(coded[order[b]]) + 2) * len(alphabet) <= CELLS * 16:
            b += 1
        q, w = search(index, [coded[i] for i in order[a:b]], right)
        pair = np.unique(q * len(indexed) + w)
        yield order[a:b][pair // len(indexed)], pair % len(indexed)
        a = b


def _searched(right: bool):
    def task(rows: pa.Table, queries: pa.Table) -> pa.Table:
        rows = rows.sort_by("word")
        words, asked = rows["word"].to_pylist(), queries["word"].to_pylist()
        out = [pa.table({"word": queries["word"].take(pa.array(q)), "near": rows["word"].take(pa.array(w)), "near_n": rows["n"].take(pa.array(w))})
               for q, w in near_words(words, asked, right)] if words and asked else []
        return pa.concat_tables(out) if out else pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
    return task


def _near(vocab: DataFrame, n_blocks: int, right: bool) -> DataFrame:
    """(word, near, near_n) of one search over all blocks."""
    shared = F.substring("word", 1, MIN_HALF) if right else F.substring("word", -MIN_HALF, MIN_HALF)
    words = vocab.select("word", "n", shared.alias("_shared"))
    parts = words.groupBy("_shared").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("_parts"))
    # only split starts are sent to all tasks: each stands for over BLOCK words, and they have MIN_HALF letters
    words = words.join(F.broadcast(parts.where(F.col("_parts") > 1)), "_shared", "left").fillna(1, ["_parts"])
    # small starts are put together, a split one has its blocks for itself
    block = F.when(F.col("_parts") == 1, F.pmod(F.xxhash64("_shared"), F.lit(n_blocks)).cast("string")).otherwise(F.concat(F.lit("s"), "_shared"))
    part = F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    rows = words.select("word", "n", block.alias("_block"), part.alias("_i"), every.alias("_j"))
    queries = words.select(F.col("word").alias("word"), block.alias("_block"), every.alias("_i"), part.alias("_j"))
    keys = ["_block", "_i", "_j"]
    # about one block a task: the work of a block is far more than its bytes say
    rows, queries = (x.repartition(n_blocks, *keys) for x in (rows, queries))
    return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_searched(right), "word string, near string, near_n long")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) once for every ordered pair of near words of a (word, n) table.

    Words are distinct, not null and have MIN_LENGTH code points or more; others are an error of the caller.
    """
    n_blocks = -(-vocab.count() // BLOCK) or 1
    found = _near(vocab, n_blocks, True).unionByName(_near(vocab, n_blocks, False))
    return found.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary.

    Words and occurrences: see `vocabulary`. n_near: near words. form: the near word that
    occurs most (ties: first in code-point order) if it occurs FORM_RATIO times as often
    as the word or more, else null; form_n its occurrences. root: the end of the chain of
    forms, the word itself without one (occurrences grow by FORM_RATIO a step: a chain
    has 27 steps at most and no circle).

    Null and empty texts have no words; a null id reads as no text before the colon.
    Rows of one id are documents of their own that lose the same letters; exact repeats
    count again. A word of any length is a word. An empty table gives no rows. Other columns are not read.
    """
    vocab = C.stored(vocabulary(docs, id_col, text_col), "vocabulary")
    best = near_pairs(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    words = vocab.join(best, "word", "left")
    often = -F.col("b.m") >= FORM_RATIO * F.col("n")
    words = C.stored(words.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("b.near")).alias("form"),
                                  F.when(often, -F.col("b.m")).cast("long").alias("form_n")), "forms")
    links = words.where("form is not null").select(F.col("word").alias("root"), F.col("form").alias("_next"))
    roots = words.select("word", F.coalesce("form", "word").alias("root"))
    while True:  # one step along the chains at a time
        step = C.stored(roots.join(links, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        roots = step.drop("_moved")
        if not step.where("_moved").limit(1).count():
            break
    return words.join(roots, "word").select("word", "n", "n_near", "form", "form_n", "root")

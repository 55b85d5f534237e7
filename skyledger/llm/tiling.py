"""Benchmark decontamination by greedy string tiling (operator 10).

Tokens are runs of letters and digits, lower-cased. Seeds are the Karp-Rabin
hashes of all MIN_MATCH-token runs of the benchmark items; a document is joined
with an item if it holds one of its seeds. For each such pair, seeds on one
diagonal are extended to maximal common runs, and the longest run whose tokens
are all unmarked in both texts is marked, again and again, until no run of
MIN_MATCH tokens is left; a run that overlaps a marked one goes back with what
is left of it. The share of an item's tokens that get marked is its coverage;
as tiles may lie in any order, reordered passages are caught. The tokens under common
seeds bound an item's coverage before any tiling: a document's items are tiled from the
highest bound down, to the best one and those over the threshold, so that an opening
that many items share costs no tiling of them all.

The benchmark is the query set: it is taken in blocks of bounded size (BLOCK_SEEDS
seeds and tokens), one pass over the documents per block, so what a task holds
is bounded however large the benchmark is. Documents are never shuffled with
their texts.

Cases: null or empty texts and items without a token match nothing; an item
shorter than MIN_MATCH is matched as a whole; equal items with different ids
are all reported; null or repeated ids give one row per input row; an empty
table on either side gives no match; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_MATCH = 5        # tokens of a seed, and of the shortest tile
COVERAGE = 0.6       # share of an item's tokens from which a document counts as contaminated
BLOCK_SEEDS = 1 << 20
STEP_SEEDS = 1 << 20  # seeds of rows that are compared with items in one step
_FILTER_BITS = 20

TOKEN_BREAK = np.ones(256, dtype=bool)
TOKEN_BREAK[ord("a"):ord("z") + 1] = False
TOKEN_BREAK[ord("0"):ord("9") + 1] = False
TOKEN_BREAK[0x80:] = False


def tokens(col) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, token hashes, row of each token) of a string column, by chunks."""
    data, off = C.text_buffers(pc.utf8_lower(col.cast(pa.string())))
    for lo, hi in C.chunks(off):
        w = C.Words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], TOKEN_BREAK)
        yield lo, hi, w.hashes(), w.row


def greedy_tiles(at_doc: np.ndarray, at_item: np.ndarray, k: int, n_item: int) -> tuple[list[tuple[int, int, int]], int]:
    """Tiles (document position, item position, length) and the number of item
    tokens they cover, from the positions of the common seeds of one pair."""
    diag = at_doc - at_item
    o = np.lexsort((at_doc, diag))
    d, p, q = diag[o], at_doc[o], at_item[o]
    new = np.ones(len(o), bool)
    new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(o))) + k - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, p[head], q[head])]
    heapq.heapify(heap)
    doc, item, tiles = set(), np.zeros(n_item, bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [not item[b + i] and (a + i) not in doc for i in range(n)]
        if all(free):
            item[b:b + n] = True
            doc.update(range(a, a + n))
            tiles.append((a, b, n))
            continue
        i = 0
        while i < n:  # what is left of it
            j = i
            while j < n and free[j]:
                j += 1
            if j - i >= k:
                heapq.heappush(heap, (-(j - i), a + i, b + i))
            i = max(j, i + 1)
    return tiles, int(item.sum())


class Block:
    """Seeds of one block of the benchmark, by seed length (shorter for short items)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], min_match: int):
        self.ids = [i for i, _ in items]
        self.size = [len(t) for _, t in items]
        self.by_len, self.seeds_of = [], {}
        for k in sorted({min(min_match, n) for n in self.size if n}):
            own = [j for j, n in enumerate(self.size) if min(min_match, n) == k]
            flat = np.concatenate([items[j][1] for j in own])
            row = np.repeat(np.arange(len(own)), [self.size[j] for j in own])
            first = np.cumsum([0] + [self.size[j] for j in own])
            at, h = C.window_hashes(flat, row, k)
            o = np.argsort(h, kind="stable")
            item = np.array(own)[row[at]]
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[h >> np.uint64(64 - _FILTER_BITS)] = True
            ends = np.searchsorted(row[at], np.arange(len(own) + 1))
            self.seeds_of.update((j, h[x:y]) for j, x, y in zip(own, ends[:-1], ends[1:]))
            self.by_len.append((k, h[o], item[o], (at - first[row[at]])[o], bits))
        self.words = np.array(self.size)

    def judge(self, hashes: np.ndarray, row: np.ndarray, coverage: float, all_items: bool = True) -> dict[int, tuple[float, int, int, list[int]]]:
        """By row with a common seed: (coverage, covered tokens, item) of the best item, the
        first of those that tie, and all items from `coverage` on; items by place in the block.

        A tile lies on common seeds, so the tokens under an item's seeds that the row holds
        bound its coverage. A row's items are tiled from the highest bound down, until no
        bound reaches `coverage` or what is found; without `all_items` to the first item that
        reaches `coverage`, and none below it."""
        out: dict[int, tuple[float, int, int, list[int]]] = {}
        for k, seeds, item, pos, bits in self.by_len:
            at, h = C.window_hashes(hashes, row, k)
            may = np.flatnonzero(bits[h >> np.uint64(64 - _FILTER_BITS)])
            at, h = at[may], h[may]
            lo = np.searchsorted(seeds, h, "left")
            hit = np.searchsorted(seeds, h, "right") > lo
            if not hit.any():
                continue
            at, h = at[hit], h[hit]
            r = row[at]
            o = np.lexsort((at, h, r))
            at, h, r = at[o], h[o], r[o]
            for rows, items, bound in self._bounds(h, r, k, seeds, item, pos):
                share = bound / self.words[items]
                if not all_items:
                    may = share >= coverage
                    rows, items, bound, share = rows[may], items[may], bound[may], share[may]
                o = np.lexsort((items, -bound, -share, rows))
                rows, items, bound, share = rows[o], items[o], bound[o], share[o]
                heads = np.flatnonzero(np.diff(rows, prepend=-1))
                for a, b in zip(heads, np.append(heads[1:], len(rows))):
                    x = int(rows[a])
                    found = out.get(x, (0.0, 0, 0, []))
                    lo, hi = np.searchsorted(r, x, "left"), np.searchsorted(r, x, "right")
                    for c in range(a, b):
                        j, top = int(items[c]), (float(share[c]), int(bound[c]), -int(items[c]))
                        if (top[0] < coverage and top < (found[0], found[1], -found[2])) or (found[3] and not all_items):
                            break
                        covered = self._tile(at[lo:hi], h[lo:hi], j, k)
                        mine = covered / self.size[j]
                        if (mine, covered, -j) > (found[0], found[1], -found[2]):
                            found = (mine, covered, j, found[3])
                        if mine >= coverage:
                            found[3].append(j)
                    if found[1]:
                        out[x] = found
        return out

    @staticmethod
    def _bounds(h, r, k, seeds, item, pos):
        """(rows, items, tokens of the item under seeds that the row holds) by steps of whole rows;
        a seed counts once a row, so a row gives at most the seeds of the block. `h` is sorted by row and hash."""
        u = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (h[1:] != h[:-1]))))
        lo = np.searchsorted(seeds, h[u], "left")
        num = np.searchsorted(seeds, h[u], "right") - lo
        heads = np.append(np.flatnonzero(np.diff(r[u], prepend=-1)), len(u))
        total = np.concatenate(([0], np.cumsum(num)))[heads]
        x = 0
        while x < len(heads) - 1:
            y = max(x + 1, int(np.searchsorted(total, total[x] + STEP_SEEDS, "right")) - 1)
            part = slice(heads[x], heads[y])
            at = C.ragged(lo[part], num[part])
            rows, items, place = np.repeat(r[u[part]], num[part]), item[at], pos[at]
            o = np.lexsort((place, items, rows))
            rows, items, place = rows[o], items[o], place[o]
            new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (items[1:] != items[:-1])))
            under = np.full(len(place), k)
            under[:-1] = np.where(new[1:], k, np.minimum(k, place[1:] - place[:-1]))
            first = np.flatnonzero(new)
            yield rows[first], items[first], np.add.reduceat(under, first)
            x = y

    def _tile(self, at: np.ndarray, h: np.ndarray, j: int, k: int) -> int:
        """Tokens of item j that tiles cover, from the seeds of one row (by hash, then place)."""
        own = self.seeds_of[j]
        lo = np.searchsorted(h, own, "left")
        num = np.searchsorted(h, own, "right") - lo
        return greedy_tiles(at[C.ragged(lo, num)], np.repeat(np.arange(len(own)), num), k, self.size[j])[1]


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, min_match: int, block_seeds: int):
    """The benchmark as blocks of about `block_seeds` tokens; one block at a time
    comes to the driver and goes to the tasks."""
    def go(batches):
        for b in batches:
            for lo, hi, h, row in tokens(b.column(1)):
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([h[x:y].astype("<u8").tobytes() for x, y in zip(first[:-1], first[1:])], pa.binary()),
                     pa.array(np.diff(first).astype(np.int64))], ["item", "hashes", "n"])
    rows = (items.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(go, "item long, hashes binary, n long").where("n > 0"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_seeds)
    for i in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item", "hashes"), F.lit(blocks)) == i)
        got = sorted(((r["item"], np.frombuffer(r["hashes"], "<u8")) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0))
        if got:
            yield Block(got, min_match)


def best_matches(texts: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
                 coverage: float = COVERAGE, min_match: int = MIN_MATCH, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(_k, coverage, covered, item_id, item_ids) of every row with a common seed, once a block of the
    benchmark: its best item there, and the items from `coverage` on."""
    sc, out = texts.sparkSession.sparkContext, None
    schema = "_k long, coverage double, covered long, item_id long, item_ids array<long>"
    for block in benchmark_blocks(items, item_id, item_text, min_match, block_seeds):
        shared = sc.broadcast(block)

        def go(batches, shared=shared):
            for b in batches:
                ids = b.column(0)
                for lo, hi, h, row in tokens(b.column(1)):
                    names, got = shared.value.ids, shared.value.judge(h, row, coverage)
                    if got:
                        share, covered, best, over = zip(*got.values())
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array([lo + r for r in got])), pa.array(share, pa.float64()), pa.array(covered, pa.int64()),
                             pa.array([names[j] for j in best], pa.int64()), pa.array([[names[j] for j in x] for x in over], pa.list_(pa.int64()))],
                            ["_k", "coverage", "covered", "item_id", "item_ids"])
        one = texts.select("_k", "_text").mapInArrow(go, schema)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else texts.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  coverage: float = COVERAGE, **how) -> DataFrame:
    """One row per document: the best covered item, its coverage, all items over
    the threshold, and whether the document is contaminated."""
    texts, keys = C.keyed_texts(docs, id_col, text_col)
    best = best_matches(texts, items, coverage=coverage, **how).groupBy("_k").agg(
        F.max(F.struct("coverage", "covered", (-F.col("item_id")).alias("_neg"))).alias("_b"),
        F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_list("item_ids"))))).alias("item_ids"))
    rows = texts.select("_k") if keys is None else keys
    out = rows.join(best, "_k", "left")
    contaminated = F.coalesce(F.col("_b.coverage") >= coverage, F.lit(False))
    return out.select(F.col("_k" if keys is None else "_id").alias("doc_id"), (-F.col("_b._neg")).alias("best_item_id"),
                      F.coalesce("_b.covered", F.lit(0).cast("long")).alias("covered_words"),
                      F.coalesce("_b.coverage", F.lit(0.0)).alias("coverage"),
                      F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                      contaminated.alias("contaminated"), (~contaminated).alias("kept"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                      coverage: float = COVERAGE, min_match: int = MIN_MATCH, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """The documents that no item covers to the threshold, with their columns unchanged (whatever their names); rows
    keep their place (no shuffle)."""
    return C.shielded(docs, lambda d, text: _drop_contaminated(d, items, text, item_id, item_text, coverage, min_match, block_seeds), text_col)


def _drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, coverage: float,
                       min_match: int, block_seeds: int) -> DataFrame:
    sc, at = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    for block in benchmark_blocks(items, item_id, item_text, min_match, block_seeds):
        shared = sc.broadcast(block)

        def go(batches, shared=shared):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for lo, hi, h, row in tokens(b.column(at)):
                    for r, (share, *_) in shared.value.judge(h, row, coverage, False).items():
                        keep[lo + r] &= share < coverage
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(go, docs.schema)
    return docs

"""Hard-negative mining by the threshold algorithm.

Vectors become integers (floor(scale * x)). For each anchor its best rows of the
same label are its positives; for each positive the best rows of other labels whose
score lies in a window relative to the positive's score are its hard negatives.

The rows to search lie in blocks of about BLOCK rows (by hash of the id), the
anchors in blocks of about ANCHORS; one task call sees one pair of blocks, so
memory does not depend on the input. In a block every dimension has a list of its
rows sorted by that component. An anchor reads the lists from the end its own sign
prefers (descending where its component is positive, ascending where negative) in
growing rounds; a row seen for the first time is scored in full by random access.
No unseen row can score more than the sum of the anchor's components times the
values last read, the threshold: reading stops once it is strictly below each
window's k-th score (a tie may still have a smaller id) or below the window itself.
The best of each block are then merged by a window limit in Spark.

Scores are exact: the block's arithmetic is float32, float64 or Python integers,
the first in which the largest possible sum is represented exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import common as C

BLOCK = 4096     # rows searched at once
ANCHORS = 1024   # anchors that search them in one call
ROUND = 32       # sorted accesses of the first round, doubled in each next one

POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = POSITIVE + ", negative_id long, negative_score long"


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as one integer matrix; shorter vectors end in zeros."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)
    length = np.diff(off)
    out = np.zeros((len(col), int(length.max(initial=0))), dtype=np.int64)
    out[np.repeat(np.arange(len(col)), length), C.ragged(np.zeros(len(col), np.int64), length)] = flat[off[0]:off[-1]]
    return out


def exact_type(q: np.ndarray, a: np.ndarray):
    """Smallest type in which every partial sum of a product of rows is exact."""
    bound = int(np.abs(q.astype(object)).max(initial=0)) * int(np.abs(a.astype(object)).max(initial=0)) * max(q.shape[1], 1)
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def same_width(q: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(q.shape[1], a.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (q, a))


class SortedLists:
    """One list per dimension of the rows of a block, ascending by component."""

    def __init__(self, q: np.ndarray):
        self.q = q
        self.order = np.argsort(q, axis=0, kind="stable")
        self.value = np.take_along_axis(q, self.order, 0)

    def access(self, a: np.ndarray):
        """Rounds of (rows seen first, their scores, threshold of all unseen rows) for one anchor."""
        n = len(self.q)
        dims = np.flatnonzero(a)
        if not len(dims):  # all scores are 0, and so is the threshold of an unread list
            yield np.arange(n), np.zeros(n, self.q.dtype), -1
            return
        up, down = dims[a[dims] > 0], dims[a[dims] < 0]
        seen = np.zeros(n, dtype=bool)
        at, step = 0, ROUND
        while at < n:
            to = min(n, at + step)
            now = np.zeros(n, dtype=bool)
            now[self.order[n - to:n - at, up].ravel()] = True
            now[self.order[at:to, down].ravel()] = True
            fresh = np.flatnonzero(now & ~seen)
            seen |= now
            limit = (self.value[n - to, up] * a[up]).sum() + (self.value[to - 1, down] * a[down]).sum()
            yield fresh, self.q[fresh] @ a, limit
            if seen.all():
                return
            at, step = to, step * 2


class Best:
    """The k best (score, id) of a window [low, high]: high scores first, then small ids."""

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high = k, low, high
        self.score, self.id = np.zeros(0), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if self.low is not None:
            inside = (score >= self.low) & (score <= self.high)
            score, ids = score[inside], ids[inside]
        if not len(score):
            return
        if len(score) > 4 * self.k and score.dtype != object:  # ties of the k-th stay
            enough = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[enough], ids[enough]
        score, ids = np.concatenate((self.score.astype(score.dtype), score)), np.concatenate((self.id, ids))
        first = np.lexsort((ids, -score))[:self.k]
        self.score, self.id = score[first], ids[first]

    def settled(self, limit) -> bool:
        """No unseen row, of at most this score, can enter."""
        return (len(self.id) == self.k and limit < self.score[-1]) or (self.low is not None and limit < self.low)


def _positives(k: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        q, a = same_width(matrix(rows["q"]), matrix(anchors["q"]))
        kind = exact_type(q, a)
        q, a = q.astype(kind), a.astype(kind)
        ids, anchor_ids = rows["id"].to_numpy(), anchors["id"].to_numpy()
        labels, anchor_labels = np.array(rows["label"].to_pylist(), dtype=object), np.array(anchors["label"].to_pylist(), dtype=object)
        out = []
        for label in sorted(set(anchor_labels)):
            own = np.flatnonzero(labels == label)
            lists = SortedLists(q[own])
            for i in np.flatnonzero(anchor_labels == label):
                best = Best(k)
                for fresh, score, limit in lists.access(a[i]):
                    other = ids[own[fresh]] != anchor_ids[i]
                    best.add(score[other], ids[own[fresh[other]]])
                    if best.settled(limit):
                        break
                out += [(int(anchor_ids[i]), int(r), int(s)) for r, s in zip(best.id, best.score)]
        return _table(out, POSITIVE)
    return search


def _negatives(k: int, low: int, high: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        q, a = same_width(matrix(rows["q"]), matrix(anchors["q"]))
        kind = exact_type(q, a)
        q, a = q.astype(kind), a.astype(kind)
        ids, anchor_ids = rows["id"].to_numpy(), anchors["id"].to_numpy()
        labels, anchor_labels = np.array(rows["label"].to_pylist(), dtype=object), anchors["label"].to_pylist()
        lists, out = SortedLists(q), []
        for i, positives in enumerate(anchors["positives"].to_pylist()):
            # low * p <= 100 * score <= high * p in integers
            windows = [(p, Best(k, -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100)) for p in positives]
            windows = [(p, w) for p, w in windows if w.low <= w.high]
            if not windows:
                continue
            lowest = min(w.low for _, w in windows)
            for fresh, score, limit in lists.access(a[i]):
                use = (score >= lowest) & (labels[fresh] != anchor_labels[i])
                score, fresh = score[use], fresh[use]
                for _, w in windows:
                    w.add(score, ids[fresh])
                if all(w.settled(limit) for _, w in windows):
                    break
            out += [(int(anchor_ids[i]), p["positive_id"], p["positive_score"], int(r), int(s))
                    for p, w in windows for r, s in zip(w.id, w.score)]
        return _table(out, NEGATIVE)
    return search


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    names = [c.split(" ")[0] for c in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _block(c: str, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def _search(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], task, ddl: str) -> DataFrame:
    """Every block of rows against every block of anchors, one pair in a call."""
    n, m = blocks
    left = rows.select("id", "label", "q", _block("id", n).alias("_rows"), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("_anchors"))
    # new names for the columns of one table that is on both sides
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_rows"),
                           _block("id", m).alias("_anchors"))
    return left.groupBy("_rows", "_anchors").cogroup(right.groupBy("_rows", "_anchors")).applyInArrow(task, ddl)


def usable(rows: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, q): rows that take part, their vectors as integers, one row per id."""
    q = f"transform(`{vector_col}`, x -> floor({int(scale)} * CAST(x AS DOUBLE)))"
    fine = f"forall(`{vector_col}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < CAST('Infinity' AS DOUBLE))"
    out = rows.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.expr(f"`{vector_col}` IS NOT NULL AND {fine}"))
    out = out.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.expr(q).alias("q"))
    out = C.stored(out, "vectors")
    if out.groupBy("id").count().where("count > 1").limit(1).count():
        out = C.stored(out.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q"), "vectors")
    return out


def hard_negatives(rows: DataFrame, anchor_every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (1 first), negative_id, positive_score, negative_score.

    Anchors are the rows whose id `anchor_every` divides. Positives: the first
    `positives` other rows of the anchor's label; negatives of a positive: the first
    `negatives` rows of other labels with low * positive_score <= 100 * score <=
    high * positive_score; higher scores first, then smaller ids.

    Rows with a null id, label, vector or component, or a component that is not
    finite, take no part. Of several rows with one id that with the smallest label
    (as text), then the smallest integer vector, stands for it, so exact repeats count
    once. Shorter vectors end in zeros; an empty vector scores 0 with all. A positive of
    a negative score has no negatives, one of score 0 has those of score 0. Components
    beyond 64 bits are cut to the largest 64-bit integer; a score beyond 64 bits is an
    error. An empty table gives no rows. Other columns are not read.
    """
    pool = usable(rows, scale, id_col, vector_col, label_col)
    anchors = pool.where(F.col("id") % anchor_every == 0)
    blocks = (-(-pool.count() // BLOCK) or 1, -(-anchors.count() // ANCHORS) or 1)
    found = _search(pool, anchors, blocks, _positives(positives), POSITIVE)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= positives)
    windows = found.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    hard = _search(pool, anchors.join(windows, "id"), blocks, _negatives(negatives, low, high), NEGATIVE)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Near-duplicate documents by an LSH forest over MinHash signatures (operator 2).

Each document is the set of its distinct 5-word shingles. Documents with equal
sets collapse to one (copies in any number cost one row each). Of each remaining
set 128 minimum hashes are taken; 16 trees each order all sets by 8 of them.
Neighbours in a sorted order share the longest common prefixes, so a set's
candidates are its next WINDOW rows in each order, as deep as its region is
dense and down to a prefix of MIN_DEPTH where it is sparse; a two-bit sketch of the
whole signature drops candidates far below the threshold.

Candidates only say which sets may belong together: the connected regions they
form are then searched exactly on the full sets. A region larger than a block
is dealt out by pairs of blocks, so a region of any size needs bounded memory;
each task returns a spanning forest of its links, never all pairs. The links'
connected components are the result.

What is lost: a link between sets that are neighbours in none of the 16 orders
(0.85: one in four million) or whose sketch is 4.5 standard deviations off.

Cases: a null or empty text has an empty set and is linked with nothing; with
fewer than five words the whole sequence is the only shingle; a null id makes
its own component (null); rows that repeat an id count as one document; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
PERCENT = 85             # links: 100 * intersection >= PERCENT * union
TREES, DEPTH = 16, 8
HASHES = TREES * DEPTH
MIN_DEPTH = 3
WINDOW = 4
BLOCK_SHINGLES = 150_000  # sets of one task's block
SALTS = 32               # parts into which the copies of one set are dealt

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_g = np.random.default_rng(8121)
_A = (_g.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _g.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    n = len(offsets) - 1
    w = C.Words(_LOWER[data], offsets)
    h = w.hashes()
    out = [np.zeros(0, np.uint64)] * n
    at, s = C.window_hashes(h, w.row, SHINGLE)
    first = np.searchsorted(w.row[at], np.arange(n + 1))
    for i in np.flatnonzero(w.count >= SHINGLE):
        out[i] = np.unique(s[first[i]:first[i + 1]])
    for k in range(1, SHINGLE):
        rows = np.flatnonzero(w.count == k)
        if len(rows):
            at, s = C.window_hashes(h, w.row, k, salt=k)
            at_row = dict(zip(w.row[at].tolist(), range(len(at))))
            for i in rows.tolist():
                out[i] = s[at_row[i]:at_row[i] + 1]
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES minimum hashes of a non-empty set."""
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    best = None
    for a in range(0, len(x), 4096):
        v = (_A[:, None] * x[None, a:a + 4096] + _B[:, None])
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        m = v.min(axis=1)
        best = m if best is None else np.minimum(best, m)
    return best


def sketch(sig: np.ndarray) -> bytes:
    """Two low bits of each minimum hash."""
    two = (sig & np.uint32(3)).astype(np.uint8).reshape(-1, 4)
    return (two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6).tobytes()


#: equal two-bit cells expected at the threshold, less 4.5 standard deviations
_p = PERCENT / 100 + (1 - PERCENT / 100) / 4
MIN_CELLS = int(HASHES * (_p - 4.5 * (_p * (1 - _p) / HASHES) ** 0.5))


def document_sets(texts: DataFrame) -> DataFrame:
    """(_k, _n, _d1, _d2, _sig): size, order-free 128-bit digest and signature of each row's set."""
    def go(batches):
        for b in batches:
            data, off = C.text_buffers(b.column(1))
            for lo, hi in C.chunks(off):
                sets = shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                d1 = [int(C.mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                d2 = [int(C.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                sig = [signature(s).astype("<u4").tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1, pa.int64()),
                     pa.array(d2, pa.int64()), pa.array(sig, pa.binary())], ["_k", "_n", "_d1", "_d2", "_sig"])
    return texts.select("_k", "_text").mapInArrow(go, "_k long, _n long, _d1 long, _d2 long, _sig binary")


_EDGE = "a long, b long, tree int, label binary, sketch binary"
_EDGE_PA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("label", pa.binary()), ("sketch", pa.binary())])


def forest_rows(sigs: DataFrame) -> DataFrame:
    """(tree, label, k, sketch): each set once per tree, with its 8 hashes as sort label."""
    def go(batches):
        for b in batches:
            n = b.num_rows
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(n, HASHES)
            labels = np.ascontiguousarray(sig.reshape(n, TREES, DEPTH)).astype(">u4")
            raw = labels.tobytes()
            step = DEPTH * 4
            sk = [sketch(x) for x in sig]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array([raw[i:i + step] for i in range(0, len(raw), step)], pa.binary()),
                 pa.array(np.repeat(b.column(0).to_numpy(), TREES)), pa.array([x for x in sk for _ in range(TREES)], pa.binary())],
                ["tree", "label", "k", "sketch"])
    return sigs.select("_k", "_sig").mapInArrow(go, "tree int, label binary, k long, sketch binary")


def neighbours(ordered: DataFrame, with_edges: bool) -> DataFrame:
    """Candidate pairs of a sorted order. With `with_edges` the first and last
    WINDOW rows of each partition come along (b null): pairs across the border."""
    def pairs(tree, label, sk, k):
        found = []
        for lag in range(1, WINDOW + 1):
            if len(k) <= lag:
                break
            same = (tree[lag:] == tree[:-lag]) & (label[lag:, :MIN_DEPTH] == label[:-lag, :MIN_DEPTH]).all(axis=1)
            at = np.flatnonzero(same)
            x = sk[at + lag] ^ sk[at]
            cells = HASHES - _ONES[(x | x >> 1) & 0x55].sum(axis=1, dtype=np.int64)
            at = at[cells >= MIN_CELLS]
            found.append(np.stack([at, at + lag]))
        return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)

    def edge_batch(rows):
        t, lab, s, k = rows
        n = len(k)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.nulls(n, pa.int64()), pa.array(t), pa.array([x.astype(">u4").tobytes() for x in lab], pa.binary()),
                                           pa.array([x.tobytes() for x in s], pa.binary())], schema=_EDGE_PA)

    def go(batches):
        held, headed = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            rows = (b.column(0).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), ">u4").astype(np.uint32).reshape(n, DEPTH),
                    np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(n, HASHES // 4), b.column(2).to_numpy())
            if with_edges and headed < WINDOW:
                take = min(n, WINDOW - headed)
                yield edge_batch([x[:take] for x in rows])
                headed += take
            m = 0 if held is None else len(held[3])
            if m:
                rows = tuple(np.concatenate((h, r)) for h, r in zip(held, rows))
            p = pairs(rows[0], rows[1], rows[2], rows[3])
            p = p[:, p[1] >= m]
            a, c = rows[3][p[0]], rows[3][p[1]]
            keep = a != c
            a, c = np.minimum(a, c)[keep], np.maximum(a, c)[keep]
            if len(a):
                e = np.unique(np.stack([a, c]), axis=1)
                n_e = e.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1]), pa.nulls(n_e, pa.int32()), pa.nulls(n_e, pa.binary()), pa.nulls(n_e, pa.binary())], schema=_EDGE_PA)
            held = tuple(x[-WINDOW:] for x in rows)
        if with_edges and held is not None:
            yield edge_batch(held)

    return ordered.select("tree", "label", "k", "sketch").mapInArrow(go, _EDGE)


def candidates(sigs: DataFrame) -> DataFrame:
    """(a, b) neighbours of all trees, each order sorted over all its rows."""
    n = int(sigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "label", "k"]
    found = C.stored(neighbours(forest_rows(sigs).repartitionByRange(n, *order).sortWithinPartitions(*order), True), "neighbours")
    # 2 * WINDOW rows of each partition meet in one task
    border = found.where("b is null").select("tree", "label", F.col("a").alias("k"), "sketch").coalesce(1).sortWithinPartitions(*order)
    return found.where("b is not null").select("a", "b").unionByName(neighbours(border, False).select("a", "b")).distinct()


def exact_links(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets (all pairs that share a shingle are held against the threshold)."""
    n = len(sets)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    size = np.array([len(s) for s in sets], dtype=np.int64)
    doc = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets)
    o = np.argsort(flat, kind="stable")
    t, d = flat[o], doc[o]
    new = np.ones(len(t), bool)
    new[1:] = t[1:] != t[:-1]
    head = np.flatnonzero(new)
    freq = np.diff(np.append(head, len(t)))
    group = np.cumsum(new) - 1
    at = np.empty(len(t), np.int64)
    at[o] = group  # posting list of each shingle, in the order of `flat`
    first = np.cumsum(size) - size
    out = []
    for i in range(1, n):
        own = at[first[i]:first[i] + size[i]]
        own = own[freq[own] > 1]
        if not len(own):
            continue
        hits = d[C.ragged(head[own], freq[own])]
        common = np.bincount(hits[hits < i], minlength=i)
        linked = np.flatnonzero((common > 0) & (100 * common >= percent * (size[:i] + size[i] - common)))
        for j in linked.tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(ids[j]), int(ids[i])))
    return out


def exact_region_links(texts: DataFrame, regions: DataFrame, sizes: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): spanning links of each region, from the full sets of its members."""
    members = regions.join(sizes, regions.node == sizes["_k"]).select("node", F.col("component").alias("region"), "_n")
    total = members.groupBy("region").agg(F.ceil(F.sum("_n") / F.lit(block)).cast("int").alias("_blocks"))
    dealt = (members.join(total, "region").withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select(F.col("node").alias("_k"), "region", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")))

    def go(batches):
        key, ids, sets = None, [], []

        def out():
            links = exact_links(np.array(ids, dtype=np.int64), sets, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for b in batches:
            data, off = C.text_buffers(b.column(4))
            own = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            names = b.column(3).to_pylist()
            for lo, hi in C.chunks(off):
                for i, s in enumerate(shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]), start=lo):
                    if own[i] != key:
                        if len(ids) > 1:
                            yield from out()
                        key, ids, sets = own[i], [], []
                    ids.append(names[i])
                    sets.append(s)
        if len(ids) > 1:
            yield from out()

    rows = (dealt.join(texts, "_k").repartition("region", "_i", "_j").sortWithinPartitions("region", "_i", "_j", "_k")
            .select("region", "_i", "_j", "_k", "_text"))
    return rows.mapInArrow(go, "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
               block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    texts = docs.select(F.col(id_col).cast("long").alias("_k"), F.col(text_col).cast("string").alias("_text"))
    sets = C.stored(document_sets(texts), "sets")
    known = sets.where("_k is not null and _n > 0")
    groups = known.groupBy("_n", "_d1", "_d2").agg(F.min("_k").alias("_rep"), F.count(F.lit(1)).alias("_copies"))
    # the representative's own row stands for its copies (and an id that repeats for itself)
    reps = known.join(groups.select(F.col("_n").alias("_gn"), F.col("_d1").alias("_g1"), F.col("_d2").alias("_g2"), F.col("_rep")),
                      (F.col("_k") == F.col("_rep")) & (F.col("_n") == F.col("_gn")) & (F.col("_d1") == F.col("_g1")) & (F.col("_d2") == F.col("_g2")), "left_semi")
    near = connected(texts, reps, percent, block)
    # an id with several sets ties them together, too
    twice = known.groupBy("_k").agg(F.min("_d1").alias("_x"), F.max("_d1").alias("_y")).where("_x <> _y").select("_k")
    of_set = groups.where("_copies > 1").select("_n", "_d1", "_d2", "_rep")
    # a set may have very many copies: its one row is repeated for each salt, the copies are dealt out by it
    salted = of_set.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    member = (sets.select("_k", "_n", "_d1", "_d2", F.pmod(F.xxhash64("_k"), F.lit(SALTS)).cast("int").alias("_salt"))
              .join(salted, ["_n", "_d1", "_d2", "_salt"], "left").select("_k", "_n", F.coalesce("_rep", "_k").alias("_rep")))
    if twice.limit(1).count():
        ties = member.join(twice, "_k", "left_semi").select(F.col("_k").alias("a"), F.col("_rep").alias("b"))
        near = C.connected_components(near.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties))
    out = member.join(near, member["_rep"] == near["node"], "left").select(
        F.col("_k").alias("doc_id"), F.col("_n").alias("n_shingles"),
        F.when((F.col("_n") > 0) & F.col("_k").isNotNull(), F.coalesce("component", "_rep")).otherwise(F.col("_k")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def connected(texts: DataFrame, reps: DataFrame, percent: int, block: int) -> DataFrame:
    """(node, component) of the representatives that have a link."""
    regions = C.connected_components(candidates(reps))
    sizes = reps.groupBy("_k").agg(F.max("_n").alias("_n"))
    links = exact_region_links(texts, regions, sizes, percent, block)
    return C.connected_components(links)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component (its smallest id); of rows that repeat an
    id the one with the smallest text; columns unchanged (whatever their names)."""
    return C.shielded(docs, _keep_one, id_col, text_col)


def _keep_one(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    judged = components(docs, id_col, text_col)
    gone = C.stored(judged.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(gone, F.col(id_col).cast("long") == F.col("_gone"), "left_anti")
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
    if ids.limit(1).count():
        raise_cols = [c for c in docs.columns if c != id_col]
        first = kept.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.struct(text_col, *[c for c in raise_cols if c != text_col])).alias("_r"))
        one = first.select(id_col, "_r.*").select(*docs.columns)
        kept = one.unionByName(kept.where(F.col(id_col).isNull()))
    return kept

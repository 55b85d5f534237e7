"""Hard-negative mining against brute force, and its defined corner cases."""

import math
import random

import numpy as np
import pytest

from skyledger.llm import hard_negatives as H
from skyledger.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, q string, id string, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", "y", 1) for i, v, g in rows], SCHEMA)


def brute(rows, every=50, k=5, n=3, low=50, high=95, scale=256):
    pool = {}
    for i, v, g in rows:
        if i is None or v is None or g is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * float(np.float32(x))) for x in v]
        pool[i] = min(pool.get(i, (str(g), q)), (str(g), q))
    out = set()
    for a, (label, q) in pool.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r)), i, g) for i, (g, r) in pool.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            fit = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:n]
            out |= {(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fit)}
    return out


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0, 0.2), 1) for _ in range(6)], rng.randrange(3)) for i in range(400)]  # coarse: many ties
    rows += [(i, [0.2] * 6, i % 4) for i in range(400, 460)]                                        # equal vectors
    rows += [(None, [0.1] * 6, 1), (501, None, 1), (502, [0.1, None], 1), (503, [float("nan")], 1), (504, [float("inf")], 1),
             (505, [0.1] * 6, None), (550, [0.0] * 6, 2), (600, [], 2), (650, [0.5, -0.5], 0), (-50, [0.3] * 6, 1)]
    rows += [(100, [0.4] * 6, 2), (100, [0.4] * 6, 2), (150, [-0.9] * 6, 0), rows[3], rows[3]]         # repeated ids
    assert got(H.hard_negatives(frame(spark, rows))) == brute(rows)
    assert got(H.hard_negatives(frame(spark, rows), anchor_every=7, positives=2, negatives=4, low=0, high=100)) == brute(rows, 7, 2, 4, 0, 100)


def test_large_components_and_many_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * 10.0 ** rng.randrange(6) for _ in range(5)], rng.randrange(2)) for i in range(300)]
    want = brute(rows)
    assert want
    monkeypatch.setattr(H, "BLOCK", 37)
    monkeypatch.setattr(H, "ANCHORS", 2)
    assert got(H.hard_negatives(frame(spark, rows))) == want


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(0, None, 1), (50, [float("nan")], 2)], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)]):
        assert got(H.hard_negatives(frame(spark, rows))) == set()


def test_reading_stops_early_but_never_too_early():
    rng = np.random.default_rng(1)
    q = rng.integers(-200, 200, (5000, 3)).astype(np.float64)
    a = np.array([3.0, -2.0, 0.0])
    lists, best, read = H.SortedLists(q), H.Best(4), 0
    for fresh, score, limit in lists.access(a):
        read += len(fresh)
        assert (score == q[fresh] @ a).all()
        best.add(score, fresh)
        rest = np.setdiff1d(np.arange(len(q)), fresh)
        if best.settled(limit):
            break
    assert read < 2500 and len(rest)
    whole = np.lexsort((np.arange(len(q)), -(q @ a)))[:4]
    assert best.id.tolist() == whole.tolist()


@pytest.mark.parametrize("big, kind", [(1, np.float32), (1 << 20, np.float64), (1 << 30, object)])
def test_arithmetic_is_exact(big, kind):
    q = np.array([[big, -big, 1]])
    assert H.exact_type(q, q) is kind


def test_registered_query_moves_labels(spark, tmp_path):
    rows = [(i, [((i * 37) % 11) / 11, ((i * 53) % 7) / 7], i % 3 if i % 5 else 9) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    moved = [(i, v, (g + 1) % 10 if i % 7 == 0 else g) for i, v, g in rows]
    want = brute(moved)
    assert want and got(QUERIES["op11_hard_negatives"](spark, str(tmp_path))) == want

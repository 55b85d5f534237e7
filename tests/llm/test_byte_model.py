"""The byte model of operator 7 against a plain version, in one part and in many."""

import collections
import math

import numpy as np
import pytest

from skyledger.llm import quality_rules as Q

from .test_llm_operators import by_id, rows

TEXTS = ["the cat sat on the mat", "The cat SAT on the mat 12 34", "Ünïcödé と 漢字 漢文", "the cat sat on the mat", "a", "", None, "kot сидел кот"]


def plain(texts):
    """Score of each text, by dictionaries over byte strings; grams that only the text itself has are unseen."""
    pad = bytes([Q.START]) * (Q.DEPTH - 1)

    def grams_of(t, size):
        x = pad + (t or "").encode()
        return [x[i - size + 1:i + 1] for i in range(Q.DEPTH - 1, len(x))]
    raw = [None] + [collections.Counter(g for t in texts for g in grams_of(t, n)) for n in range(1, Q.DEPTH + 1)]
    counts = {Q.DEPTH: raw[Q.DEPTH]}
    for n in range(Q.DEPTH - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    p, back, followed = {}, {}, collections.Counter()
    for n in range(1, Q.DEPTH + 1):
        d = Q._discount_of([sum(c == i for c in counts[n].values()) for i in (1, 2, 3, 4)])
        total, left = collections.Counter(), collections.defaultdict(float)
        for g, c in counts[n].items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
            followed[g[:-1]] += raw[n][g]
        for g, c in counts[n].items():
            back[g[:-1]] = left[g[:-1]] / total[g[:-1]]
            p[g] = (c - d[min(c, 3)]) / total[g[:-1]] + back[g[:-1]] * (p[g[1:]] if n > 1 else 1 / 256)
    out = []
    for t in texts:
        own = [None] + [collections.Counter(grams_of(t, n)) for n in range(1, Q.DEPTH + 1)]
        before = collections.Counter(g[:-1] for n in range(1, Q.DEPTH + 1) for g in grams_of(t, n))
        score = 0.0
        for g in grams_of(t, Q.DEPTH):
            while g and raw[len(g)][g] == own[len(g)][g]:
                c = g[:-1]
                n = raw[len(c)].get(c, 0) if c else 0  # a context at the end of a text is one, too
                mine = own[len(c)][c] if n else before[c]
                if not c or (n or followed[c]) > (mine if n else before[c]):
                    score += math.log(back[c])
                g = g[1:]
            score += math.log(p[g]) if g else math.log(1 / 256)
        out.append(score)
    return out


@pytest.mark.parametrize("part_rows", [1 << 22, 13])
def test_byte_model_equals_a_plain_version(spark, monkeypatch, part_rows):
    monkeypatch.setattr(Q, "PART_ROWS", part_rows)
    docs = rows(spark, TEXTS)
    model = Q.fit(docs)
    assert all(len(x) % 2 for x in model.shared) and (model.parts > 5) == (part_rows == 13)
    got = {r["doc_id"]: r["_q_logp"] for r in Q.annotate(docs, model).collect()}
    for i, want in enumerate(plain(TEXTS)):
        assert abs(got[i] - want) < 1e-4 * (1 + abs(want)), TEXTS[i]


def test_a_text_does_not_speak_for_itself(spark):
    """Noise of its own letters costs more than prose, though every gram of it was counted."""
    import random
    r = random.Random(5)
    words = ["".join(r.choice(["an", "er", "th", "in", "or"]) for _ in range(3)) for _ in range(50)]
    texts = [" ".join(r.choice(words) for _ in range(60)) for _ in range(40)]
    texts.append(" ".join("".join(r.sample(w, len(w))) for w in texts[0].split()))
    got = by_id(Q.quality_report(rows(spark, texts)))
    assert got[40]["log_perplexity"] > 2 * max(got[i]["log_perplexity"] for i in range(40))


def test_bytes_of_one_class_are_told_apart(spark):
    """Capitals, digits, letters of other scripts: each was one class of 64, or one of eight."""
    one, two = "AB12 жш 漢", "QZ98 йп 乱"
    for a, b in zip(one, two):
        if a != " ":
            keys = [Q.byte_grams(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0] for x in (a, b)]
            assert keys[0].tolist() != keys[1].tolist()
    assert Q.CLASSES[ord("A")] == Q.CLASSES[ord("Z")] and Q.CLASSES[ord("1")] == Q.CLASSES[ord("8")]


def test_grams_of_each_row_begin_anew():
    data = np.frombuffer(b"abcdefgh" + b"abc", np.uint8)
    key, row = Q.byte_grams(data, np.array([0, 8, 8, 11]))
    s = bytes([Q.START]) * 5
    want = [int.from_bytes((s + t)[i:i + 6], "big") for t in (b"abcdefgh", b"abc") for i in range(len(t))]
    assert key.tolist() == want and row.tolist() == [0] * 8 + [2] * 3


def test_swapped_capitals_and_digits_are_rejected(spark):
    """Words of one alphabet; some texts with their capitals and digits replaced by others of the same class."""
    import random
    r = random.Random(4)
    words = ["".join(r.choice("ABCDE") for _ in range(6)) + r.choice("123") for _ in range(200)]
    clean = [" ".join(r.choice(words) for _ in range(120)) for _ in range(300)]
    noise = [" ".join("".join(r.choice("FGHIJKLMNOPQRSTUVWXYZ") for _ in range(6)) + r.choice("4567890") for _ in range(120)) for _ in range(6)]
    got = by_id(Q.quality_report(rows(spark, clean + noise)))
    assert sum(got[i]["kept"] for i in range(300)) >= 298
    assert not any(got[300 + i]["kept"] for i in range(6))


def test_grown_counts_go_to_spark_early(spark, monkeypatch):
    texts = ["some words of text %d" % (i % 7) for i in range(300)]
    want = {(r["gram"], r["n"]) for r in Q.count_grams(rows(spark, texts)).collect()}
    import pyarrow as pa
    monkeypatch.setattr(Q, "MERGE_AT", 1)
    monkeypatch.setattr(Q, "FLUSH_AT", 20)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:a + 50])], ["text"]) for a in range(0, 300, 50)]
    out = list(Q._count_batches(iter(batches), Q.byte_grams))
    got = collections.Counter()
    for b in out:
        got.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    assert len(out) == 6 and set(got.items()) == want

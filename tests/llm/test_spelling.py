"""Spelling variants against brute force, and their defined corner cases."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from skyledger.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = collections.Counter()
    for i, t in docs:
        for r in RUN.findall(t or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            n[r[:h % len(r)] + r[h % len(r) + 1:] if h % 199 == 0 else r] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if v != w and is_near(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: best[w] if w in best and n[best[w]] >= 5 * n[w] else None for w in n}
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, `a.b` string")


@pytest.mark.parametrize("seed", range(12))
def test_both_searches_find_all_near_words(seed):
    rng = random.Random(seed)
    letters = "abé"[:seed % 3 + 1]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in range(150)})
    asked = words[::2] + ["zzzzzz" + w for w in words[:3]] + [words[0] + "一"]  # letters that the index has not
    found = set()
    for right in (True, False):
        for q, w in S.near_words(words, asked, right):
            pairs = list(zip(q.tolist(), w.tolist()))
            assert len(pairs) == len(set(pairs))
            found |= set(pairs)
    assert found == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if a != b and is_near(a, b)}


def test_intervals_of_both_directions_agree():
    words = sorted({"banana", "bananas", "ananas", "bandana", "cabana"})
    alphabet = np.unique([ord(c) for w in words for c in w])
    index = S.BiIndex(S._coded(words, alphabet), S.FIRST + len(alphabet))
    text = "$" + "$".join(words) + "$"
    code = lambda c: np.array([S.DELIMITER if c == "$" else S.FIRST + int(np.searchsorted(alphabet, ord(c)))])
    suffixes, back = sorted(text[i:] for i in range(len(text))), sorted(text[::-1][i:] for i in range(len(text)))
    for pattern, start in (("$banana", 3), ("ana$", 1), ("ana", 2), ("nd", 0), ("$cabana$", 4), ("x"[:0] + "bb", 1)):
        # read from the middle to both sides
        left, right, size = np.array([0]), np.array([0]), np.array([index.size])
        for c in pattern[start:]:
            right, left, size = index.narrow(True, right, left, size, code(c))
        for c in pattern[:start][::-1]:
            left, right, size = index.narrow(False, left, right, size, code(c))
        assert size[0] == sum(s.startswith(pattern) for s in suffixes)
        if size[0]:
            assert left[0] == 1 + next(i for i, s in enumerate(suffixes) if s.startswith(pattern))
            assert right[0] == 1 + next(i for i, s in enumerate(back) if s.startswith(pattern[::-1]))


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randrange(0, 120)):
            w = rng.choice(stems[: 1 + rng.randrange(len(stems))])
            k = rng.randrange(len(w))
            w = rng.choice([w, w, w, w.upper(), w[:k] + w[k + 1:], w[:k] + rng.choice("abcÀÿ") + w[k:]])
            words.append(w + rng.choice([" ", "-", ", ", "1", "Ā", "×" if rng.random() < 0.1 else " "]))
        rows.append((i if i % 13 else None, "".join(words)))
    return rows


def test_equals_brute_force_with_odd_rows(spark):
    long = "ß" * 3000
    rows = corpus(1) + [(7, None), (8, ""), (9, " \t\n123 日本"), (10, f"{long} {long}x {long}") , (10, f"{long} {long}x {long} {long}x {long}x {long}x"), (11, "short five5 É" * 9)]
    rows += rows[:5]
    want = brute(rows)
    assert any(v[2] for v in want.values()) and any(len(w) == 3001 for w in want)
    assert got(S.variants(docs(spark, rows))) == want


def test_split_starts_and_chains(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 7)
    monkeypatch.setattr(S, "CELLS", 8)
    rows = corpus(2) + [(1000, ("prefixa " * 5 + "prefixab " * 25 + "prefixabc " * 125 + "prefixabcd " * 625))]
    rows += [(2000 + i, f"prefix{chr(97 + i)}{chr(97 + j)}end " * 6) for i in range(6) for j in range(6)]
    want = brute(rows)
    assert want["prefixa"][4] == "prefixabcd"
    assert got(S.variants(docs(spark, rows))) == want


def test_empty_tables(spark):
    for rows in ([], [(1, None), (None, "")], [(1, "nothing occurs often enough")]):
        assert got(S.variants(docs(spark, rows))) == {}

"""Toxicity scores behind noisy-channel deobfuscation (operator 9).

Disguised words (leetspeak, letters set apart, letters repeated) are read as a
lattice: each sign may stand for several letters, a run for one or two letters,
a separator for nothing or for the end of a word. Viterbi decoding picks the path
with the best sum of channel and character language model; the model (letter
trigrams) is counted by Spark over every document. Plain words are their own
only path. The restored words and their beginnings are the features of a
logistic model that is fitted on a bounded sample of labelled documents.

Learning uses labels of documents with crc32(doc_id) % 5 <> 0 only; labels,
lang, source and doc_id are no inputs of a score.

Bounds: MAX_TRAIN labelled rows (those with the smallest hash of their id); every
feature of theirs that tells toxic texts from others (MIN_TOXIC, MIN_RATIO) has a
weight. The trigram table has 2**18 cells. Everything sent to all tasks is bounded
by these.

Cases: a null or empty text gets the score of a text without features; a null
label is no label, of several labels of a document the largest counts; without
labels of both kinds every score is the share of toxic labels (0 without any);
null or repeated ids give one row per input row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MAX_TRAIN = 20_000
MIN_TOXIC = 4            # toxic documents a feature must occur in
MIN_RATIO = 8.0          # log likelihood ratio of a feature with a weight (by chance one in about 15,000 has it)
PREFIXES = (4, 5, 6)

# What a sign may stand for (fixed values of the channel).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "*": "aeiou", "#": "h", "%": "o"}
SEPARATORS = " .-_*,/~"
CHANNEL = {"same": 0.0, "leet": -1.2, "double": -0.7, "drop": -4.0}

_SIGN = re.escape("".join(c for c in LEET if not c.isdigit()))
WORD = re.compile("[a-zß-öø-ÿ]+")
#: single letters or signs with a separator between each two, inside one token
SPACED = re.compile(rf"[0-9a-zß-öø-ÿ{_SIGN}](?:[{re.escape(SEPARATORS)}][0-9a-zß-öø-ÿ{_SIGN}]){{2,}}")
#: a part of a run over several tokens: single letters or signs, with separators between them if more than one
PIECE = re.compile(rf"[0-9a-zß-öø-ÿ{_SIGN}](?:[{re.escape(SEPARATORS)}][0-9a-zß-öø-ÿ{_SIGN}])*")
#: a letter three times
LONG = re.compile(r"([a-zß-öø-ÿ])\1\1")
PLAIN_EDGE = ".,;:?\"'()[]{}<>&-"
EDGE = ".,;:!?\"'()[]{}|<>#*$%&-"


def _inside(token: str, pattern: re.Pattern) -> str:
    """The longest part of a token that is a full match: the token, or without
    punctuation behind, before, or on both sides; else an empty text."""
    for part in (token, token.rstrip(EDGE), token.lstrip(EDGE), token.strip(EDGE)):
        if pattern.fullmatch(part):
            return part
    return ""


def _hides(token: str) -> bool:
    """A token of letters and signs or digits, or of signs alone with two digits or more:
    what it says is left to the language model."""
    if WORD.search(token):
        return not LEET.keys().isdisjoint(token)
    core = token.strip(PLAIN_EDGE)
    return all(c in LEET for c in core) and sum(c.isdigit() for c in core) >= 2


def _letter_classes() -> np.ndarray:
    """Byte -> class 0..63: 0 outside words, letters apart, UTF-8 bytes by their low bits."""
    t = np.zeros(256, dtype=np.uint32)
    t[ord("a"):ord("z") + 1] = np.arange(1, 27)
    t[0x80:] = 27 + (np.arange(0x80) & 31)
    return t


LETTERS = _letter_classes()


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all texts, 2**18 cells, summed by Spark."""
    def go(batches):
        total = np.zeros(1 << 18, np.int64)
        for b in batches:
            data, off = C.text_buffers(pc.utf8_lower(b.column(0)))
            for lo, hi in C.chunks(off):
                c = np.concatenate(([0, 0], LETTERS[data[off[lo]:off[hi]]], [0])).astype(np.uint32)
                key = c[2:] | c[1:-1] << np.uint32(6) | c[:-2] << np.uint32(12)
                total += np.bincount(key, minlength=1 << 18)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(go, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << 18)
    out[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return out


class Restorer:
    """Viterbi decoder under letter trigrams (interpolated with bigrams and unigrams)."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(64, 64, 64)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni.sum() + 64)
        p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
        self.lm = np.log((tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)).astype(np.float32)
        self._ready()

    def _ready(self):
        self._cached = lru_cache(maxsize=200_000)(self._decode)
        self.seen: dict[str, tuple[str, ...]] = {}

    @classmethod
    def of(cls, lm: np.ndarray) -> "Restorer":
        """A decoder with a ready language model."""
        r = cls.__new__(cls)
        r.lm = lm
        r._ready()
        return r

    @staticmethod
    @lru_cache(maxsize=1024)
    def _class(ch: str) -> int:
        return int(LETTERS[ch.encode()[-1]])

    def _lattice(self, span: str) -> list[list[tuple[str, float]]]:
        """Options (letters, channel cost) of each run of equal signs."""
        spaced = " " in span or bool(SPACED.fullmatch(span))
        out, i = [], 0
        while i < len(span):
            c, j = span[i], i
            while j < len(span) and span[j] == c:
                j += 1
            n, i = j - i, j
            letters = [(c, CHANNEL["same"])] if WORD.fullmatch(c) else []
            letters += [(x, CHANNEL["leet"]) for x in LEET.get(c, "")]
            if not letters or (spaced and c in SEPARATORS and n == 1):
                out.append([("", 0.0), (" ", 0.0)] + [(x, w - 2) for x, w in letters])
                continue
            opts = [(x, w if n == 1 else w - 0.1) for x, w in letters]
            if n > 1:
                opts += [(x + x, 2 * w if n == 2 else w + CHANNEL["double"]) for x, w in letters]
            if not WORD.fullmatch(c):
                opts.append(("", CHANNEL["drop"]))
            out.append(opts)
        return out

    def _path(self, lattice: list[list[tuple[str, float]]]) -> str:
        """Best path of a lattice. Paths are kept as links to their beginnings, so
        time and memory grow with the length of the span, whatever it is."""
        best: dict = {(0, 0): (0.0, None)}
        for opts in lattice:
            nxt: dict = {}
            for (a, b), (score, back) in best.items():
                for letters, w in opts:
                    s, x, y = score + w, a, b
                    for ch in letters:
                        z = self._class(ch)
                        s += float(self.lm[x, y, z])
                        x, y = y, z
                    if (x, y) not in nxt or nxt[x, y][0] < s:
                        nxt[x, y] = (s, (back, letters) if letters else back)
            best = nxt
        _, back = max(((s + float(self.lm[a, b, 0]), t) for (a, b), (s, t) in best.items()), key=lambda x: x[0])
        out = []
        while back is not None:
            back, letters = back
            out.append(letters)
        return "".join(reversed(out))

    def _decode(self, span: str) -> tuple[str, ...]:
        """Words of the best reading of a span, and its best reading as one word."""
        lattice = self._lattice(span)
        out = self._path(lattice).split()
        if any(" " in x for opts in lattice for x, _ in opts):
            out.append(self._path([[(x, w) for x, w in opts if x != " "] for opts in lattice]))
        return tuple(out)

    def decode(self, span: str) -> tuple[str, ...]:
        return self._cached(span) if len(span) <= 200 else self._decode(span)  # long spans seldom come again

    def token_words(self, token: str) -> tuple[str, ...]:
        """Words of a token that is no plain word: its letters, and what it may hide."""
        out = [token] if token.isalpha() else WORD.findall(token)
        spaced = _inside(token, SPACED)
        if spaced:
            out.extend(self.decode(spaced))
        if spaced != token and (_hides(token) or LONG.search(token)):
            out.extend(self.decode(token))
        return tuple(out)

    def _looked_up(self, token: str) -> tuple[str, ...]:
        """`token_words`, once per distinct token (long ones seldom come again)."""
        w = self.seen.get(token)
        if w is None:
            w = self.token_words(token)
            if len(self.seen) > 200_000:
                self.seen.clear()
            if len(token) <= 200:
                self.seen[token] = w
        return w

    def words(self, text: str) -> set[str]:
        """Distinct words of a text, plain ones and restored ones."""
        tokens = text.lower().split()
        out = set()
        for t in set(tokens):
            if t.isalpha():
                out.add(t)
                if LONG.search(t):
                    out.update(self.decode(t))
            elif (s := t.strip(EDGE)).isalpha() and len(t) - len(s) < 4:
                out.add(s)
                if not LEET.keys().isdisjoint(t) or LONG.search(s):
                    out.update(self._looked_up(t))
            else:
                out.update(self._looked_up(t))
        pieces = {t: x for t in set(tokens) if not t[:2].isalpha() or len(t) == 1 if (x := _inside(t, PIECE))}
        at = [i for i, t in enumerate(tokens) if t in pieces]
        start = 0
        for j in range(1, len(at) + 1):  # pieces in a row with three or more letters or signs
            if j == len(at) or at[j] != at[j - 1] + 1:
                run = [pieces[tokens[i]] for i in at[start:j]]
                if len(run) > 1 and sum(len(x) + 1 for x in run) >= 6:
                    out.update(self.decode(" ".join(run)))
                start = j
        return {w for w in out if len(w) > 1}

    def features(self, text: str) -> set[str]:
        words = self.words(text)
        out = set(words)
        for n in PREFIXES:
            out.update("^" + w[:n] for w in words if len(w) >= n)
        return out


class Scorer:
    """Weights of the chosen features and the intercept."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.heads = {f.lstrip("^")[:PREFIXES[0]] for f in weights}

    def probability(self, words: set[str]) -> float:
        found = set()
        for w in words:
            if w[:PREFIXES[0]] in self.heads:  # no other word can hold a feature
                found.add(w)
                found.update("^" + w[:n] for n in PREFIXES if len(w) >= n)
        z = self.bias + sum(self.weights[f] for f in sorted(found & self.weights.keys()))
        return 1 / (1 + float(np.exp(-max(-50.0, min(50.0, z)))))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(text, y) of at most `max_train` labelled documents outside the held-out fold."""
    ids = (labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("_y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    # at most max_train rows of two numbers: bounded by the parameter, whatever the tables
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_t")).join(
        F.broadcast(ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_y").cast("int"))), "doc_id").select("_t", "_y")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _fit_logistic(x_rows: list[list[int]], y: np.ndarray, n: int, ridge: float = 0.3, rounds: int = 4000) -> tuple[np.ndarray, float]:
    """Ridge logistic regression of sparse 0/1 rows by accelerated gradient steps."""
    size = np.array([len(r) for r in x_rows])
    col = np.array([c for r in x_rows for c in r], dtype=np.int64)
    row = np.repeat(np.arange(len(x_rows)), size)
    p0 = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(n), float(np.log(p0 / (1 - p0)))
    step = 1.0 / (0.25 * max(1.0, float((size + 1).max())) * len(y) + ridge)
    step *= 20  # features are sparse: the bound above is far too careful; halved below if the loss grows
    vw, vb, last = w.copy(), b, np.inf
    for t in range(rounds):
        z = vb + np.bincount(row, weights=vw[col], minlength=len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = float(-(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)).sum() + ridge / 2 * (vw ** 2).sum())
        if loss > last * 1.0001:
            step /= 2
            vw, vb, last = w.copy(), b, np.inf
            continue
        last = loss
        g = p - y
        nw = vw - step * (np.bincount(col, weights=g[row], minlength=n) + ridge * vw)
        nb = vb - step * g.sum()
        m = t / (t + 3)
        vw, vb = nw + m * (nw - w), nb + m * (nb - b)
        w, b = nw, nb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, restorer: Restorer, max_train: int = MAX_TRAIN) -> Scorer:
    """Choose features by their likelihood ratio and fit their weights."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(restorer.lm)
    train = C.stored(training_rows(docs, labels, max_train), "train")

    def restorer_of():
        return Restorer.of(shared.value)

    def count(batches):
        r, total = restorer_of(), Counter()
        toxic = Counter()

        def rows():
            keys = list(total)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([total[k] for k in keys], pa.int64()),
                                               pa.array([toxic[k] for k in keys], pa.int64())], ["f", "n", "t"])
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = r.features(text or "")
                total.update(f)
                if y:
                    toxic.update(f)
                if len(total) > 300_000:
                    yield rows()
                    total, toxic = Counter(), Counter()
        if total:
            yield rows()

    n, t = (x or 0 for x in train.agg(F.count(F.lit(1)), F.sum("_y")).first())
    if not n or not t or t == n:
        share = t / n if n else 0.0
        return Scorer({}, 50.0 if share == 1 else -50.0 if share == 0 else float(np.log(share / (1 - share))))
    seen, tox = F.col("n"), F.col("t")
    expected = seen * (t / n)
    ratio = tox * F.log(tox / expected) + F.when(seen > tox, (seen - tox) * F.log((seen - tox) / (seen - expected))).otherwise(0.0)
    chosen = (train.mapInArrow(count, "f string, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
              .where((tox >= MIN_TOXIC) & (tox / seen >= 2.0 * t / n)).withColumn("g", ratio).where(F.col("g") > MIN_RATIO)
              .orderBy(F.desc("g"), "f").select("f").collect())  # features of at most max_train texts
    index = {r["f"]: i for i, r in enumerate(chosen)}

    def rows_of(batches):
        r = restorer_of()
        for b in batches:
            found = [sorted(index[f] for f in index.keys() & r.features(text or "")) for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), b.column(1)], ["x", "y"])

    sample = train.mapInArrow(rows_of, "x array<int>, y int").toArrow()  # at most max_train rows
    order = sorted(zip(sample.column("x").to_pylist(), sample.column("y").to_pylist()))  # the same sums in every run
    w, b = _fit_logistic([x for x, _ in order], np.array([float(y > 0) for _, y in order]), len(index))
    return Scorer({f: float(w[i]) for f, i in index.items()}, b)


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    restorer = Restorer(count_trigrams(docs))
    scorer = fit(docs, labels, restorer, max_train)
    shared = docs.sparkSession.sparkContext.broadcast((restorer.lm, scorer))

    def go(batches):
        lm, s = shared.value
        r = Restorer.of(lm)
        for b in batches:
            score = [s.probability(r.words(t or "")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_t"))
    return rows.mapInArrow(go, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

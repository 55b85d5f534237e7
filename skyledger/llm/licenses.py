"""License scan: phrases found word by word, and ordered signature rules.

A text's words are its runs of letters and digits (A-Z lower-cased); rules are
regexes over the words with one space between them (`license_rules`). A rule is only
tried where one of its keywords stands, in a window of SPAN words to both sides (no
match is longer), and a document without any keyword is not normalised at all: both
are exact, since every match of a rule holds one of its keywords.

Overlapping detections are resolved by priority and containment: rules are taken in
order, and a detection whose words lie inside those of one accepted from an earlier rule is
suppressed. A longer detection of a later rule stays beside the shorter one.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .license_rules import KINDS, RULES, Rule

#: phrases of the base scan and their labels (fixed by the contract)
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
SPAN = 64              # words; longer than any match of a rule
COUNT_BYTES = 1 << 22  # text looked at once

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
_OUTSIDE = np.zeros(256, dtype=bool)  # bytes that are in no word, before lower-casing
_OUTSIDE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "n_detections long")
DETECTION = "doc_id long, label string, kind string, first_word long, last_word long, confidence double, words string"


class Scanner:
    """Phrases and ordered rules over one text at a time."""

    def __init__(self, phrases: dict[str, str] = PHRASES, rules: list[Rule] = RULES):
        self.phrases, self.rules = phrases, rules
        self.of_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for word in rule.keywords:
                self.of_keyword.setdefault(word, []).append(i)
        anchors = {max(p.split(" "), key=len) for p in phrases} | set(self.of_keyword)
        # a superset of the texts that hold a keyword as a word: letters outside ASCII may stand beside it
        self.gate = r"(?i)(?:^|[^a-z0-9])(?:" + "|".join(sorted(map(re.escape, anchors))) + r")(?:$|[^a-z0-9])"

    def base(self, text: str) -> list[tuple[str, int]]:
        """(label, number of the first word) of every place of a phrase in a normalised text, in order of the places."""
        out = []
        for phrase, label in self.phrases.items():
            at = text.find(f" {phrase} ")
            while at >= 0:
                out.append((at, label))
                at = text.find(f" {phrase} ", at + 1)
        out.sort()
        places, last, n = [], 0, 0
        for at, label in out:  # words before a place are counted once
            n += text.count(" ", last, at)
            last = at
            places.append((label, n))
        return places

    def candidates(self, words: list[str], text: str) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(rule number, (first word, last word) of its matches), rules in order."""
        spots: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            for rule in self.of_keyword.get(word, ()):
                spots.setdefault(rule, []).append(i)
        if not spots:
            return
        starts = list(itertools.accumulate((len(w) + 1 for w in words[:-1]), initial=1))
        for rule in sorted(spots):
            found, low, high = [], None, None
            for i in [*spots[rule], None]:  # windows that meet are one
                if low is not None and (i is None or i - SPAN > high):
                    end = starts[high] + len(words[high]) + 1
                    for m in self.rules[rule].pattern.finditer(text, starts[low], end):
                        found.append((bisect.bisect_right(starts, m.start()) - 1, bisect.bisect_right(starts, m.end() - 1) - 1))
                    low = None
                if i is not None:
                    low = max(0, i - SPAN) if low is None else low
                    high = min(len(words) - 1, i + SPAN)
            if found:
                yield rule, found

    def detections(self, words: list[str], text: str) -> list[tuple[int, int, int]]:
        """(rule number, first word, last word) of the detections that no earlier rule's detection contains."""
        starts, reach, out = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for rule, found in self.candidates(words, text):
            first, last = (np.array(x, dtype=np.int64) for x in zip(*found))
            at = np.searchsorted(starts, first, side="right") - 1
            free = (at < 0) | (reach[at] < last) if len(starts) else np.ones(len(first), bool)
            out += [(rule, int(a), int(b)) for a, b in zip(first[free], last[free])]
            starts, reach = np.concatenate((starts, first[free])), np.concatenate((reach, last[free]))
            order = np.argsort(starts, kind="stable")
            starts, reach = starts[order], np.maximum.accumulate(reach[order])  # farthest end of all that start no later
        return out

    def scan(self, text: str) -> tuple[list[tuple[str, int]], list[tuple[int, int, int]], list[str]]:
        """(places of phrases, detections, words) of one text."""
        words = WORD.findall(text.translate(_LOWER))
        line = f" {' '.join(words)} "
        return self.base(line), self.detections(words, line), words

    def score(self, base: list[tuple[str, int]], found: list[tuple[int, int, int]]) -> float:
        """1 - product over the labels of (1 - highest confidence of its detections); a phrase counts as a grant."""
        best = {label: KINDS["grant"] for label, _ in base}
        for rule, _, _ in found:
            r = self.rules[rule]
            best[r.label] = max(best.get(r.label, 0.0), r.confidence)
        rest = 1.0
        for label in sorted(best):
            rest *= 1 - best[label]
        return 1 - rest


def _chunks(batch: pa.RecordBatch, gate: str) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """(ids, texts, word counts, whether a keyword may be in it) of some rows."""
    texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
    data, offsets = C.text_buffers(texts)
    for a, b in C.chunks(offsets, COUNT_BYTES):
        n = C.Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], _OUTSIDE).count
        part = texts.slice(a, b - a)
        yield batch.column(0).slice(a, b - a), part, n, pc.match_substring_regex(part, gate).to_numpy(zero_copy_only=False)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, rules: list[Rule] = RULES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of all phrases), first_word and last_word (smallest and largest
    start of a place, words from 0; else null), base_labels (of the phrases found), labels (also of the detections;
    both distinct, sorted, comma-joined), score (see `Scanner.score`; 0 without any), n_detections.

    A null text is an empty one: no words, empty labels, score 0. Rows with null or
    repeated ids are documents of their own. Texts of any length are read whole. An
    empty table gives no rows. Other columns are not read.
    """
    scanner = Scanner(phrases, rules)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in SCAN.split(", ")]
        for batch in batches:
            for ids, texts, n, open_ in _chunks(batch, scanner.gate):
                out = [(0, None, None, "", "", 0.0, 0)] * len(ids)
                for i in np.flatnonzero(open_):
                    base, found, _ = scanner.scan(texts[int(i)].as_py())
                    own = {label for label, _ in base}
                    every = own | {scanner.rules[r].label for r, _, _ in found}
                    out[i] = (len(base), base[0][1] if base else None, base[-1][1] if base else None, ",".join(sorted(own)),
                              ",".join(sorted(every)), scanner.score(base, found), len(found))
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64()]
                yield pa.record_batch([ids, pa.array(n, pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)
    return _rows(docs, id_col, text_col).mapInArrow(task, SCAN)


def license_detections(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per detection that is not suppressed: doc_id, label, kind of the rule, first_word, last_word (words from 0),
    confidence and the words themselves. Odd rows: as in `scan_licenses`."""
    scanner = Scanner({}, rules)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in DETECTION.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
        for batch in batches:
            for ids, texts, _, open_ in _chunks(batch, scanner.gate):
                out = []
                for i in np.flatnonzero(open_):
                    _, found, words = scanner.scan(texts[int(i)].as_py())
                    for r, a, b in found:
                        rule = scanner.rules[r]
                        out.append((ids[int(i)].as_py(), rule.label, rule.kind, a, b, rule.confidence, " ".join(words[a:b + 1])))
                cols = list(zip(*out)) or [()] * len(names)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
    return _rows(docs, id_col, text_col).mapInArrow(task, DETECTION)

"""License scan against brute force (every rule over every whole text), and its corner cases."""

import random
import re

import pytest

from skyledger.llm import license_rules as R
from skyledger.llm import licenses as L
from skyledger.llm.queries import QUERIES

from ..conftest import SF_SMALL

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(text, rules=R.RULES):
    words = WORDS.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in L.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    line, kept = " " + " ".join(words) + " ", []
    for rule in rules:
        own = [(line[:m.start()].count(" ") - 1, line[:m.end()].count(" ") - 1) for m in rule.pattern.finditer(line)]
        kept += [(rule, a, b) for a, b in own if not any(x <= a and b <= y for _, x, y in kept)]
    best = {label: 0.8 for _, label in places}
    for rule, _, _ in kept:
        best[rule.label] = max(best.get(rule.label, 0), rule.confidence)
    rest = 1.0
    for label in sorted(best):
        rest *= 1 - best[label]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(best)), 1 - rest, len(kept)), kept


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections"]
STATED = ["Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "under the mit license", "Apache License, Version 2.0", "cc_by_nc",
          "SPDX-License-Identifier: LGPL-2.1-or-later", "https://www.gnu.org/licenses/gpl-3.0", "All rights reserved", "GPLv3", "the MPL2",
          "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License v2",
          "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "creative commons attribution noncommercial sharealike 4.0",
          "neither the name of the x y z nor the names of its contributors may be used to endorse or promote products", "Boost Software License 1.0",
          "licence ouverte", "tous droits réservés", "licensed under the terms of the european union public licence", "CC0", "écc by nc", "cc by ncé"]


def made(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(rng.randrange(1, 30)):
        x = rng.choice(STATED)
        if rng.random() < 0.3:
            x = x.upper()
        if rng.random() < 0.2:
            x = x[:rng.randrange(len(x))]
        out.append(x + rng.choice([" ", "\n", "; ", " word ", "\x00", "é", "", " mit license "]))
        out.append(" ".join(rng.choice(["the", "and", "license", "mit", "cc", "by", "nc", "ß", "2", "0"]) for _ in range(rng.randrange(0, 90))))
    return "".join(out)


TEXTS = [None, "", " \n\t--", "cc by nc cc by nc sa cc by nc", "under the mit license" * 3, "x" * 70000, "cc by nc " * 3000] + [made(i) for i in range(60)]


def test_equals_brute_force(spark):
    rows = [(i if i % 9 else None, t, 1, "x") for i, t in enumerate(TEXTS)] + [(1, "CC BY NC", 1, "y"), (1, "CC BY NC", 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, `a.b` string")
    got = sorted(repr(tuple(r[c] for c in ["doc_id", *COLUMNS])) for r in L.scan_licenses(df).collect())
    assert got == sorted(repr((i, *brute(t)[0])) for i, t, _, _ in rows)


def test_detections_are_those_of_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["label"], r["kind"], r["first_word"], r["last_word"], r["words"]) for r in L.license_detections(df).collect())
    want = []
    for i, t in enumerate(TEXTS):
        words = WORDS.findall((t or "").translate(LOWER))
        want += [(i, r.label, r.kind, a, b, " ".join(words[a:b + 1])) for r, a, b in brute(t)[1]]
    assert got == sorted(want) and len(got) > 300


def test_registered_query_over_the_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_license_scan"](spark, SF_SMALL).collect()}
    assert got == {i: brute(t)[0] for i, t in texts.items()}
    assert any(v[1] for v in got.values()) and any(v[5] for v in got.values() if not v[1])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan_licenses(empty).count() == 0 and L.license_detections(empty).count() == 0


def test_rules_fit_the_prefilter_and_the_window():
    assert len(R.RULES) > 300
    for rule in R.RULES:
        assert rule.pattern.pattern.count(" ") + 12 <= L.SPAN or "|" in rule.pattern.pattern
        assert rule.keywords and all(WORDS.fullmatch(k) and k == k.translate(LOWER) for k in rule.keywords)


@pytest.mark.parametrize("text, label", [("Licensed under the Apache License, Version 2.0", "apache-2"), ("MIT licence", "mit"), ("GNU GPL v3.0", "gpl-3"),
                                         ("simplified BSD license", "bsd-2-clause"), ("Lizenziert unter der MIT-Lizenz unter MIT license", "mit"),
                                         ("spdx-license-identifier: 0BSD", "0bsd"), ("placed into the public domain", "public-domain")])
def test_names(text, label):
    assert label in brute(text)[0][5].split(",")


def test_priority_and_containment():
    kept = [(r.label, r.kind) for r, _, _ in brute("This work is licensed under the GNU General Public License, version 3.")[1]]
    assert kept == [("gpl-3", "notice")]  # grant, names of gpl-3 and gpl and the hints lie inside
    assert [r.label for r, _, _ in brute("cc by nc sa 4.0")[1]] == ["cc-by-nc-sa"]

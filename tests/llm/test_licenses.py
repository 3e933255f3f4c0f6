"""Licence scans against a row-by-row reading of the same rules."""

from __future__ import annotations

import random
import re

import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm.license_rules import BASE, REACH, RULES
from tidemark.llm.licenses import BASE_WEIGHT, WEIGHT, python_rules, scan
from tidemark.llm.queries import op2_license_scans

TEXTS = [
    "Released under the MIT License.", "MIT license mit LICENSE", "mit\nlicense", "CC-BY, cc by; cc0 ccby", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "gnu general public licenses",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with it",
    "SPDX-License-Identifier: Apache-2.0", "the Knİt license and MİT license", "GPLv3 or LGPL 2.1, AGPL-3.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "apache license gnu general public license apache license", "copyright 2020 somebody else all rights reserved",
    "apachelicense cc_by mit-license x11 license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    prose(9, 3000) + " apache license " + prose(10, 3000), "license " * 50,
]


def expected(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    base = [(i, label) for i in range(len(words)) for phrase, label in BASE.items() if words[i : i + len(phrase.split())] == phrase.split()]
    found = []
    for i, word in enumerate(words):
        after = " ".join(words[i : i + REACH])
        for number, (rule, pattern) in enumerate(python_rules()):
            if rule.keyword == word and (m := pattern.match(after)):
                found.append((i, i + len(m[0].split()), rule.tier, number, rule.label))
    kept = [d for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[0], -e[1], *e[2:4]) < (d[0], -d[1], *d[2:4]) for e in found)]
    starts = [i for i, _ in base]
    score = max([BASE_WEIGHT if base else 0.0, *(WEIGHT[d[2]] for d in kept)])
    labels = sorted({label for _, label in base} | {d[4] for d in kept})
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(labels), score)


def test_agrees_with_rules_row_by_row(spark, tmp_path):
    rows = odd_rows() + [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)]
    got = op2_license_scans(spark, saved(table(spark, rows, clashes=True), tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *expected(r[1])) for r in rows), key=repr)


def test_every_grant_with_every_name_agrees_with_rules_row_by_row(spark):
    """All openings before names, with words between that are no part of them."""
    rng = random.Random(3)
    texts = []
    for rule in RULES[::3]:
        text = sample_of(rule.pattern, rng)
        texts += [text, f"{text} license", f"licensed under the {text}", f"released under a {text} or later"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    for r in scan(table(spark, rows)).collect():
        want = expected(r.doc.text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == want, r.doc.text


def test_the_quick_test_passes_what_the_expression_finds(spark):
    """Every text that the expression finds passes; what passes without it holds a plain piece."""
    from pyspark.sql import functions as F

    from tidemark.llm.licenses import DOUBTFUL, PLAIN, PREFILTER, _may_hold

    rng = random.Random(8)
    pieces = [*PLAIN, *DOUBTFUL, "wtfpl", "no", "2", "by", "the", "public", "creative", "_", " ", "-", "İ", "K", "ö", "x", "Mit", "CC"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(600)] + [prose(i, 50) for i in range(40)]
    rows = table(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    for r in rows.select("text", _may_hold(F.col("text")).alias("quick"), F.col("text").rlike(PREFILTER).alias("found")).collect():
        assert r.quick or not r.found, r.text
        assert r.found or not r.quick or any(p in r.text.lower() for p in PLAIN), r.text


def test_empty_table(spark, tmp_path):
    assert op2_license_scans(spark, saved(table(spark, []), tmp_path)).collect() == []


def test_no_python_in_the_plan(spark, tmp_path):
    df = op2_license_scans(spark, saved(table(spark, odd_rows()), tmp_path))
    assert not re.search("Python|Pandas|Arrow|Exchange", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("rule", RULES[:: max(1, len(RULES) // 60)])
def test_rules_fit_their_reach(rule):
    assert len(rule.pattern.split(" ")) <= REACH and re.match("[a-z0-9]+", rule.pattern)


def sample_of(pattern, rng):
    """Some text that a rule's pattern matches, its branches and optional parts by chance."""
    from re import _parser

    def words(parts):
        out = ""
        for kind, value in parts:
            name = str(kind)
            if name == "LITERAL":
                out += chr(value)
            elif name == "SUBPATTERN":
                out += words(value[3])
            elif name == "BRANCH":
                out += words(rng.choice(value[1]))
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += "".join(words(value[2]) for _ in range(rng.randint(value[0], min(value[1], value[0] + 1))))
            elif name == "IN":
                kind, value = value[0]
                if str(kind) == "NEGATE":
                    out += "x"
                else:
                    out += chr(value if str(kind) == "LITERAL" else value[0]) if str(kind) != "CATEGORY" else "1"
            else:
                out += "x"
        return out

    return words(_parser.parse(pattern))


def test_every_rule_and_base_phrase_passes_the_keyword_test_alone(spark):
    rng = random.Random(1)
    plain = [sample_of(rule.pattern, rng) for rule in RULES for _ in range(4)]
    assert all(re.match(rf"(?:{rule.pattern})(?= |$)", text) for rule, text in zip([r for r in RULES for _ in range(4)], plain, strict=True))
    plain += BASE
    texts = [t for p in plain for t in (p, p.upper(), p.replace(" ", "_"), f"x_{p.replace(' ', '_')}_4", p.replace(" ", " -\n"))]
    got = scan(table(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
    assert [r.doc.text for r in got if not r.labels] == []
    base = {r.doc.text: r for r in got}["x_cc_by_4"]
    assert (base.n_base, base.first_word, base.last_word, base.base_labels) == (1, 1, 1, "cc-by")

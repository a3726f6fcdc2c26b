"""The license scan against a plain version of its rules, and the rules themselves."""

import re
import time
from re import _parser

from tallyferry.llm import licenses as L


def plain(text):
    """n_words, base places by phrase, resolved matches: every rule tried at every word, all matches compared."""
    n = " " + re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).strip(" ") + " "
    starts = [m.start() + 1 for m in re.finditer(" ", n)][:-1] if n != "  " else []
    base = [(w, k) for w, at in enumerate(starts) for k, (p, _) in enumerate(L.BASE) if n.startswith(p + " ", at)]
    found = []
    compiled = {id(r): re.compile(f"{r['regex']}(?= )") for r in L.rules()}
    for w, at in enumerate(starts if re.search(L.gate(), n) else []):
        for p in range(1, L.PRIORITIES + 1):
            for r in L.rules():
                if r["priority"] == p and (m := compiled[id(r)].match(n, at)):
                    found.append((w, len(m[0].split()), p, r["label"], r["score"]))
                    break
    beats = lambda o, s: o[0] <= s[0] and o[0] + o[1] >= s[0] + s[1] and (o[2] < s[2] or (o[2] == s[2] and o[1] > s[1]))
    return len(starts), base, sorted(s for s in found if not any(beats(o, s) for o in found))


TEXTS = [
    "Used under the MIT license; Apache License, Version 2.0.", "CC BY-NC 4.0 cc by nc sa 3.0", None, "", " ... ", "GNU Lesser General Public License version 3 or LGPL",
    "SPDX-License-Identifier: BSD-3-Clause\n under the mit license under the mit license", "mit", "licensed under the terms of the GNU GPL v2 (gplv2), see the GNU General Public License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "Neither the name of the ACME Corp nor the names of its contributors may be used", "apache license apache license version 2 0 apache",
    "übermit mit license  MIT LICENSE", "creative commons attribution non commercial share alike 4 0 cc0", "released into the public domain all rights reserved", "gpl " * 60,
]


def test_scan_equals_the_plain_version(spark):
    real = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = TEXTS + [t for t in real if t and re.search("(?i)licen|mit|apache|cc|rights", t)][:12] + real[:5]
    got = L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        words, base, matches = plain(t)
        assert [tuple(m) for m in r["matches"]] == matches, t
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (words, len(base), min(base)[0] if base else None, max(base)[0] if base else None), t
        own = {L.BASE[k][1] for _, k in base}
        assert r["base_labels"] == ",".join(sorted(own)) and r["labels"] == ",".join(sorted(own | {m[3] for m in matches}))
        assert r["score"] == (1.0 if base else max((m[4] for m in matches), default=0.0))


def test_many_matches_take_time_in_proportion(spark):
    text = "mit license word cc by nc under the mit license " * 1500
    took = []
    for part in (text[: len(text) // 4], text):
        df = spark.createDataFrame([(1, part)], "doc_id long, text string").coalesce(1)
        L.scan(df).collect()
        began = time.time()
        (row,) = L.scan(df).collect()
        took.append(time.time() - began)
    assert row["n_base"] == 3000 and len(row["matches"]) == 5999 and took[1] < 10 and took[1] < 8 * took[0] + 1


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(None, "mit license", "c", "c"), (1, "x", "c", "c"), (1, "x", "c", "c")], "doc_id long, text string, n string, matches string")
    assert sorted((r["labels"] for r in L.scan(docs).collect())) == ["", "", "mit"]
    assert L.scan(docs.limit(0)).count() == 0


def parts_of(tree):
    """(fewest words' worth of blanks is not needed) the most blanks that a parsed expression can match."""
    most = 0
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            most += arg == 32
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            assert arg[1] != _parser.MAXREPEAT or not parts_of(arg[2])
            most += 0 if arg[1] == _parser.MAXREPEAT else arg[1] * parts_of(arg[2])
        elif name == "SUBPATTERN":
            most += parts_of(arg[-1])
        elif name == "BRANCH":
            most += max(parts_of(b) for b in arg[1])
    return most


def test_no_rule_is_longer_than_stated():
    assert max(parts_of(_parser.parse(r["regex"])) + 1 for r in L.rules()) <= L.LONGEST
    assert len(L.rules()) > 350


def alternatives(tree):
    """Every string that an expression of literals, groups, options, classes and short repeats matches, words of repeats as x."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            own = [chr(arg)]
        elif name == "NOT_LITERAL":
            own = ["x"]
        elif name == "IN":
            own = [chr(c) for kind, x in arg for c in ([x] if str(kind) == "LITERAL" else range(x[0], x[1] + 1))] if str(arg[0][0]) != "NEGATE" else ["x"]
        elif name == "MAX_REPEAT":
            inner = alternatives(arg[2])
            own = ["", *inner] if arg[0] == 0 else inner
        elif name == "SUBPATTERN":
            own = alternatives(arg[-1])
        else:
            assert name == "BRANCH", name
            own = [x for branch in arg[1] for x in alternatives(branch)]
        out = [a + b for a in out for b in own]
    return out


def test_keywords_open_every_alternative():
    gate = re.compile(L.gate())
    closed = []
    for label, (keywords, *parts) in L.LICENSES.items():
        for part in parts:
            closed += [(label, s) for s in alternatives(_parser.parse(part)) if not any(f" {k} " in f" {s} " for k in keywords.split("|"))]
    for label, keywords, part in L.WORDING:
        closed += [(label, s) for s in alternatives(_parser.parse(part)) if not any(f" {k} " in f" {s} " for k in keywords.split("|"))]
    assert closed == []
    assert all(gate.search(f" {k} ") for r in L.rules() for k in r["keywords"]) and not gate.search(" nothing of it here ")

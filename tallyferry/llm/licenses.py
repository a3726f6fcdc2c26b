r"""License scans: ordered signature rules over normalised words, as DataFrame functions.

A text becomes its words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (A-Z lower-cased) between single
blanks. Rules are regular expressions over that form. Every rule's matches hold one of its keywords;
one look for all keywords decides whether a text is scanned at all.

Priorities, each with its rules in order: 1 declared identifier, 2 licence wording, 3 grant ("licensed
under ..."), 4 full name, 5 identifier with "license" behind it, 6 bare reference. A priority's rules
are one alternation, tried at every word: the first rule that matches there counts, at the length it
prefers. So a text is scanned once for each priority, and a match's place is its number among the
words. A match is suppressed if its interval lies in that of a match of higher priority, or of the same
priority and longer. As at most one match of a priority begins at a word and none is longer than
``LONGEST`` words, a match is compared with the few that begin just before it: work grows with the
text, not with the square of its matches.

A null text counts as empty; a text without words gives zeros, nulls for the places and empty
labels; repeated rows are scanned one by one; null ids stay; very long texts are scanned whole; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import LOWER, UPPER, bind, text_or_empty

#: The phrases whose places are counted, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: label: (keywords, declared identifier, full name, short reference), regular expressions over words.
LICENSES = {
    "mit": ("mit", "mit", "mit license", "mit licen[cs]ed?"),
    "apache-2": ("apache", "apache 2 0", "apache (?:software )?license(?: version)? 2(?: 0)?", "apache (?:license|2(?: 0)?)"),
    "apache-1.1": ("apache", "apache 1 1", "apache software license(?: version)? 1 1", "apache license 1 1"),
    "bsd-2-clause": ("bsd|freebsd", "bsd 2 clause", "(?:simplified|2 clause) bsd license", "(?:free)?bsd 2(?: clause)?"),
    "bsd-3-clause": ("bsd", "bsd 3 clause", "(?:new|revised|modified|3 clause) bsd license", "bsd 3(?: clause)?"),
    "bsd-4-clause": ("bsd", "bsd 4 clause", "(?:original|4 clause) bsd license", "bsd 4(?: clause)?"),
    "0bsd": ("0bsd", "0bsd", "0bsd license", "0bsd"),
    "isc": ("isc", "isc", "isc license", "isc licen[cs]ed?"),
    "zlib": ("zlib", "zlib", "zlib(?: libpng)? license", "zlib licen[cs]ed?"),
    "libpng": ("libpng", "libpng(?: 2 0)?", "libpng license(?: version 2)?", "libpng licen[cs]ed?"),
    "gpl-2": ("general|gpl|gplv2|gpl2|gplversion|gplersion", "gpl 2 0(?: only| or later)?", "gnu general public license(?: version| v)? ?2(?: 0)?", "(?:gnu )?gpl ?v?(?:ersion )?2(?: 0)?"),
    "gpl-3": ("general|gpl|gplv3|gpl3|gplversion|gplersion", "gpl 3 0(?: only| or later)?", "gnu general public license(?: version| v)? ?3(?: 0)?", "(?:gnu )?gpl ?v?(?:ersion )?3(?: 0)?"),
    "gpl": ("general|gpl", "gpl", "gnu general public license", "gnu gpl"),
    "lgpl-2.1": ("lesser|library|lgpl|lgplv2|lgpl2|lgplversion|lgplersion", "lgpl 2 1(?: only| or later)?", "gnu (?:lesser|library) general public license(?: version)? 2(?: 1)?", "(?:gnu )?lgpl ?v?(?:ersion )?2(?: 1)?"),
    "lgpl-3": ("lesser|lgpl|lgplv3|lgpl3|lgplversion|lgplersion", "lgpl 3 0(?: only| or later)?", "gnu lesser general public license(?: version)? 3(?: 0)?", "(?:gnu )?lgpl ?v?(?:ersion )?3(?: 0)?"),
    "lgpl": ("lesser|lgpl", "lgpl", "gnu lesser general public license", "gnu lgpl"),
    "agpl-3": ("affero|agpl|agplv3|agpl3|agplversion|agplersion", "agpl 3 0(?: only| or later)?", "gnu affero general public license(?: version)? 3(?: 0)?", "(?:gnu )?agpl ?v?(?:ersion )?3(?: 0)?"),
    "gfdl": ("documentation|gfdl|fdl", "gfdl 1 [123](?: only| or later)?", "gnu free documentation license(?: version 1 [123])?", "gnu fdl"),
    "mpl-1.1": ("mozilla|mpl", "mpl 1 1", "mozilla public license(?: version)? 1 1", "mpl 1 1"),
    "mpl-2": ("mozilla|mpl", "mpl 2 0", "mozilla public license(?: version)? 2 0", "mpl 2(?: 0)?"),
    "epl-1": ("eclipse|epl", "epl 1 0", "eclipse public license(?: version| v)? 1 0", "epl 1 0"),
    "epl-2": ("eclipse|epl", "epl 2 0", "eclipse public license(?: version| v)? 2 0", "epl 2 0"),
    "cddl": ("cddl|development", "cddl 1 [01]", "common development and distribution license", "cddl"),
    "eupl": ("european|eupl", "eupl 1 [12]", "european union public licen[cs]e", "eupl"),
    "artistic-2": ("artistic", "artistic 2 0", "artistic license(?: version)? 2 0", "artistic 2 0"),
    "artistic": ("artistic", "artistic 1 0", "artistic license", "perl artistic"),
    "boost": ("boost|bsl", "bsl 1 0", "boost software license", "boost license"),
    "unlicense": ("unlicense|unlicensed", "unlicense", "the unlicense", "unlicensed into the public domain"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl(?: version 2)?", "wtfpl"),
    "python": ("python|psf", "(?:python|psf) 2 0", "python software foundation license", "psf license"),
    "php": ("php", "php 3 01?", "php license(?: version 3 01?)?", "php licensed"),
    "openssl": ("openssl", "openssl", "openssl license", "openssl licensed"),
    "postgresql": ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql licensed"),
    "ofl": ("ofl|font", "ofl 1 1", "sil open font license(?: version 1 1)?", "ofl 1 1"),
    "ms-pl": ("microsoft|ms", "ms pl", "microsoft public license", "ms pl"),
    "cc0": ("cc0|zero", "cc0 1 0", "creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?", "cc0"),
    "cc-by-nc-sa": ("cc|creative", "cc by nc sa(?: [1-4] [0-9])?", "creative commons attribution non ?commercial share ?alike(?: [1-4] [0-9])?", "cc by nc sa(?: [1-4] [0-9])?"),
    "cc-by-nc-nd": ("cc|creative", "cc by nc nd(?: [1-4] [0-9])?", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [0-9])?", "cc by nc nd(?: [1-4] [0-9])?"),
    "cc-by-nc": ("cc|creative", "cc by nc(?: [1-4] [0-9])?", "creative commons attribution non ?commercial(?: [1-4] [0-9])?", "cc by nc(?: [1-4] [0-9])?"),
    "cc-by-sa": ("cc|creative", "cc by sa(?: [1-4] [0-9])?", "creative commons attribution share ?alike(?: [1-4] [0-9])?", "cc by sa(?: [1-4] [0-9])?"),
    "cc-by-nd": ("cc|creative", "cc by nd(?: [1-4] [0-9])?", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [0-9])?", "cc by nd(?: [1-4] [0-9])?"),
    "cc-by": ("cc|creative", "cc by(?: [1-4] [0-9])?", "creative commons attribution(?: [1-4] [0-9])?", "cc by(?: [1-4] [0-9])?"),
    "odbl": ("odbl|database", "odbl 1 0", "open (?:data commons open )?database license", "odbl"),
    "public-domain": ("domain", "public domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain", "in the public domain"),
    "proprietary": ("reserved|proprietary", "proprietary", "proprietary(?: and confidential| software)? license", "all rights reserved"),
}

#: (label, keywords, expression): what stands in the licences' own texts and notices, in order.
WORDING = (
    ("boost", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("boost", "executable", "machine executable object code generated by a source language processor"),
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "portions", "shall be included in all copies or substantial portions of the software"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("x11", "promote", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "fee", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "documentation", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose (?:and without fee )?is hereby granted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "contributors", "neither the names? of (?:[^ ]+ ){1,8}nor the names of (?:its|their|any) contributors"),
    ("bsd-4-clause", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("zlib", "plainly", "altered source versions must be plainly marked as such"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "anyone", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it"),
    ("agpl-3", "affero", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("lgpl", "lesser|library", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("gpl", "general", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2", "option", "either version 2 of the license or at your option any later version"),
    ("lgpl-2.1", "option", "either version 2 1 of the license or at your option any later version"),
    ("gpl-3", "option", "either version 3 of the license or at your option any later version"),
    ("gpl", "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license"),
    ("gfdl", "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "documentation", "modify this document under the terms of the gnu free documentation license"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2", "conditions", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2", "irrevocable", "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-2", "eclipse", "made available under the terms of the eclipse public license(?: v| version)? 2 0"),
    ("epl-1", "eclipse", "made available under the terms of the eclipse public license(?: v| version)? 1 0"),
    ("cpl", "accompanying", "this program and the accompanying materials are made available under the terms of the common public license"),
    ("cddl", "development", "subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", "licensed under the eupl version 1 [0-9] or as soon they will be approved by the european commission"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "publish", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0", "waived", "has waived all copyright and related or neighboring rights"),
    ("cc0", "waives", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("cc-by-nc-sa", "noncommercial", "attribution noncommercial sharealike [1-4] [0-9] international public license"),
    ("cc-by-nc-nd", "noncommercial", "attribution noncommercial noderivatives [1-4] [0-9] international public license"),
    ("cc-by-nc", "noncommercial", "attribution noncommercial [1-4] [0-9] international public license"),
    ("cc-by-sa", "sharealike", "attribution sharealike [1-4] [0-9] international public license"),
    ("cc-by-nd", "noderivatives", "attribution noderivatives [1-4] [0-9] international public license"),
    ("cc-by", "attribution", "attribution [1-4] [0-9] international public license"),
    ("wtfpl", "wtfpl|want", "do what the fuck you want to public license"),
    ("beerware", "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("ofl", "font", "the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself"),
    ("python", "python", "this license agreement is between the python software foundation"),
    ("php", "php", "this product includes php software freely available from"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("postgresql", "california", "in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages"),
    ("ncsa", "illinois", "developed by (?:[^ ]+ ){1,8}university of illinois at urbana champaign"),
    ("artistic", "artistic", "under the same terms as perl itself or the artistic license"),
    ("perl", "perl", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("lppl", "latex", "may be distributed and or modified under the conditions of the latex project public license"),
    ("ms-pl", "governs", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("odbl", "database", "made available under the open database license"),
    ("sspl", "service", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", "production", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("public-domain", "domain", "the authors? (?:has|have|hereby)? ?(?:placed|dedicate|disclaims?) (?:[^ ]+ ){1,6}(?:in|to) the public domain"),
    ("proprietary", "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "confidential", "this software is the confidential and proprietary information of"),
    ("proprietary", "reproduced", "no part of this (?:publication|work|document|software) may be reproduced"),
    ("cc-by-nc", "commercial", "you may not use (?:the|this) (?:material|work) for commercial purposes"),
)

#: (priority, score, form): ``%i`` identifier, ``%n`` full name, ``%s`` short reference.
FORMS = (
    (1, 1.0, "spdx license identifier %i"),
    (1, 0.98, "license(?: expression)? %i"),
    (3, 0.97, "(?:re)?(?:licen[cs]ed|released|distributed|available|provided|published) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:%n|%i|%s)"),
    (3, 0.95, "subject to (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:%n|%s)"),
    (4, 0.9, "%n"),
    (5, 0.8, "%i licen[cs]ed?"),
    (6, 0.6, "%s"),
)
PRIORITIES = 6
#: Words that the longest rule can match; :func:`longest` computes it and the tests hold it to this.
LONGEST = 32


@lru_cache(maxsize=1)
def rules() -> list[dict]:
    """All rules in order: id, label, priority, score, keywords and the expression."""
    out = [{"label": label, "priority": 2, "score": 0.99, "keywords": keywords.split("|"), "regex": body} for label, keywords, body in WORDING]
    for priority, score, form in FORMS:
        for label, (keywords, ident, name, short) in LICENSES.items():
            body = form.replace("%i", f"(?:{ident})").replace("%n", f"(?:{name})").replace("%s", f"(?:{short})")
            out.append({"label": label, "priority": priority, "score": score, "keywords": keywords.split("|"), "regex": f"(?:{body})"})
    return sorted(out, key=lambda r: r["priority"])


def gate() -> str:
    """One expression for all keywords, with common beginnings written once."""

    def tree(words: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for w in words:
            heads.setdefault(w[:1], []).append(w[1:])
        parts = [c + tree(rest) if c else "" for c, rest in heads.items()]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(sorted(parts, reverse=True)) + ")"

    return f" {tree(sorted({k for r in rules() for k in r['keywords']} | {'mit', 'apache', 'cc'}))} "


def normalised(text: Column) -> Column:
    """The words between single blanks, one before the first and one behind the last."""
    spaced = F.regexp_replace(F.translate(text, UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def _blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _found(n: Column, priority: int) -> Column:
    """(start, size, priority, label, score) of a priority's matches, one at most for each word."""
    own = [r for r in rules() if r["priority"] == priority]
    at_each = F.regexp_extract_all(n, F.lit(" (?=((?:" + "|".join(r["regex"] for r in own) + ")(?= ))?)"), F.lit(1))
    placed = F.filter(F.transform(at_each, lambda m, k: F.struct(k.alias("start"), m.alias("m"))), lambda x: x["m"] != "")

    # as one SQL text: hundreds of literals made one by one take seconds
    table = F.expr("array(" + ", ".join(f"named_struct('whole', '^{r['regex']}$', 'label', '{r['label']}', 'score', {r['score']}D)" for r in own) + ")")

    def named(x: Column) -> Column:
        # the first rule that matches the whole is the one that matched
        which = F.get(F.filter(table, lambda r: F.rlike(x["m"], r["whole"])), F.lit(0))
        return bind(which, lambda w: F.struct(x["start"].alias("start"), (_blanks(x["m"]) + 1).alias("size"), F.lit(priority).alias("priority"), w["label"].alias("label"), w["score"].alias("score")))

    return F.transform(placed, named)


def _resolved(spans: Column) -> Column:
    """The matches that none before them in order contains and beats."""

    def beaten(all_: Column, s: Column, k: Column) -> Column:
        # sorted by start: what contains a match begins with it or at most LONGEST words before it
        near = F.slice(all_, F.greatest(k + 1 - PRIORITIES * LONGEST, F.lit(1)), F.lit(PRIORITIES * (LONGEST + 1)))
        inside = lambda o: (o["start"] <= s["start"]) & (o["start"] + o["size"] >= s["start"] + s["size"])
        return F.exists(near, lambda o: inside(o) & ((o["priority"] < s["priority"]) | ((o["priority"] == s["priority"]) & (o["size"] > s["size"]))))

    def kept(all_: Column) -> Column:
        marked = F.transform(all_, lambda s, k: F.struct(s.alias("s"), beaten(all_, s, k).alias("x")))
        return F.transform(F.filter(marked, lambda m: ~m["x"]), lambda m: m["s"])

    return bind(F.array_sort(spans), kept)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches."""
    n = F.col("n")
    empty = "array<struct<start:int,size:int,priority:int,label:string,score:double>>"
    out = docs.select(F.col(doc_id).alias("doc_id"), normalised(text_or_empty(text)).alias("n"))
    out = out.withColumn("gated", F.rlike(n, F.lit(gate())))
    found = F.concat(*[_found(n, p) for p in range(1, PRIORITIES + 1)])
    out = out.withColumns({"n_words": F.when(F.length(n) > 2, _blanks(n) - 1).otherwise(0).cast("long"), "matches": F.when(F.col("gated"), _resolved(found)).otherwise(F.array()).cast(empty)})
    for k, (phrase, _) in enumerate(BASE):
        out = out.withColumn(f"p{k}", F.when(F.col("gated") & F.contains(n, F.lit(f" {phrase} ")), F.split(n, f" {phrase}(?= )")))
    places = [F.when(F.col(f"p{k}").isNull(), 0).otherwise(F.size(f"p{k}") - 1) for k in range(len(BASE))]
    first = F.least(*[_blanks(F.get(f"p{k}", F.lit(0))) for k in range(len(BASE))])
    last = F.greatest(*[F.col("n_words") - (_blanks(F.element_at(f"p{k}", -1)) - 1) - len(BASE[k][0].split()) for k in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.col(f"p{k}").isNotNull(), F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    out = out.withColumns({"n_base": reduce(lambda a, b: a + b, places).cast("long"), "base": base})
    scores = F.array_max(F.transform("matches", lambda m: m["score"]))
    return out.select(
        "doc_id", "n_words", "n_base", first.cast("long").alias("first_word"), last.cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("matches", lambda m: m["label"])))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(scores, F.lit(0.0))).alias("score"),
        "matches",
    )

"""Licence scan: Dice coefficient over word bigrams, pruned by size bounds.

Each line of a text is normalised (lower case, words of letters, digits and dots)
and compared with one-line licence notices.  With sets of ``a`` and ``b`` bigrams, Dice is at
most ``2 min(a, b) / (a + b)``, so only templates with a size between
``a t / (2 - t)`` and ``a (2 - t) / t`` can reach ``t``: only they are compared.
A line that reaches it also lacks few of the template's bigrams, so of any one
bigram more than that number at least one must stand in it: texts without any of
these are passed over by one pattern.

Notices that share a line with other words or run over several lines, headers and
longer licence passages are found in windows: as many bigrams of the whole text's
words as the notice has, from each bigram that stands in the notice.  A window can
only reach ``t`` if enough such bigrams follow closely, which their places tell;
it must not end with words that come before its first ones in the notice.
Of windows that overlap, the one with most bigrams in common counts.  Windows that
touch a line that matches as a whole are left out, as are those inside a line whose
size can reach ``t``: it is judged as a whole, and with all of the notice it matches.
SPDX tags are read as written.
All of it is Column expressions; nothing is shuffled or joined.

Rows and cases: a null or empty text has no match, lines of one word have no bigram
and never match as a line, a window or tag counts at the line it begins in, ties
between templates go to the smaller name, null ``doc_id`` and repeated rows are kept
row by row, other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Usual one-line licence notices.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def gnu(kind: str, version: str) -> str:
    """The notice that the GNU licences ask to put at the head of a file."""
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


def legal_code(kind: str) -> str:
    """The opening of a Creative Commons legal code."""
    name = f"Creative Commons {kind} 4.0 International Public License"
    return f"{name} By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this {name}"


SOURCE_BINARY = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

# Headers, and passages by which the full licence texts are known; compared in windows only.
NOTICES = {
    "AGPL-3.0": [gnu("Affero General Public License", "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "BSD-2-Clause": [SOURCE_BINARY],
    "BSD-3-Clause": [SOURCE_BINARY + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "CC-BY-4.0": [legal_code("Attribution")],
    "CC-BY-NC-4.0": [legal_code("Attribution-NonCommercial")],
    "CC-BY-SA-4.0": [legal_code("Attribution-ShareAlike")],
    "CC0-1.0": ["CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights"],
    "GPL-2.0": [gnu("General Public License", "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."],
    "GPL-3.0": [gnu("General Public License", "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": [gnu("Lesser General Public License", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."],
    "LGPL-3.0": [gnu("Lesser General Public License", "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."],
    "MIT": ["""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""],
    "MPL-2.0": ["Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}

TAG = "spdx-license-identifier:"
ID = "[(]*[A-Za-z0-9][A-Za-z0-9.+:-]*[)]*"
EXPRESSION = rf"(?i){TAG}[ \t]*({ID}(?:[ \t]+(?:and|or|with)[ \t]+{ID})*)"


def words_of(text: str) -> list[str]:
    """Words of a template; the same rule as ``words``."""
    return re.findall(r"[a-z0-9]+(?:\.[a-z0-9]+)*", text.lower())


def bigrams_of(text: str) -> list[str]:
    found = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(found, found[1:], strict=False)})


def in_order(text: str) -> list[str]:
    """Bigrams of a template as they follow each other."""
    found = words_of(text)
    return [f"{a} {b}" for a, b in zip(found, found[1:], strict=False)]


def least_common(n: int, threshold: float) -> int:
    """How many of ``n`` bigrams are in any set that reaches the threshold.

    With ``a`` bigrams and ``c`` of a template's ``b`` in common, ``c <= a`` and
    ``2 c >= t (a + b)`` give ``c >= t b / (2 - t)``: at most ``b - c`` are missing.
    """
    return max(1, math.ceil(threshold * n / (2 - threshold) - 1e-9))


def anchors(texts: list[str], threshold: float) -> str:
    """A pattern on lower-case text that everything that reaches the threshold holds."""
    chosen: set[str] = set()
    for text in texts:
        pairs = sorted(bigrams_of(text), key=lambda p: (p not in chosen, -len(p), p))
        chosen.update(pairs[: len(pairs) - least_common(len(pairs), threshold) + 1])
    return "(?<![a-z0-9])" + branches([[*map(re.escape, a), "[^a-z0-9]+", *map(re.escape, b)] for a, b in (p.split(" ") for p in chosen)])


def branches(parts: list[list[str]]) -> str:
    """A pattern for lists of parts, with common beginnings tried once."""
    by_first: dict[str, list[list[str]]] = {}
    for part in parts:
        if not part:
            return ""
        by_first.setdefault(part[0], []).append(part[1:])
    return "(?:" + "|".join(first + branches(rest) for first, rest in sorted(by_first.items())) + ")"


def words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(r"[a-z0-9]+(?:\.[a-z0-9]+)*"), 0)


def pairs_of(found: Column) -> Column:
    """Bigrams of an array of words, in order."""
    return F.zip_with(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), F.slice(found, 2, F.size(found)), lambda a, b: F.concat(a, F.lit(" "), b))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each line, window or tag that matches: doc_id, line_no (from 0), license, dice."""
    notices = list((TEMPLATES if templates is None else templates).items())
    judged = len(notices)  # the first ones are compared with lines, too
    if templates is None:
        templates = TEMPLATES
        notices += [(name, text) for name, texts in NOTICES.items() for text in texts]
        tags = F.flatten(F.transform("lines", lambda line, k: F.transform(F.regexp_extract_all(line, F.lit(EXPRESSION), 1), lambda x: row(k, F.rtrim(x, F.lit(".")), F.lit(1.0)))))
        pattern = f"{anchors([t for _, t in notices], threshold)}|{TAG}"
    else:
        tags, pattern = F.array().cast("array<struct<line_no:int,license:string,dice:double>>"), anchors([t for _, t in notices], threshold)
    texts = docs.filter(F.lower("text").rlike(pattern)).select(F.col("doc_id").cast("long").alias("doc_id"), F.split("text", "\n").alias("lines"))
    found = texts.withColumn("words", F.transform("lines", words))
    found = found.select("doc_id", "lines", F.transform("words", lambda w: F.array_distinct(pairs_of(w))).alias("line_pairs"), F.flatten("words").alias("words"), F.flatten(F.transform("words", lambda w, k: F.transform(w, lambda _: k))).alias("at"))
    found = found.withColumn("pairs", pairs_of(F.col("words")))
    lines = constants(sorted(templates.items()), threshold, len(templates))
    found = found.withColumn("whole", F.filter(F.transform("line_pairs", lambda p, k: best_line(p, k, lines, threshold)), lambda x: x["dice"] >= threshold))
    known = sorted({p for _, text in notices for p in in_order(text)})
    found = found.withColumn("near", F.filter(F.transform("pairs", lambda p, k: F.struct(p.alias("pair"), k.alias("at"))), lambda x: x["pair"].isin(known)))
    found = found.withColumn("windows", F.flatten(F.transform(constants(notices, threshold, judged), lambda t: windows(t, threshold))))
    # Smallest first: most bigrams in common, then highest Dice, first place, smaller name.
    found = found.withColumn("windows", F.array_sort(F.filter("windows", lambda w: w["counts"] & (w["dice"] >= threshold) & ~F.exists("whole", lambda x: x["line_no"].between(w["line_no"], w["last_line"])))))
    apart = F.aggregate("windows", F.slice("windows", 1, 0), lambda kept, w: F.when(F.exists(kept, lambda x: (x["start"] < w["end"]) & (w["start"] < x["end"])), kept).otherwise(F.concat(kept, F.array(w))))
    rows = F.concat(F.transform("whole", lambda x: row(x["line_no"], x["license"], x["dice"])), F.transform(apart, lambda w: row(w["line_no"], w["license"], w["dice"])), tags)
    return found.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.line_no", "r.license", F.round("r.dice", 6).alias("dice"))


def row(line_no: Column, name: Column, value: Column) -> Column:
    return F.struct(line_no.alias("line_no"), name.alias("license"), value.alias("dice"))


def constants(notices: list[tuple[str, str]], threshold: float, judged: int) -> Column:
    """Notices as an array; the first ``judged`` ones are compared with lines, too."""
    out = []
    for k, (name, text) in enumerate(notices):
        own = list(dict.fromkeys(in_order(text)))
        values = {"license": name, "order": -k, "size": len(own), "length": len(in_order(text)), "least": least_common(len(own), threshold), "judged": k < judged}
        out.append(F.struct(*(F.lit(v).alias(n) for n, v in values.items()), F.array(*map(F.lit, own)).alias("own")))
    return F.array(*out)


def reaches(n: Column, size: Column, threshold: float) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return 2 * F.least(n, size) >= F.lit(threshold) * (n + size)


def best_line(pairs: Column, line_no: Column, templates: Column, threshold: float) -> Column:
    """The best template for a line's distinct bigrams, ties to the smaller name; null values if none has a size that can reach the threshold."""
    value = lambda t: 2.0 * F.size(F.array_intersect(pairs, t["own"])) / (F.size(pairs) + t["size"])
    best = F.array_max(F.transform(templates, lambda t: F.when(reaches(F.size(pairs), t["size"], threshold), F.struct(value(t).alias("dice"), t["order"].alias("order"), t["license"].alias("license")))))
    return F.transform(F.array(best), lambda b: row(line_no, b["license"], b["dice"]))[0]


def windows(t: Column, threshold: float) -> Column:
    """Windows of a notice's length that begin with one of its bigrams and hold enough of them."""
    hits = F.transform(F.filter("near", lambda x: F.array_contains(t["own"], x["pair"])), lambda x: x["at"])
    starts = F.filter(F.zip_with(hits, F.slice(hits, t["least"], F.size("near") + 1), lambda a, b: F.when(b - a < t["length"], a)), lambda k: k.isNotNull())

    def window(start):
        held = F.array_distinct(F.slice("pairs", start + 1, t["length"]))
        return F.transform(F.array(F.struct(F.array_intersect(held, t["own"]).alias("common"), F.size(held).alias("n"))), lambda x: scored(start, x["common"], x["n"]))[0]

    def scored(start, common, n):
        end, value = F.least(start + t["length"], F.size("pairs")), 2.0 * F.size(common) / (n + t["size"])
        first, last = F.get("at", start), F.get("at", end)
        ordered = F.array_position(t["own"], common[0]) <= F.array_position(t["own"], F.element_at(common, -1))
        alone = t["judged"] & (first == last) & reaches(F.size(F.get("line_pairs", first)), t["size"], threshold)
        return F.struct((-F.size(common)).alias("order"), (-value).alias("minus"), start.alias("start"), t["license"].alias("license"), end.alias("end"), first.alias("line_no"), last.alias("last_line"), value.alias("dice"), (ordered & ~alone).alias("counts"))

    return F.transform(starts, window)

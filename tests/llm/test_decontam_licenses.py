import random

from genespark.llm import decontam, licenses


def distance(pattern, text):
    """Least edit distance of the pattern to any substring."""
    last = [0] * (len(text) + 1)
    for k, a in enumerate(pattern, 1):
        row = [k]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        last = row
    return min(last)


def test_myers_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        found = decontam.myers(p, t, len(p))
        assert (found[0] if found else len(p)) == distance(p, t)


def test_matches_equal_brute_force(spark, odd, empty):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 5)))
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 30)))) for k in range(12)] + [(50, None), (51, ""), (52, "!!"), (None, "x y z")]
    rows = []
    for k in range(60):
        text = [word() for _ in range(40)]
        if k % 2:
            passage = list(items[k % 12][1].upper() if k % 4 == 1 else items[k % 12][1])
            for _ in range(k % 7):
                passage[rng.randrange(len(passage))] = rng.choice("xyz")
            text.insert(20, "".join(passage))
        rows.append((k, ", ".join(text)))
    rows += [(90, None), (91, "")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.matches(docs, bench).collect()}
    want = {}
    for d, text in rows:
        for i, item in items:
            norm = decontam.normalise(item)
            if i is not None and norm:
                n = distance(norm, decontam.normalise(text))
                if n <= len(norm) // decontam.CHARS_PER_EDIT:
                    want[d, i] = n
    assert got == want and len(want) > 20 and max(want.values()) > 0
    clean = decontam.clean(docs, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontam.clean(odd, bench).columns == odd.columns
    assert decontam.matches(empty, bench).count() == 0 and decontam.matches(docs, bench.limit(0)).count() == 0


def test_benchmark_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE_BYTES", 300)
    items = [(k, f"item number {k} " + "abcdefghij " * 8 + str(k)) for k in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = decontam.slices(bench)
    assert len(parts) > 3 and sorted(i for p in parts for i, _ in p) == list(range(20))


def brute_license(line):
    words = licenses.words_of(line)
    own = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
    best = None
    for name in sorted(licenses.TEMPLATES):
        other = set(licenses.bigrams_of(licenses.TEMPLATES[name]))
        dice = 2 * len(own & other) / (len(own) + len(other)) if own else 0
        if dice >= licenses.THRESHOLD and (best is None or dice > best[1]):
            best = (name, dice)
    return best


def test_license_lines_equal_brute_force(spark, odd, empty):
    rng = random.Random(8)
    lines = []
    for _ in range(400):
        words = rng.choice(list(licenses.TEMPLATES.values())).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["the", "free", "license", "under", ""])
        lines.append(rng.choice(["", "* ", "// "]) + rng.choice([" ", "  ", ", "]).join(words).swapcase())
    rows = [(k, "\n".join(lines[10 * k : 10 * k + 10])) for k in range(40)] + [(99, None), (98, "")]
    got = {(r.doc_id, r.line_no): (r.license, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {(k // 10, k % 10): (b[0], round(b[1], 6)) for k, line in enumerate(lines) if (b := brute_license(line))}
    assert got == want and len(want) > 50
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0


def test_notices_within_lines_over_lines_and_headers(spark):
    grant = licenses.NOTICES["MIT"][0]
    header = licenses.gnu("General Public License", "2").replace(" ", "\n * ", 1).replace("under the", "under\n * the")
    rows = [
        (0, "This project is released under the MIT License."),
        (1, "Copyright (c) 2019 Jane Doe. Released under the MIT License."),
        (2, "x\nThe text is licensed under CC BY-NC 4.0."),
        (3, "# Released under\n# the MIT\n# License."),
        (4, "Copyright 2020\n\n" + grant.replace("copy of", "copy\nof").replace("publish, ", "publish,\n")),
        (5, "/*\n * " + header + "\n */"),
        (6, licenses.NOTICES["BSD-3-Clause"][0]),
        (7, licenses.SOURCE_BINARY),
        (8, "// SPDX-License-Identifier: MIT OR Apache-2.0\nx = 1"),
        (9, "a " * 300 + "Licensed under the Apache License, Version 2.0. " + "b " * 300 + "Released under the MIT License."),
        (10, "Released under the MIT License.\nReleased under the MIT License."),
        (11, "Under the general terms of the public, a licence version was copied."),
    ]
    got = sorted((r.doc_id, r.line_no, r.license, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(0, 0, "MIT"), (1, 0, "MIT"), (2, 1, "CC-BY-NC-4.0"), (3, 0, "MIT"), (4, 2, "MIT"), (5, 1, "GPL-2.0"), (6, 0, "BSD-3-Clause"), (7, 0, "BSD-2-Clause"), (8, 0, "MIT OR Apache-2.0"), (9, 0, "Apache-2.0"), (9, 0, "MIT"), (10, 0, "MIT"), (10, 1, "MIT")]
    assert [x[:3] for x in got] == want and all(x[3] == 1 for x in got)


def test_items_without_an_id_count(spark):
    passage = "a passage of the benchmark that stands in a document"
    docs = spark.createDataFrame([(1, f"Well, {passage}."), (2, "nothing of the kind")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (None, "another text of it"), (4, "a third one of them")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.distance) for r in decontam.matches(docs, bench).collect()] == [(1, None, 0)]
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [2]

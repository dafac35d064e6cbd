import random

import numpy as np

from genespark.llm import dartminhash as dart


def brute(rows, threshold=0.8):
    """Class (least doc_id) of each row, by comparing all pairs."""
    sets = [dart.weighted(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a or "") == (b or "") or dart.similarity(sets[i], sets[j]) >= threshold:
                parent[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return [least.get(find(k)) for k in range(len(rows))]


def corpus():
    """Copies, chains of near copies and unrelated texts."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, n = [], 0
    for size in (1, 2, 3, 12, 40):
        base = [word() for _ in range(120)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(120)] = word()
            if rng.random() < 0.3:
                base = text  # the next copies drift on
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n + 1, rows[5][1]), (n + 2, "short text"), (n + 3, "short text"), (n + 4, "a b c d e f " * 40), (n + 5, "a b c d e f " * 90)]
    return rows


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for k in range(60):
        a = rng.integers(0, 60, 200)
        b = a.copy()
        b[: rng.integers(5, 150)] = rng.integers(60, 90)
        sets = []
        for x in (a, b):
            element, count = np.unique(x, return_counts=True)
            element = dart.mix(element.astype(np.uint64) + np.uint64(1000 * k))
            order = np.argsort(element)
            sets.append((element[order], count[order]))
        found = dart.sketch(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), np.repeat([0, 1], [len(s[0]) for s in sets]), 2)
        errors.append((found[0] == found[1]).mean() - dart.similarity(*sets))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, _ = dart.classes(docs)
    assert {r.doc_id: r.class_id for r in got.collect()} == dict(zip([d for d, _ in rows], brute(rows), strict=True))


def test_odd_rows(spark, odd, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    got, _ = dart.classes(odd)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0)
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=key) == sorted(zip([d for d, _ in rows], brute(rows), strict=True), key=key)


def test_keep_leaves_one_of_each_class(spark, odd, odd_rows, empty):
    kept = dart.keep(odd).collect()
    rows = [(r[0], r[1]) for r in odd_rows]
    assert sorted(r.doc_id for r in kept) == sorted(set(brute(rows)))
    assert kept[0].__fields__ == odd.columns
    assert dart.keep(empty).count() == 0 and dart.classes(empty)[0].count() == 0


def test_prefix_join_finds_links_past_the_centre(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    left, right = list(base), list(base)
    for k in range(10, 60, 10):
        left[k] = word()
    far = list(left)
    far[140] = word()
    for k in range(80, 140, 12):
        right[k] = word()
    rows = [(k, " ".join(t)) for k, t in enumerate([base, left, far, right])]
    texts = spark.createDataFrame(rows, "rid long, text string")
    labels = spark.createDataFrame([(k, k) for k in range(4)], "rid long, label long")
    met = {(r.a, r.b) for r in dart.meetings(texts, labels, 0.8).collect()}
    sets = [dart.weighted(t) for _, t in rows]
    need = {(a, b) for a in range(4) for b in range(a + 1, 4) if dart.similarity(sets[a], sets[b]) >= 0.8}
    assert need and need <= met

import random
import re

import numpy as np

from genespark.llm import quality, toxicity


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    marked = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_statistics_equal_brute_force(spark, odd, odd_rows, empty):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \n#é \x0b") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    texts += [r[1] for r in odd_rows if not r[1] or len(r[1]) < 20000]
    for text in texts:
        t = quality.Text(text)
        assert (t.n_words, *(t.get(n) for n in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) == brute_quality(text)
    got = quality.measure(odd).collect()
    assert len(got) == len(odd_rows) and not any(r.kept and r.base_failed for r in got)
    assert sorted(r.n_words for r in got) == sorted(quality.Text(r[1]).n_words for r in odd_rows)
    assert quality.measure(empty).count() == 0 and quality.keep(empty).count() == 0
    kept = quality.keep(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(not any(rule.rejects(quality.Text(r[1])) for rule in quality.RULES) for r in odd_rows)


def test_order_puts_cheap_selective_rules_first_and_never_changes_the_verdict():
    short = ["too short"] * 50
    assert quality.order_rules(short)[0].name in ("few_words", "short_words")
    texts = ["word " * 60, "A B C " * 40, " ".join(f"w{k}#" for k in range(90)), " ".join(f"good{k}" for k in range(90))]
    for text in texts:
        verdicts = {quality.kept(quality.Text(text), random.Random(s).sample(quality.RULES, len(quality.RULES))) for s in range(8)}
        assert len(verdicts) == 1


def labelled(rng, n):
    texts, labels = [], []
    for _ in range(n):
        toxic, low = rng.random() < 0.2, rng.random() < 0.3
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(rng.randint(30, 120))]
        if toxic:
            words += [rng.choice(["vile", "nasty", "grim" + rng.choice("abc")]) for _ in range(3)]
        if low:
            words += ["clickbait"] * 2
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append((float(low), float(toxic)))
    return texts, np.array(labels)


def test_chain_learns_and_holds_out():
    rng = random.Random(4)
    texts, labels = labelled(rng, 1200)
    model = toxicity.train([toxicity.words_of(t) for t in texts[:800]], labels[:800], ["low_quality", "toxic"])
    assert model.models[1].earlier.shape == (1,)  # the second model reads the first one's probability
    found = model.predict([toxicity.words_of(t) for t in texts[800:]])
    for k in range(2):
        assert ((found[:, k] >= model.limits[k]) == (labels[800:, k] == 1)).mean() > 0.97


def test_chain_equals_a_plain_loop():
    """The same chain with dense matrices, a row at a time, fold by fold."""
    rng = random.Random(8)
    texts, labels = labelled(rng, 150)
    words = [toxicity.words_of(t) for t in texts]
    model = toxicity.train(words, labels, ["low_quality", "toxic"], folds=3)
    names = sorted(model.vocabulary, key=model.vocabulary.get)
    assert set(names) == set(toxicity.choose(words, labels)) and names
    table = np.array([[float(any(f in toxicity.features_of(w) for w in own)) for f in names] for own in words])

    def logistic(rows, target):
        weights = np.zeros(rows.shape[1] + 1)
        rate = min(max(target.mean(), 1e-3), 1 - 1e-3)
        weights[-1] = np.log(rate / (1 - rate))
        one, two = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, 101):
            grad = np.zeros_like(weights)
            for x, y in zip(rows, target, strict=True):
                error = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))) - y
                grad += np.append(x * error, error) / len(target)
            grad[:-1] += 1e-4 * weights[:-1]
            one, two = 0.9 * one + 0.1 * grad, 0.99 * two + 0.01 * grad**2
            weights -= 0.2 * one / (1 - 0.9**step) / (np.sqrt(two / (1 - 0.99**step)) + 1e-5)
        return weights

    score = lambda w, rows: 1 / (1 + np.exp(-(rows @ w[:-1] + w[-1])))
    held = np.zeros(len(texts))
    for f in range(3):
        own = np.arange(len(texts)) % 3 == f
        held[own] = score(logistic(table[~own], labels[~own, 0]), table[own])
    first = logistic(table, labels[:, 0])
    second = logistic(np.column_stack([table, held]), labels[:, 1])
    want = score(first, table)
    got = model.predict(words)
    assert np.allclose(got[:, 0], want, atol=1e-6)
    assert np.allclose(got[:, 1], score(second, np.column_stack([table, want])), atol=1e-6)


def test_repeated_ids_and_labels_are_bounded(spark):
    rng = random.Random(9)
    texts, labels = labelled(rng, 60)
    rows = list(enumerate(texts)) + [(3, f"other {k}") for k in range(500)]
    marks = [(k, int(1 - a), int(b)) for k, (a, b) in enumerate(labels)] * 3
    seen = []
    original = toxicity.train

    def train(found, targets, names):
        seen.append(len(found))
        return original(found, targets, names)

    toxicity.train = train
    try:
        toxicity.train_on(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    finally:
        toxicity.train = original
    assert seen == [60]


def test_score_and_keep(spark, odd, odd_rows, empty):
    rng = random.Random(6)
    texts, labels = labelled(rng, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(1 - a), int(b)) for k, (a, b) in enumerate(labels)] + [(None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train_on(docs, marks)
    assert len(toxicity.score(odd, model).collect()) == len(odd_rows)
    kept = toxicity.keep(docs, model).count()
    assert abs(kept - (labels[:, 1] == 0).sum()) <= 6
    assert toxicity.keep(odd, model).columns == odd.columns
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train_on(docs, marks.limit(0))
    assert toxicity.keep(docs, none).count() == 300 and toxicity.score(docs, none).first().toxic == 0.0

"""Quality rules as a short-circuit cascade.

Each rule is a cheap test of a document's statistics or text.  On a bounded
sample, every rule is run on every row, which gives its cost (seconds a row) and
its rejection rate; rules then run in descending rejection per cost, and a row
that one rule rejects isn't given to the later ones.  The order changes the time,
never the verdict: a document is kept if no rule rejects it.

Rows and cases: a null text has no word and fails the base rule, an empty text
likewise; null ``doc_id`` and repeated rows are judged row by row; other columns
pass through ``keep`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from . import storage

#: Mean size of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 512
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


class Text:
    """Statistics of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode("utf-8")
        self.words = self.data.split()  # ASCII white space only: [^\\x20\\x09-\\x0D]+
        self.n_words = len(self.words)
        self.known: dict[str, int] = {}

    def get(self, name: str) -> int:
        if name not in self.known:
            self.known[name] = STATISTICS[name](self)
        return self.known[name]


def word_chars(t: Text) -> int:
    return len(t.text) - sum(map(t.text.count, SPACES))


def n_symbols(t: Text) -> int:
    return len(t.data) - len(t.data.translate(None, SYMBOLS))


def n_dup_lines(t: Text) -> int:
    lines = [x for x in t.data.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def n_repeat_words(t: Text) -> int:
    """Words in windows of three words that occur twice or more."""
    words = t.words
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    total, until = 0, 0
    for k, window in enumerate(windows):
        if count[window] > 1:
            total += k + 3 - max(k, until)
            until = k + 3
    return total


def n_caps_words(t: Text) -> int:
    """Words of two or more bytes with ASCII letters, all of them upper case."""
    return sum(1 for w in t.words if len(w) > 1 and w.isupper())


STATISTICS: dict[str, Callable[[Text], int]] = {f.__name__: f for f in (word_chars, n_symbols, n_dup_lines, n_repeat_words, n_caps_words)}

@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``statistic * scale > limit * n_words`` (or < with ``below``)."""

    name: str
    statistic: str
    scale: int
    limit: int
    below: bool = False

    def rejects(self, text: Text) -> bool:
        if self.statistic == "n_words":
            return text.n_words < self.limit
        left, right = text.get(self.statistic) * self.scale, self.limit * text.n_words
        return left < right if self.below else left > right


#: The base rule: too short, or over half of the words in repeated windows.
BASE = (Rule("few_words", "n_words", 1, 50), Rule("repeated_words", "n_repeat_words", 100, 50))
#: The further rules: mean word length of 2 to 20 characters, symbols for at most a
#: fifth of the words, at most three of ten words in capitals, duplicate lines for
#: at most one of ten words.
RULES = (
    *BASE,
    Rule("short_words", "word_chars", 1, 2, below=True),
    Rule("long_words", "word_chars", 1, 20),
    Rule("symbols", "n_symbols", 10, 2),
    Rule("capitals", "n_caps_words", 10, 3),
    Rule("dup_lines", "n_dup_lines", 10, 1),
)


def order_rules(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejection per cost on a sample, greatest first; a rule that rejected none comes last."""
    spent, rejected = Counter(), Counter()
    for text in texts:
        for rule in rules:
            fresh = Text(text)  # the split into words is every rule's, so it isn't a cost of any
            began = time.perf_counter()
            rejected[rule.name] += rule.rejects(fresh)
            spent[rule.name] += time.perf_counter() - began
    return sorted(rules, key=lambda r: (-(rejected[r.name] / max(spent[r.name], 1e-9)), spent[r.name]))


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The cascade's order, from about ``sample_rows`` rows drawn over the whole table (all of a smaller one).

    Every row is drawn with the same chance, so nothing but the sample leaves the tasks.
    """
    n = docs.count()
    rows = docs.select("text").sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=7).toPandas()
    return order_rules(rows["text"].tolist(), rules)


def kept(text: Text, cascade: list[Rule]) -> bool:
    return not any(rule.rejects(text) for rule in cascade)  # any() stops at the first


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base statistics, base_failed and the cascade's verdict for each row."""
    storage.small_batches(docs.sparkSession)
    cascade = plan(docs, rules)
    further = [r for r in cascade if r not in BASE]
    names = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            rows = []
            for text in map(Text, batch.column(1).to_pylist()):
                failed = any(rule.rejects(text) for rule in BASE)
                rows.append([text.n_words, *map(text.get, names), failed, not failed and kept(text, further)])
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_words", *names, "base_failed", "kept"])

    schema = "doc_id long, n_words long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(storage.worker("quality", run), schema)


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, all columns unchanged."""
    storage.small_batches(docs.sparkSession)
    cascade = plan(docs, rules)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            mask = [kept(Text(t), cascade) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(storage.worker("quality", run), docs.schema)

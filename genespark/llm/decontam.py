"""Benchmark decontamination by pigeonhole edit matching.

A normalised item of ``m`` characters may differ from a passage by ``e = m // 16``
edits.  Cut into ``e + 1`` pieces, at least one piece then stands unchanged in the
passage: an Aho-Corasick automaton finds all pieces of all items in one pass over
a document, and Myers' bit-parallel algorithm measures the distance of the whole
item in a window around each hit.

The benchmark is broadcast in slices of at most ``SLICE_BYTES`` (or one longer item);
a larger one takes several passes over the documents.

Rows and cases: null and empty texts match nothing, null or empty items are
ignored, items without an id match like others (with a null ``item_id``), items with
equal texts each match, repeated document rows and null
``doc_id`` give a row each, other columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

#: Characters of an item for each edit that is allowed.
CHARS_PER_EDIT = 16
#: Characters of benchmark text that an automaton may hold; it takes some hundred bytes for each.
SLICE_BYTES = 4 << 20
WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    return " ".join(WORD.findall((text or "").lower()))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits + 1`` pieces of about equal length."""
    n = edits + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to any substring of ``text``, and where it ends.

    None beyond ``most``; the first end wins ties.  One step a character on
    integers of as many bits as the pattern has characters.
    """
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << m - 1
    where: dict[str, int] = {}
    for k, char in enumerate(pattern):
        where[char] = where.get(char, 0) | 1 << k
    plus, minus, score, best = mask, 0, m, None
    for end, char in enumerate(text, 1):
        eq = where.get(char, 0)
        vertical = eq | minus
        horizontal = ((eq & plus) + plus ^ plus) | eq
        up = minus | ~(horizontal | plus) & mask
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & mask, down << 1 & mask
        plus = down | ~(vertical | up) & mask
        minus = up & vertical
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
    return best


class Matcher:
    """All pieces of a slice of items in one automaton."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        import ahocorasick

        self.items = [(item_id, text, len(text) // CHARS_PER_EDIT) for item_id, text in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, edits) in enumerate(self.items):
            for offset, piece in pieces(text, edits):
                found.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def match(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the normalised text) of each item that a text holds."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for k, offset in places:
                _, item, edits = self.items[k]
                begin = end + 1 - length - offset
                low, high = max(0, begin - edits), begin + len(item) + edits
                own = windows.setdefault(k, [])
                # Pieces of an item have lengths one apart at most, so windows come nearly in order.
                own.append([low, high])
        out = []
        for k, own in windows.items():
            item_id, item, edits = self.items[k]
            best = None
            for low, high in merged(own):
                at = text.find(item, low, high)
                found = (0, at + len(item) - low) if at >= 0 else myers(item, text[low:high], edits) if edits else None
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], low + found[1])
                    if best[0] == 0:
                        break
            if best:
                out.append((item_id, *best))
        return sorted(out, key=by_id)


def by_id(found: tuple) -> tuple:
    """Order by item id, null first."""
    return found[0] is not None, found[0] or 0, *found[1:]


def merged(windows: list[list[int]]) -> list[list[int]]:
    windows.sort()
    out = [windows[0]]
    for low, high in windows[1:]:
        if low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


@lru_cache(maxsize=2)
def matcher(items: tuple[tuple[int, str], ...]) -> Matcher:
    return Matcher(items)


def slices(benchmark: DataFrame) -> list[tuple[tuple[int, str], ...]]:
    """All slices at once, for a small benchmark."""
    return list(sliced(benchmark))


def sliced(benchmark: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """Normalised items in lists of bounded size, one list at a time on the driver.

    Items stream over the driver in the order of a staged table; a list is full at
    ``SLICE_BYTES``, so only a single longer item can make one larger.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length("text") > 0).distinct()
    held, size = [], 0
    for r in rows.toLocalIterator():
        text = normalise(r.text)
        if not text:
            continue
        if held and size + len(text) > SLICE_BYTES:
            yield tuple(sorted(held, key=by_id))
            held, size = [], 0
        held.append((r.item_id, text))
        size += len(text)
    if held:
        yield tuple(sorted(held, key=by_id))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document row and item it holds: doc_id, item_id, distance, end."""
    spark = docs.sparkSession
    storage.small_batches(spark)
    schema = "doc_id long, item_id long, distance long, end long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], schema)
    for items in sliced(benchmark):
        shared = spark.sparkContext.broadcast(items)  # a bounded slice

        def run(batches, shared=shared):
            find = matcher(shared.value)
            storage.hold("decontam", matcher.cache_clear)
            for batch in batches:
                found = [(d, *x) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in find.match(normalise(t))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*found, strict=True)) or [()] * 4], ["doc_id", "item_id", "distance", "end"])

        out = out.unionByName(rows.mapInArrow(storage.worker("decontam", run), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged."""
    spark = docs.sparkSession
    storage.small_batches(spark)
    at = docs.columns.index("text")
    for items in sliced(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            find = matcher(shared.value)
            storage.hold("decontam", matcher.cache_clear)
            for batch in batches:
                mask = [not find.match(normalise(t)) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(mask, pa.bool_()))

        docs = docs.mapInArrow(storage.worker("decontam", run), docs.schema)
    return docs

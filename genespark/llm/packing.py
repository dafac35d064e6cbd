"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' ids.  Time goes in windows; in each one
a queue earns credit in proportion to its target share, is served whole ids from
it in turn, and keeps what is left as its deficit for the next window.  Serving
order is that of the credits' due times: id ``i`` of a queue with weight ``w`` is
due at ``(i + 1/2) / w``.  So a queue is never more than a few ids from its share,
and what it has been served by the start of any window is a closed form of the
window's number (``Mixture.served``).  A partition therefore starts with the exact
deficits that all earlier windows leave, with no pass from one to the next.

A window holds ``window`` ids, several sequences; its queues stand one after the
other, starting with another queue each time, and sequences are cut from it every
``length`` ids.  All sequences but the last are full.  Queues that run dry leave
their share to the others.

Rows and cases: a null text is an empty one (only the end id), a null source is
the queue "", null ``doc_id`` and repeated rows are packed like any row, other
columns are ignored, an empty table gives no piece.  Every source is a queue,
at any number of them; the driver and each worker hold a count a source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage, tokens
from .sharding import prefix

LENGTH = 2048
WINDOW = 8 * LENGTH
#: Counts of queues by window that are held at once.
CELLS = 1 << 18


class Mixture:
    """Closed form of the round-robin: ids served to each queue before a position."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray | None = None):
        self.totals = np.asarray(totals, dtype=np.int64)
        self.weights = np.asarray(self.totals if weights is None else weights, dtype=np.float64)
        if (self.weights <= 0).any():
            raise ValueError("weights must be positive")
        self.size = int(self.totals.sum())
        ends = np.unique(np.concatenate([[0.0], self.totals / self.weights]))
        # Queues that end by a time have given all, the others what their weight gives.
        last = np.argsort(self.totals / self.weights, kind="stable")
        n = np.searchsorted((self.totals / self.weights)[last], ends, side="right")
        given = np.concatenate([[0], np.cumsum(self.totals[last])])
        open_weight = np.concatenate([np.cumsum(self.weights[last][::-1])[::-1], [0.0]])
        self.times, self.fluid = ends, given[n] + ends * open_weight[n]

    def time(self, n: np.ndarray) -> np.ndarray:
        """When ``n`` ids would have been served if ids could be divided."""
        return np.interp(n, self.fluid, self.times)

    def position(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """About where id ``at`` of a queue stands among all, within as many ids as there are queues."""
        return np.interp((at + 0.5) / self.weights[queue], self.times, self.fluid)

    def served(self, n: np.ndarray) -> np.ndarray:
        """Ids of each queue among the first ``n``: those due earliest, ties by queue."""
        n = np.minimum(np.asarray(n, dtype=np.int64), self.size)
        step = max(1, CELLS // max(1, len(self.totals)))
        return np.concatenate([self._served(n[k : k + step]) for k in range(0, max(1, len(n)), step)])

    def _served(self, n: np.ndarray) -> np.ndarray:
        size = len(self.totals)
        early, late = self.time(np.maximum(n - size, 0)), self.time(np.minimum(n + size, self.size))
        out = np.floor(early[:, None] * self.weights + 0.5).astype(np.int64) - 1
        out = np.clip(out, 0, self.totals)
        # Those that may follow, in order of their due times and queues: as many as are left.
        ahead = np.clip(np.floor(late[:, None] * self.weights + 0.5).astype(np.int64) + 1, out, self.totals) - out
        counts = ahead.ravel()
        cell = np.repeat(np.arange(len(counts)), counts)
        at = out.ravel()[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(counts) - counts, counts)
        row, queue = cell // max(1, size), cell % max(1, size)
        order = np.lexsort((queue, (at + 0.5) / self.weights[queue], row))
        rows = ahead.sum(axis=1)
        rank = np.arange(len(cell)) - np.repeat(np.cumsum(rows) - rows, rows)
        taken = cell[order[rank < np.repeat(n - out.sum(axis=1), rows)]]
        return out + np.bincount(taken, minlength=out.size).reshape(out.shape)


def place(mix: Mixture, queue: np.ndarray, start: np.ndarray, n: np.ndarray, window: int, length: int) -> dict[str, np.ndarray]:
    """Pieces of documents that take ids [start, start + n) of their queue.

    Returns arrays row (of the input), begin (in the document), size, sequence, offset.
    """
    size, slack = len(mix.totals), len(mix.totals) + 1
    first = np.maximum(mix.position(queue, start).astype(np.int64) - slack, 0) // window
    last = np.minimum(mix.position(queue, start + n - 1).astype(np.int64) + slack, mix.size - 1) // window
    count = last - first + 1
    row = np.repeat(np.arange(len(n)), count)
    turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    turns, at = np.unique(turn, return_inverse=True)
    found = []
    by_turn = np.argsort(at, kind="stable")
    step = max(1, CELLS // size)
    for k in range(0, len(turns), step):
        mine = by_turn[np.searchsorted(at[by_turn], k) : np.searchsorted(at[by_turn], k + step)]
        some = turns[k : k + step]
        low, high = mix.served(some * window), mix.served((some + 1) * window)
        # Queues stand in the order turn % size, turn % size + 1, ... of the window.
        order = (np.arange(size)[None, :] + some[:, None]) % size
        share = np.take_along_axis(high - low, order, axis=1)
        offset = np.empty_like(share)
        np.put_along_axis(offset, order, np.cumsum(share, axis=1) - share, axis=1)
        q, nth = queue[row[mine]], at[mine] - k
        found.append(np.stack([mine, low[nth, q], high[nth, q], offset[nth, q]]))
    mine, low, high, offset = np.concatenate(found, axis=1)
    back = np.argsort(mine)
    low, high, offset = low[back], high[back], offset[back]
    begin, end = np.maximum(start[row], low), np.minimum((start + n)[row], high)
    full = begin < end
    row, begin, end, turn, low, offset = (x[full] for x in (row, begin, end, turn, low, offset))
    spot = turn * window + offset + begin - low  # among all ids
    cuts = (spot + end - begin - 1) // length - spot // length + 1
    piece = np.repeat(np.arange(len(row)), cuts)
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    lower = np.maximum(spot[piece], (spot[piece] // length + nth) * length)
    upper = np.minimum((spot + end - begin)[piece], (spot[piece] // length + nth + 1) * length)
    return {"row": row[piece], "begin": begin[piece] - start[row[piece]] + lower - spot[piece], "size": upper - lower, "sequence": lower // length, "offset": lower % length}


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Staged ids: part, queue, doc_id, local (start in its part and queue), n, ids (16 or 32 bits each)."""
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))

    def run(batches):
        from pyspark import TaskContext

        encoder, end = tokens.encoder(tokenizer), tokens.id_bytes(end_id)
        storage.hold("packing", tokens.encoder.cache_clear)
        part, seen = TaskContext.get().partitionId(), {}
        width = encoder.width(end_id)
        for batch in batches:
            local, sizes, data = [], [], []
            names = batch.column(1).to_pylist()
            for queue, ids in zip(names, encoder.encode(batch.column(2).to_pylist()), strict=True):
                local.append(seen.get(queue, 0))
                sizes.append(len(ids) // 4 + 1)
                seen[queue] = local[-1] + sizes[-1]
                data.append(tokens.packed(ids + end, width))
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(names), pa.int64()), "queue": batch.column(1), "doc_id": batch.column(0), "local": pa.array(local, pa.int64()), "n": pa.array(sizes, pa.int64()), "ids": pa.array(data, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("queue"), "text")
    return storage.stage(rows.mapInArrow(storage.worker("packing", run), "part long, queue string, doc_id long, local long, n long, ids binary"), "ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int, weights: dict[str, float] | None = None, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (32-bit), doc_tokens, sequence_id, offset, queue.

    ``weights`` are the target proportions by source; by default those of the
    corpus, so that all queues last to the end.  Texts are read once and only
    counts are shuffled.
    """
    if window % length:
        raise ValueError("a window holds whole sequences")
    storage.small_batches(docs.sparkSession)
    staged = tokenize(docs, tokenizer, end_id)
    sums = storage.stage(staged.groupBy("part", "queue").agg(F.sum("n").alias("n")), "sums")
    totals = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # a row a source
    queues = sorted(totals)
    mix = Mixture(np.array([totals[q] for q in queues]), None if weights is None else np.array([weights[q] for q in queues]))
    base = prefix(sums, "queue", "part", "n")
    if base.count() <= storage.BROADCAST_ROWS:
        base = F.broadcast(base)
    number = {q: k for k, q in enumerate(queues)}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            names = column["queue"].to_pylist()
            queue = np.array([number[q] for q in names], dtype=np.int64)
            n, start = column["n"].to_numpy(), column["before"].to_numpy() + column["local"].to_numpy()
            data = column["ids"].to_pylist()
            found = place(mix, queue, start, n, window, length)
            for a in range(0, len(found["row"]), 8 * storage.BATCH_ROWS):
                some = {k: v[a : a + 8 * storage.BATCH_ROWS] for k, v in found.items()}
                ids = []
                for row, begin, size in zip(some["row"].tolist(), some["begin"].tolist(), some["size"].tolist(), strict=True):
                    width = len(data[row]) // int(n[row])
                    piece = data[row][begin * width : (begin + size) * width]
                    ids.append(piece if width == 4 else np.frombuffer(piece, "<u2").astype("<u4").tobytes())
                row = pa.array(some["row"])
                yield pa.RecordBatch.from_pydict({"doc_id": column["doc_id"].take(row), "start": some["begin"], "length": some["size"], "ids": pa.array(ids, pa.binary()), "doc_tokens": n[some["row"]], "sequence_id": some["sequence"], "offset": some["offset"], "queue": column["queue"].take(row)})

    placed = staged.join(base, ["part", "queue"]).select("queue", "doc_id", "local", "n", "ids", "before")
    return placed.mapInArrow(storage.worker("packing", run), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, queue string")


def sequences(pieces: DataFrame, pad_id: int = 0, length: int = LENGTH) -> DataFrame:
    """sequence_id, n_tokens and the ids (array) padded to ``length``, or not at a power of two."""
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate(F.transform("parts", lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    # Four bytes, little endian, make an id.
    byte = lambda b, k: F.conv(F.hex(F.substring(b, k, 1)), 16, 10).cast("long")
    ids = F.transform(F.sequence(F.lit(0), F.col("n_tokens") - 1), lambda k: sum((byte(F.col("joined"), (4 * k + i + 1).cast("int")) * (1 << 8 * i) for i in range(1, 4)), byte(F.col("joined"), (4 * k + 1).cast("int"))))
    power = F.pow(2, F.log2("n_tokens").cast("int")) == F.col("n_tokens")
    pad = F.when(power, F.array().cast("array<bigint>")).otherwise(F.array_repeat(F.lit(pad_id).cast("long"), (length - F.col("n_tokens")).cast("int")))
    return rows.withColumn("joined", joined).select("sequence_id", "n_tokens", F.concat(ids, pad).alias("ids"))

"""Depth of exons under aligned blocks, without dealing out the blocks one by one.

A task sums the ends of its blocks by bin and place first; a row of a bin and the place
and height of its steps is all that is dealt out.  Exons meet these rows in their bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a task sums or looks up at once; more of a bin are held together there.
ROWS = 1 << 17
#: Pairs of an exon and a run, or of a block and a bin, at once.
PAIRS = 1 << 20


def _codes(columns: list) -> list[tuple[np.ndarray, pa.Array]]:
    """Numbers for the values of each column (-1: null), and the values by number."""
    found = []
    for c in columns:
        d = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).dictionary_encode()
        d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
        found.append((d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary))
    return found


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it; the first one does."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _slices(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches of rows with at most ``most`` counts together, of one row at least."""
    ends, low = np.cumsum(counts), 0
    while low < len(counts):
        high = max(low + 1, int(np.searchsorted(ends, most + (ends[low - 1] if low else 0), "right")))
        yield slice(low, high)
        low = high


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` copies of the rows: the row, and the number of the copy."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _steps(rows: pa.Table, place: list[str], size: int) -> Iterator[pa.RecordBatch]:
    codes = _codes([rows[c] for c in place])
    low, high = (rows[c].combine_chunks() for c in ("start", "end"))
    there = low.is_valid().to_numpy(zero_copy_only=False) & high.is_valid().to_numpy(zero_copy_only=False)
    low, high = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (low, high))
    for c, _ in codes:
        there &= c >= 0
    there &= high > low
    low, high, group = low[there], high[there], np.zeros(int(there.sum()), np.int64)
    for c, values in codes:
        group = group * max(1, len(values)) + c[there]
    first = low // size
    counts = (high - 1) // size - first + 1
    for part in _slices(counts, PAIRS):
        row, copy = _spread(counts[part])
        bins, g = first[part][row] + copy, group[part][row]
        at = np.concatenate([np.maximum(low[part][row] - bins * size, 0), np.minimum(high[part][row] - bins * size, size)])
        step = np.repeat(np.array([1, -1]), len(row))
        bins, g = np.tile(bins, 2), np.tile(g, 2)
        order = np.lexsort((at, bins, g))
        at, step, bins, g = at[order], step[order], bins[order], g[order]
        new = np.flatnonzero(_changes(g, bins, at))
        step = np.add.reduceat(step, new)
        new, step = new[step != 0], step[step != 0]
        if not len(new):
            continue
        at, bins, g = at[new], bins[new], g[new]
        heads = np.flatnonzero(_changes(g, bins))
        ahead = np.diff(at, prepend=0)
        ahead[heads] = at[heads]
        offsets = pa.array(np.append(heads, len(at)), pa.int32())
        names, left = [], g[heads]
        for c, values in reversed(codes):
            names.append(values.take(pa.array(left % max(1, len(values)))))
            left = left // max(1, len(values))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((ahead, pa.int16()), (step, pa.int32()))]
        yield pa.RecordBatch.from_arrays([*reversed(names), pa.array(bins[heads], pa.int64()), *lists], [*place, "__bin", "__ahead", "__step"])


def packed_steps(blocks: DataFrame, place: list[str], size: int) -> DataFrame:
    """Steps of depth in bins: place, __bin, __ahead (from the bin's start, then from the step before) and __step.

    A bin has a row for each task with blocks there (one for each ``ROWS`` of its blocks); blocks
    end with the bin, and in no more than two steps of a base, however many there are.  Blocks
    without a place or a length are left out.
    """
    if not 0 < size < 1 << 15:
        raise ValueError("a bin has 1 to 32767 bases")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS:
                yield from _steps(pa.Table.from_batches(held), place, size)
                held, n = [], 0
        if n:
            yield from _steps(pa.Table.from_batches(held), place, size)

    rows = blocks.select(*place, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    fields = [T.StructField(c, rows.schema[c].dataType) for c in place]
    kinds = [T.StructField("__bin", T.LongType()), T.StructField("__ahead", T.ArrayType(T.ShortType())), T.StructField("__step", T.ArrayType(T.IntegerType()))]
    return rows.mapInArrow(run, T.StructType(fields + kinds))


def _look_up(rows: pa.Table, bins: np.ndarray, keys: list[str], size: int, crossing: bool) -> Iterator[pa.Table]:
    """Depth of the exons among whole bins (numbered); of those in several bins the runs, of others the statistics."""
    width = size + 1
    packed = rows["__ahead"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    low, high, own = (rows[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in ("__low", "__high", "__bin"))
    wanted = np.flatnonzero(~packed & ((low // size != (high - 1) // size) == crossing))
    if not len(wanted):
        return
    packs = np.flatnonzero(packed)
    if crossing:
        packs = packs[np.isin(bins[packs], bins[wanted])]
    lists = rows.select(["__ahead", "__step"]).take(pa.array(packs))
    ahead, step = (lists[c].combine_chunks() for c in ("__ahead", "__step"))
    n = ahead.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ahead, step = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (ahead, step))
    at = np.cumsum(ahead)
    heads = np.cumsum(n) - n
    at -= np.repeat(at[heads] - ahead[heads], n)
    at += np.repeat(bins[packs], n) * width
    order = np.argsort(at, kind="stable")
    at, step = at[order], step[order]
    if len(at):
        new = np.flatnonzero(_changes(at))
        at, depth = at[new], np.cumsum(np.add.reduceat(step, new))  # 0 again at the end of each bin
    else:
        depth = step
    at, depth = np.concatenate([[-1], at, [(int(bins[-1]) + 1) * width]]), np.concatenate([[0], depth])
    left = np.maximum(low[wanted] - own[wanted] * size, 0) + bins[wanted] * width
    right = np.minimum(high[wanted] - own[wanted] * size, size) + bins[wanted] * width
    first = np.searchsorted(at, left, "right") - 1
    counts = np.searchsorted(at, right, "left") - first
    for part in _slices(counts, PAIRS):
        row, copy = _spread(counts[part])
        run = first[part][row] + copy
        n = np.minimum(right[part][row], at[run + 1]) - np.maximum(left[part][row], at[run])
        d = depth[run]
        exons = rows.select(keys).take(pa.array(wanted[part]))
        if crossing:
            found = exons.take(pa.array(row))
            yield found.append_column("depth", pa.array(d, pa.int64())).append_column("n", pa.array(n, pa.int64()))
            continue
        heads = np.cumsum(counts[part]) - counts[part]
        whole = right[part] - left[part]
        order = np.lexsort((d, row))
        ends, before = np.cumsum(n[order]), np.cumsum(whole) - whole
        middle = [d[order][np.searchsorted(ends, before + k, "right")] for k in ((whole - 1) // 2, whole // 2)]
        stats = {"mean_depth": np.add.reduceat(d * n, heads) / whole, "median_depth": (middle[0] + middle[1]) / 2, "min_depth": np.minimum.reduceat(d, heads), "max_depth": np.maximum.reduceat(d, heads)}
        for name, values in stats.items():
            exons = exons.append_column(name, pa.array(values))
        yield exons


def exon_depth(exons: DataFrame, blocks: DataFrame, keys: list[str], place: list[str], size: int = 1 << 12) -> DataFrame:
    """Depth of each exon (keys, place, start, end) under blocks (place, start, end): mean, median, least and largest.

    ``keys`` name one exon.  An exon within a bin is done there; of the few others each bin
    gives its runs, which meet by key.  Both read the same dealt rows.
    """
    packs = packed_steps(blocks, place, size)
    low, high = F.col("start").cast("long"), F.col("end").cast("long")
    ends = {k: f"__{name}" for k, name in (("start", "low"), ("end", "high")) if exons.schema[k].dataType == T.LongType()}  # as keys they are dealt out once
    own = [ends.get(k, f"__k{i}") for i, k in enumerate(keys)]
    spans = exons.filter("end > start").select(*place, *(F.col(k).alias(o) for k, o in zip(keys, own, strict=True) if k not in ends), low.alias("__low"), high.alias("__high"))
    bins = F.sequence(F.floor(F.col("__low") / size), F.floor((F.col("__high") - 1) / size))
    pieces = spans.withColumn("__bin", F.explode(bins))
    dealt = pieces.unionByName(packs, allowMissingColumns=True).repartition(*place, "__bin").sortWithinPartitions(*place, "__bin")

    def rows(crossing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def done(table: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
                for found in _look_up(table, np.cumsum(new) - 1, own, size, crossing):
                    yield from found.to_batches()

            def starts(table: pa.Table) -> np.ndarray:
                return _changes(*(c for c, _ in _codes([table[c] for c in (*place, "__bin")])))

            held, n, most = [], 0, ROWS // 4
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= most:
                    table = pa.Table.from_batches(held)
                    new = starts(table)
                    last = int(np.flatnonzero(new)[-1])  # the last bin may go on
                    if last:
                        yield from done(table.slice(0, last).combine_chunks(), new[:last])
                    rest = table.slice(last).combine_chunks()
                    held, n = rest.to_batches(), rest.num_rows
                    most = max(ROWS // 4, 2 * n)
            if n:
                table = pa.Table.from_batches(held)
                yield from done(table.combine_chunks(), starts(table))

        return run

    kinds = [T.StructField(o, exons.schema[k].dataType) for k, o in zip(keys, own, strict=True)]
    stats = [T.StructField(c, t) for c, t in (("mean_depth", T.DoubleType()), ("median_depth", T.DoubleType()), ("min_depth", T.LongType()), ("max_depth", T.LongType()))]
    whole = dealt.mapInArrow(rows(False), T.StructType(kinds + stats))
    runs = dealt.mapInArrow(rows(True), T.StructType([*kinds, T.StructField("depth", T.LongType()), T.StructField("n", T.LongType())]))
    depth, n = F.col("depth"), F.col("n")
    joined = runs.groupBy(*own).agg((F.sum(depth * n) / F.sum(n)).alias("mean_depth"), F.percentile(depth, 0.5, n).alias("median_depth"), F.min(depth).alias("min_depth"), F.max(depth).alias("max_depth"))
    return whole.unionByName(joined).withColumnsRenamed(dict(zip(own, keys, strict=True)))

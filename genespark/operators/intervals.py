"""Joins, merges and coverage of half-open intervals.

Range predicates become equi joins on bins, so a sequence with most of the rows is
spread over its bins; running sums and merges work in bins first and meet in a
small table of one row a bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1 << 14


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 < e2) & (s2 < e1)


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def contains(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Whether [s1, e1) holds all of [s2, e2)."""
    return (s1 <= s2) & (e2 <= e1)


def band_join(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, width: int, how: str = "inner") -> DataFrame:
    """Rows with equal keys and ``|left_at - right_at| <= width``.

    Every right row is in one bin, a left row looks into the two or three bins its
    band touches, so each pair comes once.  Columns other than keys must differ in
    name.  ``how`` may be inner or left.
    """
    size = max(64, 4 * width + 1)
    probe = left.withColumn("__row", F.monotonically_increasing_id()) if how == "left" else left
    wide = probe.withColumn("__bin", F.explode(F.sequence(F.floor((F.col(left_at) - width) / size), F.floor((F.col(left_at) + width) / size))))
    build = right.withColumn("__bin", F.floor(F.col(right_at) / size))
    met = wide.join(build, [*keys, "__bin"]).filter(F.abs(F.col(left_at) - F.col(right_at)) <= width).drop("__bin")
    if how == "inner":
        return met
    extra = [c for c in right.columns if c not in keys]
    return probe.join(met.select("__row", *extra), "__row", "left").drop("__row")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], size: int = BIN) -> DataFrame:
    """Pairs with equal keys whose spans overlap, each once: in the first bin both touch.

    Both sides are dealt out: how many rows the bins make isn't known to the planner, which
    would send a long table to the driver and all executors when its source is small.
    """
    (ls, le), (rs, re) = left_span, right_span
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / size), F.floor((F.greatest(F.col(e) - 1, F.col(s))) / size)))
    met = left.withColumn("__bin", bins(ls, le)).join(right.withColumn("__bin", bins(rs, re)).hint("merge"), [*keys, "__bin"])
    first = F.greatest(F.floor(F.col(ls) / size), F.floor(F.col(rs) / size)) == F.col("__bin")
    return met.filter(first & overlaps(F.col(ls), F.col(le), F.col(rs), F.col(re))).drop("__bin")


def _merge(df: DataFrame, keys: list, start: str, end: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    island = marked.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")


def merge(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", size: int = BIN) -> DataFrame:
    """Merge overlapping and touching intervals; first those that begin in a bin, then the islands."""
    local = _merge(df.select(*keys, start, end).withColumn("__bin", F.floor(F.col(start) / size)), [*keys, "__bin"], start, end)
    return _merge(local.drop("__bin"), keys, start, end)


def coverage_fraction(df: DataFrame, keys: list[str], low: int, high: int, start: str = "start", end: str = "end") -> DataFrame:
    """Share of [low, high) that the intervals of each key cover."""
    covered = merge(df, keys, start, end).withColumn("__n", overlap_length(F.col(start), F.col(end), F.lit(low), F.lit(high)))
    return covered.groupBy(*keys).agg((F.sum("__n") / float(high - low)).alias("fraction"))


def coverage_runs(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", size: int = BIN) -> DataFrame:
    """Runs of constant depth: keys, start, end, depth (only where depth > 0).

    A sweep over +1 and -1 events.  Depth at the start of a bin is the sum of all
    earlier bins, taken from a table of one row a bin.
    """
    ends = F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("step")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("step"))))
    events = df.select(*keys, ends.alias("e")).select(*keys, "e.pos", "e.step").groupBy(*keys, "pos").agg(F.sum("step").alias("step"))
    events = events.withColumn("__bin", F.floor(F.col("pos") / size))
    bins = events.groupBy(*keys, "__bin").agg(F.sum("step").alias("__sum"), F.min("pos").alias("__first"))
    order = Window.partitionBy(*keys).orderBy("__bin")
    bins = bins.select(*keys, "__bin", F.coalesce(F.sum("__sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"), F.lead("__first").over(order).alias("__next"))
    inside = Window.partitionBy(*keys, "__bin").orderBy("pos")
    runs = events.join(bins, [*keys, "__bin"]).select(
        *keys,
        F.col("pos").alias("start"),
        F.coalesce(F.lead("pos").over(inside), F.col("__next")).alias("end"),
        (F.col("__base") + F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"),
    )
    return runs.filter("depth > 0")


def run_stats(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, largest and smallest depth over runs, weighted by their length."""
    n = F.col("end") - F.col("start")
    return runs.groupBy(*keys).agg((F.sum(F.col("depth") * n) / F.sum(n)).alias("mean_depth"), F.max("depth").alias("max_depth"), F.min("depth").alias("min_depth"))


def islands(df: DataFrame, keys: list[str], at: str, value: str, below: float, least: int, size: int = BIN) -> DataFrame:
    """Runs of consecutive positions with a value under ``below``, of at least ``least`` positions: start, end, score.

    Runs are found inside bins; those that touch at bin ends are joined in a table of
    the bins' runs, so a long scaffold isn't sorted in one task.
    """
    low = df.filter(F.col(value) < below).withColumn("__bin", F.floor(F.col(at) / size))
    group = F.col(at) - F.row_number().over(Window.partitionBy(*keys, "__bin").orderBy(at))
    parts = low.withColumn("__run", group).groupBy(*keys, "__bin", "__run").agg(F.min(at).alias("start"), (F.max(at) + 1).alias("end"), F.sum(value).alias("__sum"))
    # Inner runs are whole; only those at an end of their bin can go on in the next one.
    edge = (F.col("start") % size == 0) | (F.col("end") % size == 0)
    inner = parts.filter(~edge).select(*keys, "start", "end", "__sum")
    order = Window.partitionBy(*keys).orderBy("start")
    touching = parts.filter(edge)
    marked = touching.withColumn("__new", F.when(F.lag("end").over(order) == F.col("start"), 0).otherwise(1))
    marked = marked.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = marked.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("__sum").alias("__sum")).drop("__island")
    found = inner.unionByName(joined).withColumn("score", F.col("__sum") / (F.col("end") - F.col("start"))).drop("__sum")
    return found.filter(F.col("end") - F.col("start") >= least)


def smooth(df: DataFrame, keys: list[str], at: str, value: str, window: int = 20, size: int = BIN) -> DataFrame:
    """Zero-padded moving mean over ``window`` positions; shorter signals stay as they are.

    Needs a row for each position.  Bins get the few positions that they share with
    their neighbours, so the window function runs inside a bin.
    """
    before, after = window // 2, window - window // 2 - 1
    spread = F.sequence(F.floor((F.col(at) - after) / size), F.floor((F.col(at) + before) / size))
    wide = df.withColumn("__home", F.floor(F.col(at) / size)).withColumn("__bin", F.explode(spread))
    order = Window.partitionBy(*keys, "__bin").orderBy(at)
    total = F.sum(value).over(order.rowsBetween(-before, after))
    own = wide.withColumn("__total", total).filter(F.col("__bin") == F.col("__home")).drop("__bin", "__home")
    n = df.groupBy(*keys).agg(F.count("*").alias("__n"))  # a row a signal
    found = own.join(n, keys) if keys else own.join(F.broadcast(n), F.lit(True))
    return found.withColumn("smoothed", F.when(F.col("__n") < window, F.col(value)).otherwise(F.col("__total") / window)).drop("__n", "__total")


def introns(exons: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Gaps between consecutive exons, where there is one: intron_start, intron_end."""
    follow = F.lead(start).over(Window.partitionBy(*keys).orderBy(start, end))
    return exons.withColumn("intron_end", follow).withColumn("intron_start", F.col(end)).filter("intron_end > intron_start")


def offsets(df: DataFrame, length: str, order: str) -> DataFrame:
    """Running sum of lengths before each row of a table with a row for each scaffold."""
    return df.withColumn("offset", F.coalesce(F.sum(length).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

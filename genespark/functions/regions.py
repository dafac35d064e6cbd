"""Region strings: 1-based inclusive outside, half-open inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN = r"^(\S+):([0-9,]+)(?:-|\.\.)([0-9,]+)$"


def parse(text: Column) -> Column:
    """struct<seqid, start, end> of ``chr:a-b`` or ``chr:a..b``; null if it is malformed or a < 1 or b < a."""
    number = lambda k: F.replace(F.regexp_extract(text, PATTERN, k), F.lit(","), F.lit("")).try_cast("long")
    low, high = number(2), number(3)
    return F.when(text.rlike(PATTERN) & (low >= 1) & (high >= low), F.struct(F.regexp_extract(text, PATTERN, 1).alias("seqid"), (low - 1).alias("start"), high.alias("end")))


def render(seqid: Column, start: Column, end: Column) -> Column:
    return F.concat(seqid, F.lit(":"), (start + 1).cast("string"), F.lit("-"), end.cast("string"))


def invalid(regions: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Regions on an unknown scaffold or beyond its end, with the reason."""
    known = regions.join(scaffolds.select("seqid", "length"), "seqid", "left")
    reason = F.when(F.col("length").isNull(), "unknown scaffold").when(F.col("end") > F.col("length"), "beyond the end")
    return known.withColumn("reason", reason).filter("reason IS NOT NULL")

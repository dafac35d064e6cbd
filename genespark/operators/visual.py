"""The numbers behind plots; drawing is left to whatever shows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import confidence


def score_distribution(scores: DataFrame, value: str = "overall_score", bins: int = 30) -> DataFrame:
    """Counts in equal bins of [0, 1], the last one closed; empty bins count 0."""
    place = F.least(F.floor(F.col(value) * bins), F.lit(bins - 1)).cast("int")
    counts = scores.filter(F.col(value).between(0, 1)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = scores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))  # a row a bin


def score_statistics(scores: DataFrame, value: str = "overall_score") -> DataFrame:
    """One row: number, mean, median and population deviation."""
    return scores.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.stddev_pop(value).alias("deviation"))


def class_shares(scores: DataFrame, column: str = "confidence_class") -> DataFrame:
    """Each class, its number and share."""
    counts = scores.groupBy(column).agg(F.count("*").alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))  # one row
    return counts.join(total, F.lit(True)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


def boxes(scores: DataFrame, key: str = "seqid", value: str = "overall_score", most: int | None = None) -> DataFrame:
    """Number, quartiles, ends and mean of a score for each key; with ``most`` those of the lowest medians."""
    part = lambda q: F.percentile(value, q)
    found = scores.groupBy(key).agg(F.count(value).alias("n"), F.min(value).alias("low"), part(0.25).alias("q1"), part(0.5).alias("median"), part(0.75).alias("q3"), F.max(value).alias("high"), F.avg(value).alias("mean"))
    return found if most is None else found.orderBy("median", key).limit(most)


def metric_panels(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """Each metric's number, mean, ends and correlation with the overall score, one row a metric."""
    rows = scores.select("overall_score", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics))).alias("m")).select("overall_score", "m.*")
    return rows.groupBy("metric").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.corr("value", "overall_score").alias("correlation"))


def lowest(scores: DataFrame, n: int, value: str = "overall_score") -> DataFrame:
    """The n genes with the least score."""
    return scores.orderBy(value, "gene_id").limit(n)


def splice_panels(reports: DataFrame) -> DataFrame:
    """Genes by panel and bin: tenths of the support ratio, and corrections (10 stands for 10 or more)."""
    ratio = F.least(F.floor(F.col("support_ratio") * 10), F.lit(9)).cast("int")
    pairs = F.array(F.struct(F.lit("support").alias("panel"), ratio.alias("bin")), F.struct(F.lit("corrections").alias("panel"), F.least(F.col("n_corrected"), F.lit(10)).cast("int").alias("bin")))
    return reports.select(F.explode(pairs).alias("p")).groupBy("p.panel", "p.bin").agg(F.count("*").alias("n_genes"))


def shift_counts(decisions: DataFrame) -> DataFrame:
    """Corrected sites by their shift."""
    shifts = F.array(F.col("new_start") - F.col("intron_start"), F.col("new_end") - F.col("intron_end"))
    return decisions.select(F.explode(shifts).alias("shift")).filter("shift <> 0").groupBy("shift").agg(F.count("*").alias("n"))


def before_after(old: DataFrame, new: DataFrame) -> DataFrame:
    """Exons of transcripts before and after, side by side by number: transcript_id, k and the four ends."""
    part = lambda rows, name: rows.select("transcript_id", F.posexplode(F.array_sort("exons")).alias("k", "e")).select("transcript_id", "k", F.col("e.start").alias(f"{name}_start"), F.col("e.end").alias(f"{name}_end"))
    return part(old, "old").join(part(new, "new"), ["transcript_id", "k"], "full_outer")


def gene_track(bases: DataFrame, keys: list[str], at: str = "pos", probs: str = "probs", window: int = 20) -> DataFrame:
    """Per base of a gene: largest probability, entropy, class and smoothed probability."""
    from .genes import confidence_track

    return confidence_track(bases, keys, at, probs, window)


def logo(sites: DataFrame, column: str = "site") -> DataFrame:
    """Share of each base by position (from 1) of aligned sites, and its information against 0.25: pos, base, share, bits."""
    letters = sites.select(F.posexplode(F.split(F.upper(column), "")).alias("pos", "base")).filter(F.col("base") != "")
    counts = letters.groupBy("pos").agg(F.count("*").alias("n"), *(F.count_if(F.col("base") == b).alias(b) for b in "ACGT"))
    cells = F.explode(F.array(*(F.struct(F.lit(b).alias("base"), (F.col(b) / F.col("n")).alias("share")) for b in "ACGT")))
    rows = counts.select((F.col("pos") + 1).alias("pos"), cells.alias("c")).select("pos", "c.*")
    return rows.withColumn("bits", F.when(F.col("share") > 0, F.col("share") * F.log2(F.col("share") / 0.25)).otherwise(0.0))


# Colours of scores by the limits of the confidence classes.
COLOURS = ("#27ae60", "#f39c12", "#e74c3c")


def colour(score: Column) -> Column:
    return F.when(score >= confidence.HIGH, COLOURS[0]).when(score >= confidence.MEDIUM, COLOURS[1]).otherwise(COLOURS[2])

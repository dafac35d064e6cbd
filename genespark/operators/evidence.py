"""Evidence of genes: junction support, exon coverage, edit distance and level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edit_distance(junction: Column, coverage: Column, boundary: Column, weights: tuple[float, float, float] = (0.5, 0.3, 0.2)) -> Column:
    """Annotation edit distance: weighted distances, clamped to 0..1."""
    a, b, c = weights
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), a * (1.0 - junction) + b * (1.0 - coverage) + c * (1.0 - boundary)))


def level(n_introns: Column, junction: Column, coverage: Column) -> Column:
    """full, partial, minimal or none; genes of one exon go by coverage alone."""
    single = F.when(coverage >= 0.8, "full").when(coverage >= 0.5, "partial").when(coverage > 0, "minimal").otherwise("none")
    multi = (
        F.when((junction >= 1.0) & (coverage >= 0.8), "full")
        .when((junction >= 0.8) | ((junction >= 0.5) & (coverage >= 0.5)), "partial")
        .when((junction > 0) | (coverage > 0), "minimal")
        .otherwise("none")
    )
    return F.when(n_introns == 0, single).otherwise(multi)


def flags(n_introns: Column, junction: Column, n_expressed: Column, coverage: Column, start_ok: Column, stop_ok: Column) -> Column:
    """Evidence flags in their fixed order."""
    marks = F.array(
        F.when((n_introns > 0) & (junction == 0), "NO_JUNCTION_SUPPORT").when((n_introns > 0) & (junction < 1), "PARTIAL_JUNCTION_SUPPORT"),
        F.when(n_expressed == 0, "NO_EXON_EXPRESSION").when(coverage < 0.5, "LOW_EXON_COVERAGE"),
        F.when(~start_ok, "START_UNSUPPORTED"),
        F.when(~stop_ok, "STOP_UNSUPPORTED"),
    )
    return F.filter(marks, lambda x: x.isNotNull())


def gene_support(matched: DataFrame, keys: list[str], least_reads: int = 3) -> DataFrame:
    """Per gene from introns with their nearest junction: counts, ratio, distance and level without coverage."""
    supported = F.col("junction_reads") >= least_reads
    counts = matched.groupBy(*keys).agg(
        F.count("*").alias("n_introns"),
        F.count_if(supported).alias("n_supported"),
        F.count_if(F.col("shift") == 0).alias("n_exact"),
    )
    ratio = F.when(F.col("n_introns") == 0, 1.0).otherwise(F.col("n_supported") / F.col("n_introns"))
    counts = counts.withColumn("junction_ratio", F.round(ratio, 6))
    return counts.withColumn("aed", F.round(edit_distance(F.col("junction_ratio"), F.lit(0.0), F.lit(0.0)), 6)).withColumn("evidence_level", level(F.col("n_introns"), F.col("junction_ratio"), F.lit(0.0)))


def exon_stats(bases: DataFrame, keys: list[str], depth: str, least: float = 5) -> DataFrame:
    """Depth statistics of exons from one row a base (or sample of it)."""
    mean, spread = F.avg(depth), F.stddev_pop(depth)
    return bases.groupBy(*keys).agg(
        F.round(mean, 6).alias("mean_depth"),
        F.round(F.median(depth), 6).alias("median_depth"),
        F.min(depth).alias("min_depth"),
        F.max(depth).alias("max_depth"),
        F.round(F.count_if(F.col(depth) >= least) / F.count("*"), 6).alias("covered"),
        F.round(F.when(mean > 0, spread / mean).otherwise(0.0), 6).alias("variation"),
    )

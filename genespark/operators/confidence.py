"""Confidence of genes from per-base class probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = ("intergenic", "utr", "cds", "intron")
WEIGHTS = {"mean_prob": 0.30, "min_prob": 0.20, "boundary_sharpness": 0.20, "coding_consistency": 0.15, "worst_exon_score": 0.15}
HIGH, MEDIUM = 0.85, 0.70


def entropy(probs: Column) -> Column:
    """Shannon entropy in bits, probabilities clipped at 1e-10."""
    clip = lambda x: F.greatest(x, F.lit(1e-10))
    return -F.aggregate(probs, F.lit(0.0), lambda a, x: a + clip(x) * F.log2(clip(x)))


def call(probs: Column) -> Column:
    """Index of the most probable class, the first on a tie."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def sharpness(signal: Column, boundaries: Column, edge: int = 20, half: int = 10) -> Column:
    """Mean over boundaries of min(1, twice the largest step within ten bases); 0.5 without any.

    ``signal`` is an array, boundaries are 0-based positions in it.  Boundaries
    within ``edge`` of an end are left out, and so is a signal under twice that.
    """
    n = F.size(signal)
    used = F.filter(boundaries, lambda b: (b >= edge) & (b < n - edge))
    step = lambda b: F.array_max(F.transform(F.sequence(b - half + 1, b + half - 1), lambda k: F.abs(F.element_at(signal, (k + 1).cast("int")) - F.element_at(signal, k.cast("int")))))
    total = F.aggregate(F.transform(used, lambda b: F.least(F.lit(1.0), 2 * step(b))), F.lit(0.0), lambda a, x: a + x)
    return F.when((n >= 2 * edge) & (F.size(used) > 0), total / F.size(used)).otherwise(F.lit(0.5))


def consistency(is_cds: Column, prob: Column) -> Column:
    """Aggregate over the bases of a coding segment: calls, probability and evenness, each a third."""
    return (F.avg(is_cds.cast("double")) + F.avg(prob) + 1 - F.least(F.lit(1.0), 4 * F.var_pop(prob))) / 3


def overall(metrics: dict[str, str] | None = None, weights: dict[str, float] | None = None) -> Column:
    """Weighted sum of the metrics; the usual weights unless others are given."""
    names, weights = metrics or {k: k for k in WEIGHTS}, WEIGHTS if weights is None else weights
    return sum((F.col(names[k]) * w for k, w in weights.items()), F.lit(0.0))


def region_means(bases: DataFrame, keys: list[str], probs: str = "probs") -> DataFrame:
    """Mean entropy and mean largest probability over the bases of each region."""
    return bases.groupBy(*keys).agg(F.avg(entropy(F.col(probs))).alias("mean_entropy"), F.avg(F.array_max(probs)).alias("mean_confidence"))


def flags(length: Column, mean_prob: Column, min_prob: Column, mean_entropy: Column, sharp: Column, worst_exon: Column, n_low: Column) -> Column:
    """Confidence flags in their fixed order."""
    marks = F.array(
        F.when(worst_exon < 0.6, "weak_exon"),
        F.when(sharp < 0.7, "uncertain_boundary"),
        F.when(mean_entropy > 1.0, "high_entropy"),
        F.when(min_prob < 0.3, "very_low_min_prob").when(min_prob < 0.5, "low_min_prob"),
        F.when((length < 300) & (mean_prob < 0.7), "short_low_conf"),
        F.when(n_low > 3, "many_low_conf_regions").when(n_low > 0, "has_low_conf_regions"),
    )
    return F.filter(marks, lambda x: x.isNotNull())


def confidence_class(score: Column, marks: Column, mean_entropy: Column, sharp: Column) -> Column:
    """low by a critical flag or a score under 0.70; high from 0.85 on without any flag; else medium."""
    critical = F.arrays_overlap(marks, F.array(*map(F.lit, ("weak_exon", "very_low_min_prob", "many_low_conf_regions")))) | (sharp < 0.5) | (mean_entropy > 1.5)
    return F.when(critical | (score < MEDIUM), "low").when((score >= HIGH) & (F.size(marks) == 0), "high").otherwise("medium")


def median_of(values: Column) -> Column:
    """Median of an array, null of an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    at = lambda k: F.get(ordered, k.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def score_genes(genes: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Confidence of genes given as arrays.

    Needs gene_id, length, probs (array of arrays by base), exons and cds (arrays of
    struct<start, end> relative to the gene).  Genes without probabilities get the
    fallback record: scores 0, entropy 2, class low, flag scoring_error.
    low_regions (relative to the gene), exon_scores and intron_scores are lists by place.
    """
    clamp = lambda e, n: F.struct(F.greatest(e["start"], F.lit(0)).alias("start"), F.least(e["end"], n).alias("end"))
    n = F.size("top")
    mean = lambda a: F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a))
    cut = lambda a, e: F.slice(a, (e["start"] + 1).cast("int"), (e["end"] - e["start"]).cast("int"))
    found = genes.withColumn("top", F.transform("probs", lambda p: F.array_max(p))).withColumn("bits", F.transform("probs", entropy)).withColumn("calls", F.transform("probs", call)).withColumn("coding", F.transform("probs", lambda p: p[2]))
    if "introns" not in found.columns:
        inner = F.array_sort("exons")
        gaps = F.zip_with(F.slice(inner, 1, F.greatest(F.size(inner) - 1, F.lit(0))), F.slice(inner, 2, F.greatest(F.size(inner), F.lit(1))), lambda a, b: F.struct(a["end"].alias("start"), b["start"].alias("end")))
        found = found.withColumn("introns", gaps)
    found = found.withColumn("between", F.transform("probs", lambda p: p[3]))
    for name in ("exons", "cds", "introns"):
        found = found.withColumn(name, F.filter(F.transform(name, lambda e: clamp(e, n)), lambda e: e["start"] < e["end"]))
    found = found.withColumn("exon_scores", F.transform("exons", lambda e: mean(cut(F.col("top"), e))))
    even = lambda a: mean(F.transform(a, lambda x: x * x)) - mean(a) * mean(a)
    segment = lambda e: (mean(F.transform(cut(F.col("calls"), e), lambda c: F.when(c == 2, 1.0).otherwise(0.0))) + mean(cut(F.col("coding"), e)) + 1 - F.least(F.lit(1.0), 4 * even(cut(F.col("coding"), e)))) / 3
    listed = F.expr("""aggregate(transform(top, (x, i) -> named_struct('x', x, 'i', i)), named_struct('run', 0, 'sum', 0D, 'found', cast(array() as array<struct<start:int,end:int,score:double>>)),
        (s, b) -> named_struct('run', IF(b.x < 0.7D, s.run + 1, 0), 'sum', IF(b.x < 0.7D, s.sum + b.x, 0D),
            'found', IF(b.x >= 0.7D AND s.run >= 10, concat(s.found, array(named_struct('start', b.i - s.run, 'end', b.i, 'score', s.sum / s.run))), s.found)),
        s -> IF(s.run >= 10, concat(s.found, array(named_struct('start', size(top) - s.run, 'end', size(top), 'score', s.sum / s.run))), s.found))""")
    low = F.expr("aggregate(top, named_struct('run', 0, 'n', 0), (s, x) -> named_struct('run', IF(x < 0.7D, s.run + 1, 0), 'n', s.n + IF(x < 0.7D AND s.run = 9, 1, 0)), s -> s.n)")
    boundaries = F.flatten(F.transform("exons", lambda e: F.array(e["start"], e["end"])))
    found = found.select(
        "gene_id",
        "length",
        mean(F.col("top")).alias("mean_prob"),
        F.array_min("top").alias("min_prob"),
        median_of(F.col("top")).alias("median_prob"),
        mean(F.col("bits")).alias("mean_entropy"),
        sharpness(F.col("top"), boundaries).alias("boundary_sharpness"),
        F.when(F.size("cds") > 0, mean(F.transform("cds", segment))).otherwise(0.5).alias("coding_consistency"),
        F.coalesce(F.array_min("exon_scores"), mean(F.col("top"))).alias("worst_exon_score"),
        (F.array_position("exon_scores", F.array_min("exon_scores")) - 1).alias("worst_exon_idx"),
        F.transform("introns", lambda e: mean(cut(F.col("between"), e))).alias("intron_scores"),
        "exon_scores",
        F.size("exons").alias("n_exons"),
        low.alias("n_low_regions"),
        listed.alias("low_regions"),
        (n > 0).alias("scored"),
    )
    found = found.withColumn("overall_score", overall(weights=weights)).withColumn("flags", flags(*(F.col(c) for c in ("length", "mean_prob", "min_prob", "mean_entropy", "boundary_sharpness", "worst_exon_score", "n_low_regions"))))
    found = found.withColumn("confidence_class", confidence_class(F.col("overall_score"), F.col("flags"), F.col("mean_entropy"), F.col("boundary_sharpness")))
    failed = {"mean_entropy": F.lit(2.0), "confidence_class": F.lit("low"), "flags": F.array(F.lit("scoring_error"))} | {c: F.lit(0.0) for c in ("mean_prob", "min_prob", "boundary_sharpness", "coding_consistency", "worst_exon_score", "overall_score")}
    return found.withColumns({c: F.when(F.col("scored"), F.col(c)).otherwise(v) for c, v in failed.items()}).drop("scored")

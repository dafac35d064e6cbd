"""Protein search hits: best hit, coverage, status, chimeras, fragments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import merge


@dataclass(frozen=True)
class Thresholds:
    """Limits of a validation; coverages are fractions, identity is in percent."""

    identity: float = 30.0
    query_coverage: float = 0.5
    subject_coverage: float = 0.5
    evalue: float = 1e-5
    complete_query: float = 0.8
    complete_subject: float = 0.5


DEFAULT = Thresholds()
STRICT = Thresholds(50.0, 0.7, 0.7, 1e-10, 0.9, 0.7)
RELAXED = Thresholds(20.0, 0.3, 0.3, 1e-3, 0.6, 0.3)
CHIMERA_OVERLAP, FRAGMENT_OVERLAP, FRAGMENT_COVERAGE, TE_FRACTION = 10, 50, 0.8, 0.5


def coverage(start: Column, end: Column, length: Column) -> Column:
    """Share of a sequence that 1-based inclusive residues cover; 0 without a length."""
    return F.when(length > 0, (end - start + 1) / length).otherwise(F.lit(0.0))


def significant(hits: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    return hits.filter((F.col("evalue") <= limits.evalue) & (F.col("identity") >= limits.identity))


def best_hits(hits: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """Per query the hit with the least e-value (the first on a tie), hits and subjects, and where its hits begin (first_ord)."""
    rest = [c for c in hits.columns if c not in keys]
    found = hits.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("evalue", order)).alias("__b"), F.count("*").alias("n_hits"), F.countDistinct("subject_id").alias("n_subjects"), F.min(order).alias("first_ord"))
    return found.select(*keys, "n_hits", "n_subjects", "first_ord", "__b.*")


def status(query_coverage: Column, subject_coverage: Column, limits: Thresholds = DEFAULT) -> Column:
    """complete or partial for a gene with a significant hit; a missing coverage counts as 0."""
    return F.when((query_coverage >= limits.complete_query) & (subject_coverage >= limits.complete_subject), "complete").otherwise("partial")


def precedence(base: Column, chimeric: Column, te: Column, fragmented: Column) -> Column:
    """Final status: fragmented over te_overlap over chimeric over the base status."""
    return F.when(fragmented, "fragmented").when(te, "te_overlap").when(chimeric, "chimeric").otherwise(base)


def chimeras(hits: DataFrame, query: str = "query_id", corrected: bool = False) -> DataFrame:
    """First pair of neighbouring hits of a query to different subjects that hardly overlap.

    Per subject the hit with the best e-value counts; hits that begin at the same place
    stand in the order in which their subjects first come.  A gap of any size qualifies;
    with ``corrected`` only one without overlap beyond the limit on either side.  ``gap``
    and ``overlap`` are both 0 or more.
    """
    best = best_hits(hits, [query, "subject_id"]).select(query, "subject_id", "query_start", "query_end", "identity", "first_ord")
    order = Window.partitionBy(query).orderBy("query_start", "first_ord")
    pair = best.select(query, F.col("subject_id").alias("subject_a"), F.lead("subject_id").over(order).alias("subject_b"), F.struct("query_start", "first_ord").alias("at"), (F.lead("query_start").over(order) - F.col("query_end")).alias("gap"), ((F.col("identity") + F.lead("identity").over(order)) / 2).alias("identity"))
    zero = F.lit(0)
    pair = pair.withColumn("overlap", F.greatest(zero, -F.col("gap"))).filter(F.col("subject_b").isNotNull() & (F.col("overlap") <= (0 if corrected else CHIMERA_OVERLAP)))
    rest = ["subject_a", "subject_b", "gap", "overlap", "identity"]
    found = pair.groupBy(query).agg(F.min_by(F.struct(*rest), "at").alias("p"))
    return found.select(query, "p.subject_a", "p.subject_b", F.greatest(zero, F.col("p.gap")).alias("gap"), "p.overlap", F.least(F.lit(1.0), F.col("p.identity") / 100).alias("confidence"))


def fragments(hits: DataFrame, query: str = "query_id") -> DataFrame:
    """Best hits of queries to a subject that may be pieces of it: subject_id, query, subject_start, subject_end, subject_length.

    A query takes part if its best hit meets the next one with an overlap within
    the limit; the last hit of a subject always does.  Hits that begin at the same place
    stand in the order of the file.
    """
    best = best_hits(hits, ["subject_id", query]).select("subject_id", query, "subject_start", "subject_end", "subject_length", "first_ord")
    order = Window.partitionBy("subject_id").orderBy("subject_start", "first_ord", query)
    follow = F.lead("subject_start").over(order)
    return best.withColumn("follow", follow).filter(F.col("follow").isNull() | (F.col("subject_end") - F.col("follow") <= FRAGMENT_OVERLAP)).drop("follow", "first_ord")


def fragment_groups(hits: DataFrame, query: str = "query_id", least: float = FRAGMENT_COVERAGE) -> DataFrame:
    """Subjects that two or more queries cover together in pieces: subject_id, n_queries, coverage."""
    part = fragments(hits, query)
    counts = part.groupBy("subject_id").agg(F.count("*").alias("n_queries"), F.max("subject_length").alias("subject_length")).filter("n_queries > 1")
    spans = merge(part.select("subject_id", F.col("subject_start").alias("start"), (F.col("subject_end") + 1).alias("end")), ["subject_id"])
    covered = spans.groupBy("subject_id").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    found = counts.join(covered, "subject_id").withColumn("coverage", F.col("covered") / F.col("subject_length"))
    return found.filter(F.col("coverage") >= least).select("subject_id", "n_queries", "coverage")


def with_missing(genes: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Results and a no_hit row for every gene without one."""
    rest = [F.lit("no_hit").alias("status") if c == "status" else F.lit(None).cast(t).alias(c) for c, t in results.dtypes if c != key]
    return results.unionByName(genes.select(key).join(results, key, "left_anti").select(key, *rest))

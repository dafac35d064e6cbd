"""Splice junctions: counting, samples, and their match with introns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import band_join

KEY = ["seqid", "start", "end"]


def last_wins(junctions: DataFrame, order: str) -> DataFrame:
    """One row for each (seqid, start, end): the last in file order."""
    rest = [c for c in junctions.columns if c not in KEY]
    return junctions.groupBy(*KEY).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*KEY, "__r.*")


def majority_strand(counts: DataFrame, reads: str = "reads") -> DataFrame:
    """Total reads of a junction and the strand with most of them (the smaller sign on a tie)."""
    by_strand = counts.groupBy(*KEY, "strand").agg(F.sum(reads).alias("n"))
    best = F.min_by("strand", F.struct(-F.col("n"), F.col("strand")))
    return by_strand.groupBy(*KEY).agg(F.sum("n").alias("read_count"), best.alias("strand"))


def multi_sample(counts: DataFrame, least_reads: int, least_samples: int) -> DataFrame:
    """Junctions over samples: a sample supports one with ``least_reads`` reads on both strands together."""
    per_sample = counts.groupBy(*KEY, "sample").agg(F.sum("reads").alias("n"))
    total = per_sample.groupBy(*KEY).agg(F.sum("n").alias("total_reads"), F.count_if(F.col("n") >= least_reads).alias("n_samples"))
    return total.filter(F.col("n_samples") >= least_samples).join(majority_strand(counts).select(*KEY, "strand"), KEY)


def exact(introns: DataFrame, junctions: DataFrame) -> DataFrame:
    """Introns with the reads of the junction at the same place (strand ignored), or null."""
    found = junctions.select("seqid", F.col("start").alias("intron_start"), F.col("end").alias("intron_end"), F.col("reads").alias("junction_reads"))
    return introns.join(found, ["seqid", "intron_start", "intron_end"], "left")


def nearby(introns: DataFrame, junctions: DataFrame, window: int, least_reads: int) -> DataFrame:
    """All junctions whose two ends lie within the window, on the same strand or an unknown one."""
    found = junctions.filter(F.col("reads") >= least_reads).select("seqid", F.col("start").alias("junction_start"), F.col("end").alias("junction_end"), F.col("strand").alias("junction_strand"), F.col("reads").alias("junction_reads"))
    met = band_join(introns, found, ["seqid"], "intron_start", "junction_start", window)
    same = (F.col("junction_strand") == F.col("strand")) | (F.col("junction_strand") == ".")
    return met.filter((F.abs(F.col("intron_end") - F.col("junction_end")) <= window) & same)


def nearest(introns: DataFrame, junctions: DataFrame, tolerance: int, keys: list[str]) -> DataFrame:
    """For each intron (by ``keys``) the junction with the least summed shift, the first by place on a tie.

    Strand isn't compared; introns without one keep nulls.
    """
    found = junctions.select("seqid", F.col("start").alias("junction_start"), F.col("end").alias("junction_end"), F.col("reads").alias("junction_reads"))
    met = band_join(introns, found, ["seqid"], "intron_start", "junction_start", tolerance).filter(F.abs(F.col("intron_end") - F.col("junction_end")) <= tolerance)
    shift = F.abs(F.col("intron_start") - F.col("junction_start")) + F.abs(F.col("intron_end") - F.col("junction_end"))
    row = F.struct(shift.alias("shift"), "junction_start", "junction_end", "junction_reads")
    best = met.groupBy(*keys).agg(F.min(row).alias("__b")).select(*keys, "__b.*")
    return introns.join(best, keys, "left")


def support(introns: DataFrame, junctions: DataFrame, tolerance: int, keys: list[str], least_reads: int, order: str, size: int = 1 << 9) -> DataFrame:
    """Per ``keys`` the introns (keys, seqid, intron_start, intron_end), those with ``least_reads`` of their nearest junction and the exact ones.

    As ``last_wins`` and ``nearest`` one after the other, but introns and junctions are dealt
    out once, by bin: equal junctions, pairs and the choice among them are all inside bins.
    An intron counts once for its place.
    """
    gaps = introns.select(*keys, "seqid", "intron_start", "intron_end").withColumn("__bin", F.floor(F.col("intron_start") / size)).repartition("seqid", "__bin")
    bins = F.sequence(F.floor((F.col("start") - tolerance) / size), F.floor((F.col("start") + tolerance) / size))
    found = junctions.select(*KEY, "reads", F.col(order).alias("__ord")).withColumn("__at", F.explode(bins)).repartition("seqid", "__at")
    last = found.groupBy("seqid", "__at", "start", "end").agg(F.max_by("reads", "__ord").alias("reads"))
    build = last.select(F.col("seqid").alias("__seqid"), "__at", F.col("start").alias("__start"), F.col("end").alias("__end"), "reads")
    left, right = F.abs(F.col("intron_start") - F.col("__start")), F.abs(F.col("intron_end") - F.col("__end"))
    same = (F.col("seqid") == F.col("__seqid")) & (F.col("__bin") == F.col("__at"))
    met = gaps.join(build.hint("merge"), same & (left <= tolerance) & (right <= tolerance), "left")
    row = F.when(F.col("__start").isNotNull(), F.struct((left + right).alias("shift"), "__start", "__end", "reads"))
    best = met.groupBy(*dict.fromkeys([*keys, "seqid", "__bin", "intron_start", "intron_end"])).agg(F.min(row).alias("__b"))
    reads = F.coalesce(F.col("__b.reads"), F.lit(0))
    return best.groupBy(*keys).agg(F.count("*").alias("n_introns"), F.count_if(reads >= least_reads).alias("n_introns_supported"), F.count_if(F.col("__b.shift") == 0).alias("n_introns_exact"))


def first_match(introns: DataFrame, junctions: DataFrame, tolerance: int, keys: list[str]) -> DataFrame:
    """For each intron the first junction (smallest ``ord``) within the tolerance on its strand or an unknown one.

    With a tolerance of 0 the junction at the same place, whatever its strand; of equal
    places the last counts.  Introns without one keep nulls.
    """
    places = junctions.groupBy(*KEY).agg(F.max_by(F.struct("strand", "reads"), "ord").alias("__l"), F.min("ord").alias("ord")).select(*KEY, "__l.*", "ord")
    found = places.select("seqid", F.col("start").alias("junction_start"), F.col("end").alias("junction_end"), F.col("strand").alias("junction_strand"), F.col("reads").alias("junction_reads"), "ord")
    met = band_join(introns, found, ["seqid"], "intron_start", "junction_start", tolerance).filter(F.abs(F.col("intron_end") - F.col("junction_end")) <= tolerance)
    if tolerance:
        met = met.filter((F.col("junction_strand") == F.col("strand")) | (F.col("junction_strand") == "."))
    best = met.groupBy(*keys).agg(F.min_by(F.struct("junction_start", "junction_end", "junction_strand", "junction_reads"), "ord").alias("__b")).select(*keys, "__b.*")
    return introns.join(best, keys, "left")


def collapsed(samples: DataFrame) -> DataFrame:
    """Junctions over samples (as ``multi_sample`` gives them) in the form of one sample's: reads and unique reads are the totals."""
    return samples.select(*KEY, "strand", F.col("total_reads").alias("reads"), F.col("total_reads").alias("unique_reads"))


def union(*tables: DataFrame) -> DataFrame:
    """All rows of several junction tables one after the other; nothing is summed, ``ord`` tells their order."""
    out = None
    for k, rows in enumerate(tables):
        own = rows.select(*KEY, "strand", "reads", F.struct(F.lit(k).alias("source"), F.monotonically_increasing_id().alias("row")).alias("ord"))
        out = own if out is None else out.unionByName(own)
    return out


def load(alignments: list[DataFrame], files: list[DataFrame], least_samples: int = 1) -> DataFrame:
    """Junctions of alignment samples and of junction files (seqid, start, end, strand, reads each).

    One table of a kind is taken as it is; several are summed over samples, and a
    junction needs a read in ``least_samples`` of them.  Those of the files follow those
    of the alignments without being summed with them.
    """

    def merged(tables: list[DataFrame]) -> DataFrame:
        if len(tables) == 1:
            return tables[0]
        counts = None
        for k, rows in enumerate(tables):
            own = rows.select(*KEY, "strand", "reads", F.lit(k).alias("sample"))
            counts = own if counts is None else counts.unionByName(own)
        return collapsed(multi_sample(counts, 1, least_samples))

    return union(*(merged(tables) for tables in (alignments, files) if tables))

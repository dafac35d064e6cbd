"""Splice refinement: choice of corrected introns and their application to transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dna
from . import junctions as jn

KEY = ["seqid", "gene", "strand", "intron_start", "intron_end"]


def correction_confidence(reads: Column, shift: Column, max_shift: int) -> Column:
    """0.7 of the read support on a log scale and 0.3 of the closeness."""
    return 0.7 * F.least(F.lit(1.0), F.log1p(reads) / F.log(F.lit(101.0))) + 0.3 * F.greatest(F.lit(0.0), 1 - shift / max_shift)


def site_score(window: Column, strand: Column, site: str, slack: int, offset: Column | int = 0) -> Column:
    """Matrix score of the site ``offset`` bases from the current one; 0 beyond the scaffold or without a window."""
    matrix = {"donor": dna.DONOR, "acceptor": dna.ACCEPTOR}[site]
    piece = F.substr(window, (F.lit(1 + slack) + offset).cast("int"), F.lit(len(matrix)))
    return F.coalesce(F.when(~piece.contains("-"), dna.pwm_score(dna.stranded(piece, strand), matrix)), F.lit(0.0))


def nearby_best(introns: DataFrame, junctions: DataFrame, max_shift: int, least_reads: int, slack: int | None = None) -> DataFrame:
    """For each intron the best junction nearby: most reads, least shift, best matrix scores, then the first by place.

    The scores of both sites count if the introns carry windows with ``slack`` more
    bases on both sides that reach all shifts.
    """
    met = jn.nearby(introns, junctions, max_shift, least_reads)
    left, right = F.col("junction_start") - F.col("intron_start"), F.col("junction_end") - F.col("intron_end")
    shift = F.abs(left) + F.abs(right)
    score = F.lit(0.0)
    if slack is not None and slack >= max_shift and "donor_window" in introns.columns:
        score = F.round(site_score(F.col("donor_window"), F.col("strand"), "donor", slack, left) + site_score(F.col("acceptor_window"), F.col("strand"), "acceptor", slack, right), 9)
    rank = F.struct(F.log1p("junction_reads"), -shift, score, -F.col("junction_start"), -F.col("junction_end"))
    best = F.max_by(F.struct(F.col("junction_start").alias("near_start"), F.col("junction_end").alias("near_end"), F.col("junction_reads").alias("near_reads"), shift.alias("near_shift")), rank)
    return met.groupBy(*KEY).agg(best.alias("b")).select(*KEY, "b.*")


def pair_at(window: Column, strand: Column, site: str, slack: int, offset: Column | int = 0) -> Column:
    """The dinucleotide of a site ``offset`` bases from the current one, read on the strand."""
    first = {"donor": 4, "acceptor": 15}[site] + slack
    return F.upper(dna.stranded(F.substr(window, (F.lit(first) + offset).cast("int"), F.lit(2)), strand))


def rescue(window: Column, strand: Column, site: str, reach: int, slack: int | None = None) -> Column:
    """Best canonical site within ``reach`` of the current one: struct<score, offset>, the lowest offset on a tie.

    ``window`` holds the bases of the site's matrix in the order of the scaffold with
    ``slack`` more on both sides; ``-`` stands for bases beyond the scaffold.
    """
    slack = reach if slack is None else slack
    matrix, wanted = {"donor": (dna.DONOR, ("GT", "GC")), "acceptor": (dna.ACCEPTOR, ("AG",))}[site]
    piece = lambda k: dna.stranded(F.replace(F.substr(window, (k + 1 + slack).cast("int"), F.lit(len(matrix))), F.lit("-"), F.lit("")), strand)
    pieces = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: F.struct(piece(k).alias("piece"), pair_at(window, strand, site, slack, k).alias("pair"), (-k).alias("back")))
    best = F.array_max(F.transform(F.filter(pieces, lambda p: p["pair"].isin(*wanted)), lambda p: F.struct(dna.pwm_score(p["piece"], matrix).alias("score"), p["back"].alias("back"))))
    return F.struct(best["score"].alias("score"), (-best["back"]).alias("offset"))


def refine_introns(introns: DataFrame, junctions: DataFrame, max_shift: int = 15, least_reads: int = 3, pwm_threshold: float = 0.0, slack: int | None = None) -> DataFrame:
    """The decision for each intron: exact junction, best one nearby, rescue of a non-canonical site, or keep.

    Introns carry donor and acceptor dinucleotides and, for the rescue,
    donor_window and acceptor_window with ``slack`` bases more on both sides, by
    default min(5, max_shift // 2).  Returns decision, new_start, new_end, support,
    confidence and is_canonical: of the new sites if the slack reaches them, else of the old.
    Of equal junctions the last counts, by the column ``ord`` if there is one.
    """
    reach = min(5, max_shift // 2)
    slack = reach if slack is None else slack
    placed = junctions if "ord" in junctions.columns else junctions.withColumn("ord", F.monotonically_increasing_id())
    found = jn.exact(introns, jn.last_wins(placed, "ord").drop("ord")).withColumnRenamed("junction_reads", "exact_reads")
    found = found.join(nearby_best(introns.select(*KEY, "donor_window", "acceptor_window"), junctions, max_shift, least_reads, slack), KEY, "left")
    found = found.withColumn("donor_site", rescue(F.col("donor_window"), F.col("strand"), "donor", reach, slack)).withColumn("acceptor_site", rescue(F.col("acceptor_window"), F.col("strand"), "acceptor", reach, slack))
    canonical = dna.is_canonical(F.col("donor"), F.col("acceptor"))
    both = (F.col("donor_site.score") > pwm_threshold) & (F.col("acceptor_site.score") > pwm_threshold)
    moved = (F.col("donor_site.offset") != 0) | (F.col("acceptor_site.offset") != 0)
    decision = F.when(F.col("exact_reads").isNotNull(), "exact").when(F.col("near_reads").isNotNull(), "nearby").when(~canonical & F.coalesce(both & moved, F.lit(False)), "rescue").otherwise("keep")
    found = found.withColumn("decision", decision)
    pick = lambda near, site, old: F.when(F.col("decision") == "nearby", F.col(near)).when(F.col("decision") == "rescue", F.col(old) + F.col(f"{site}.offset")).otherwise(F.col(old))
    confidence = F.when(F.col("decision") == "nearby", correction_confidence(F.col("near_reads"), F.col("near_shift"), max_shift)).when(F.col("decision") == "rescue", F.least(F.lit(1.0), (F.col("donor_site.score") + F.col("acceptor_site.score")) / 20))
    found = found.withColumn("new_start", pick("near_start", "donor_site", "intron_start")).withColumn("new_end", pick("near_end", "acceptor_site", "intron_end"))
    moved_to = lambda site, new, old: pair_at(F.col(f"{site}_window"), F.col("strand"), site, slack, F.col(new) - F.col(old))
    after = dna.is_canonical(moved_to("donor", "new_start", "intron_start"), moved_to("acceptor", "new_end", "intron_end")) if slack >= max_shift else canonical
    return found.select(
        *KEY,
        "decision",
        "new_start",
        "new_end",
        F.coalesce("exact_reads", "near_reads", F.lit(0)).alias("support"),
        confidence.alias("confidence"),
        F.when(F.col("decision").isin("nearby", "rescue"), F.coalesce(after, canonical)).otherwise(canonical).alias("is_canonical"),
    )


def report(decisions: DataFrame, least_reads: int = 3) -> DataFrame:
    """Per gene: introns, supported, corrected, canonical, support ratio and flags."""
    changed = (F.col("new_start") != F.col("intron_start")) | (F.col("new_end") != F.col("intron_end"))
    counts = decisions.groupBy("gene").agg(
        F.count("*").alias("n_introns"),
        F.count_if(F.col("support") >= least_reads).alias("n_supported"),
        F.count_if(changed).alias("n_corrected"),
        F.count_if("is_canonical").alias("n_canonical"),
    )
    note = lambda name, n: F.when(n > 0, F.concat(F.lit(f"{name}:"), n.cast("string")))
    marks = F.array(note("noncanonical_introns", F.col("n_introns") - F.col("n_canonical")), note("unsupported_introns", F.col("n_introns") - F.col("n_supported")), note("corrected_introns", F.col("n_corrected")))
    return counts.withColumn("support_ratio", F.when(F.col("n_introns") == 0, 1.0).otherwise(F.col("n_supported") / F.col("n_introns"))).withColumn("flags", F.filter(marks, lambda x: x.isNotNull()))


def apply_corrections(exons: Column, cds: Column, corrections: Column) -> Column:
    """Fold corrections (struct<idx, start, end>, idx of the intron) over a transcript.

    Returns struct<exons, cds>.  The exons beside the intron get its new ends unless
    that would empty them; coding segments at those exons are only trimmed, with ten
    bases of tolerance at the outer end, and kept as they are if trimming empties them.
    """

    def step(state: Column, c: Column) -> Column:
        ordered = F.array_sort(state["exons"])
        before, after = F.get(ordered, c["idx"].cast("int")), F.get(ordered, (c["idx"] + 1).cast("int"))

        def exon(e: Column, k: Column) -> Column:
            end = F.when((k == c["idx"]) & (c["start"] > e["start"]), c["start"]).otherwise(e["end"])
            start = F.when((k == c["idx"] + 1) & (c["end"] < e["end"]), c["end"]).otherwise(e["start"])
            return F.struct(start.alias("start"), end.alias("end"))

        def segment(s: Column) -> Column:
            at_before = (s["start"] >= before["start"]) & (s["start"] < before["end"]) & (s["end"] > before["start"]) & (s["end"] <= before["end"] + 10)
            at_after = (s["start"] >= after["start"] - 10) & (s["start"] < after["end"]) & (s["end"] > after["start"]) & (s["end"] <= after["end"])
            end = F.when(at_before & (s["end"] > c["start"]), c["start"]).otherwise(s["end"])
            start = F.when(at_after & (s["start"] < c["end"]), c["end"]).otherwise(s["start"])
            keep = start < end
            return F.struct(F.when(keep, start).otherwise(s["start"]).alias("start"), F.when(keep, end).otherwise(s["end"]).alias("end"), s["phase"].alias("phase"))

        return F.struct(F.transform(ordered, exon).alias("exons"), F.transform(F.array_sort(state["cds"]), segment).alias("cds"))

    return F.aggregate(corrections, F.struct(F.array_sort(exons).alias("exons"), F.array_sort(cds).alias("cds")), step)


def bounds(exons: Column) -> Column:
    """struct<start, end> over all exons."""
    return F.struct(F.array_min(F.transform(exons, lambda e: e["start"])).alias("start"), F.array_max(F.transform(exons, lambda e: e["end"])).alias("end"))


def valid_parts(parts: Column) -> Column:
    """Exons or coding segments that aren't empty."""
    return F.filter(parts, lambda e: e["start"] < e["end"])

"""Report tables with the columns and number formats in which they are exchanged, and short text summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import qc


def fixed(column: str, places: int) -> Column:
    """A number with so many decimals; blank if it is null."""
    return F.coalesce(F.format_string(f"%.{places}f", F.col(column).cast("double")), F.lit("")).alias(column)


def yes(column: str) -> Column:
    return F.when(F.col(column), "yes").otherwise("no").alias(column)


def joined(column: str, mark: str = ",") -> Column:
    return F.coalesce(F.array_join(column, mark), F.lit("")).alias(column)


def confidence_report(scores: DataFrame, genes: DataFrame) -> DataFrame:
    """gene_id, place, metrics, class, flags, number of low regions and exons of each scored gene."""
    spans = genes.select("gene_id", "seqid", "start", "end", "strand")
    metrics = ["mean_prob", "min_prob", "median_prob", "mean_entropy", "boundary_sharpness", "coding_consistency", "worst_exon_score", "overall_score"]
    named = [F.col(c).alias("entropy" if c == "mean_entropy" else c) for c in metrics]
    return spans.join(scores, "gene_id").select("gene_id", "seqid", "start", "end", "strand", *named, "confidence_class", joined("flags"), F.col("n_low_regions").alias("n_low_conf_regions"), "n_exons")


def splice_report(reports: DataFrame) -> DataFrame:
    """Gene rows of the splice report."""
    return reports.select("gene_id", "n_introns", "n_supported", "n_corrected", "n_canonical", (F.col("n_introns") - F.col("n_canonical")).alias("n_noncanonical"), fixed("support_ratio", 4), (F.col("n_supported") == F.col("n_introns")).alias("fully_supported"), joined("flags"))


def corrections_report(corrections: DataFrame) -> DataFrame:
    """A row a correction, with the number of its intron in the transcript (from 0)."""
    return corrections.select("gene_id", "transcript_id", "intron_index", "site", "original_position", "corrected_position", "shift", "reason", fixed("confidence", 4), "rnaseq_reads")


def with_intron_index(rows: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Add intron_index: exons of the transcript that end before the intron, less one."""
    ends = transcripts.select("transcript_id", F.transform(F.array_sort("exons"), lambda e: e["end"]).alias("__ends"))
    return rows.join(ends, "transcript_id").withColumn("intron_index", F.array_position("__ends", F.col("intron_start")) - 1).drop("__ends")


def unsupported_bed(decisions: DataFrame, transcripts: DataFrame, least_reads: int = 3) -> DataFrame:
    """BED6 lines of introns with fewer reads than ``least_reads``, named by gene and number."""
    rows = with_intron_index(decisions.filter(F.col("support") < least_reads), transcripts)
    name = F.concat("gene_id", F.lit("_intron"), F.col("intron_index").cast("string"))
    return rows.select(F.concat_ws("\t", "seqid", F.col("intron_start").cast("string"), F.col("intron_end").cast("string"), name, F.lit("0"), "strand").alias("line"))


def evidence_report(scores: DataFrame) -> DataFrame:
    """The full evidence report; ``evidence_table`` reads it back."""
    return scores.select("gene_id", "transcript_id", "seqid", "strand", "n_introns", "n_introns_supported", "n_introns_exact", fixed("junction_support_ratio", 4), "n_exons", "n_exons_expressed", fixed("mean_exon_coverage", 2), fixed("exon_coverage_ratio", 4), yes("start_supported"), yes("stop_supported"), F.lit("yes").alias("strand_consistent"), "evidence_level", fixed("aed", 4), joined("flags"))


def evidence_brief(scores: DataFrame) -> DataFrame:
    """The short form for quality control."""
    return scores.select("gene_id", "evidence_level", fixed("aed", 4), fixed("junction_support_ratio", 4), fixed("exon_coverage_ratio", 4), F.size("flags").alias("n_flags"), joined("flags"))


def junction_details(matched: DataFrame) -> DataFrame:
    """A row an intron with its matched junction (junction_start, junction_end, junction_reads; null without one)."""
    seen, c = F.col("junction_start").isNotNull(), F.col
    shift = lambda a, b: F.coalesce(c(a) - c(b), F.lit(0))
    donor, acceptor = shift("junction_start", "intron_start"), shift("junction_end", "intron_end")
    return matched.select("gene_id", "transcript_id", "intron_start", "intron_end", (c("intron_end") - c("intron_start")).alias("intron_length"), F.when(seen, "yes").otherwise("no").alias("observed"), F.coalesce("junction_reads", F.lit(0)).alias("read_count"), F.when(seen & (donor == 0) & (acceptor == 0), "yes").otherwise("no").alias("exact_match"), donor.alias("shift_donor"), acceptor.alias("shift_acceptor"))


def exon_details(depths: DataFrame, least: float = 5) -> DataFrame:
    """A row an exon with its depth statistics and whether its median reaches ``least``."""
    return depths.select("gene_id", "transcript_id", F.col("start").alias("exon_start"), F.col("end").alias("exon_end"), (F.col("end") - F.col("start")).alias("exon_length"), fixed("mean_depth", 2), fixed("median_depth", 2), "min_depth", "max_depth", F.when(F.col("median_depth") >= least, "yes").otherwise("no").alias("is_expressed"))


def refine_report(genes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Rows of refined genes; n_exons is that of the gene's first transcript."""
    first = transcripts.groupBy("gene_id").agg(F.min_by(F.size("exons"), "line_no").alias("n_exons"))
    support = F.when(F.col("n_introns") > 0, F.concat_ws("/", F.col("n_introns_supported").cast("string"), F.col("n_introns").cast("string"))).otherwise("")
    zero = lambda c, n: F.when(F.col(c) != 0, F.format_string(f"%.{n}f", F.col(c))).otherwise("").alias(c)  # noqa: E731  a zero is written blank, as established
    return genes.join(first, "gene_id", "left").select("gene_id", "seqid", "start", "end", "strand", F.coalesce("n_exons", F.lit(0)).alias("n_exons"), zero("confidence_score", 4), zero("evidence_score", 4), zero("aed", 4), support.alias("junction_support"), zero("mean_coverage", 1), "splice_corrections", F.when(F.col("boundary_adjusted"), "yes").otherwise("no").alias("boundary_adjusted"), joined("flags"))


def refine_summary(genes: DataFrame) -> DataFrame:
    """One row over refined genes: means of the scores, corrected, supported and adjusted genes."""
    multi = F.col("n_introns") > 0
    return genes.agg(
        F.count("*").alias("total_genes"),
        F.avg("confidence_score").alias("mean_confidence"),
        F.avg("evidence_score").alias("mean_evidence_score"),
        F.avg("aed").alias("mean_aed"),
        F.count_if(F.col("splice_corrections") > 0).alias("genes_splice_corrected"),
        F.coalesce(F.sum("splice_corrections"), F.lit(0)).alias("total_splice_corrections"),
        F.count_if(multi).alias("multi_exon_genes"),
        F.count_if(multi & (F.col("n_introns") == F.col("n_introns_supported"))).alias("full_junction_support"),
        F.count_if("boundary_adjusted").alias("boundary_adjusted"),
    )


def validation_report(results: DataFrame) -> DataFrame:
    """Rows of a homology validation; zeros of coverages, identity and e-value are written blank, as established."""
    part = lambda c, f: F.when(F.col(c) != 0, F.format_string(f, F.col(c))).otherwise("").alias(c)
    return results.select("gene_id", "status", F.coalesce(F.col("subject_id").cast("string"), F.lit("")).alias("best_hit_id"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"), part("query_coverage", "%.3f"), part("subject_coverage", "%.3f"), part("identity", "%.1f"), part("evalue", "%.2e"), F.when(F.col("chimera_subjects").isNotNull(), "yes").otherwise("no").alias("is_chimeric"), F.coalesce(F.col("fragment_group").cast("string"), F.lit("")).alias("fragment_group"), F.format_string("%.3f", F.coalesce("te_overlap", F.lit(0.0))).alias("te_overlap_fraction"), joined("flags", ";"))


def chimera_report(pairs: DataFrame, key: str = "query_id") -> DataFrame:
    """Pairs of subjects of chimeric genes."""
    return pairs.select(F.col(key).alias("gene_id"), "subject_a", "subject_b", "gap", "overlap", fixed("confidence", 3))


def fragment_report(results: DataFrame) -> DataFrame:
    """fragment_group, its genes and their number; the genes of a group are counted before they are listed."""
    return results.filter("fragment_group IS NOT NULL").groupBy("fragment_group").agg(F.array_join(F.array_sort(F.collect_list("gene_id")), ",").alias("gene_ids"), F.count("*").alias("n_fragments"))


def qc_report(genes: DataFrame) -> DataFrame:
    """Rows of the aggregated quality table; ``interchange.qc_table`` reads them back."""
    scores = [fixed(c, 4) for c in ("confidence_score", "splice_score", "homology_score", "rnaseq_aed", "combined_aed")]
    return genes.select("gene_id", "tier", F.size("flags").alias("flag_count"), F.array_join("flags", ",").alias("flag_codes"), F.coalesce(qc.max_severity(F.col("flags")), F.lit("")).alias("max_severity"), *scores)


def evidence_text(scores: DataFrame) -> str:
    """A summary for people, from one row of counts."""
    single = F.col("n_introns") == 0
    levels = [F.count_if(F.col("evidence_level") == k).alias(k) for k in ("full", "partial", "minimal", "none")]
    r = scores.agg(F.count("*").alias("n"), *levels, F.avg("aed").alias("mean"), F.median("aed").alias("median"), F.count_if(single).alias("single"), F.count_if(~single & (F.col("n_introns_supported") == F.col("n_introns"))).alias("supported")).first()
    if not r.n:
        return "No genes to summarize."
    share = lambda k, of: f"{k:,} ({100 * k / of:.1f}%)" if of else f"{k:,}"
    lines = [f"Genes: {r.n:,}", *(f"Evidence {k}: {share(r[k], r.n)}" for k in ("full", "partial", "minimal", "none")), f"Mean distance: {r['mean']:.4f}", f"Median distance: {r['median']:.4f}", f"Single-exon genes: {share(r.single, r.n)}", f"Multi-exon genes: {share(r.n - r.single, r.n)}", f"All junctions supported: {share(r.supported, r.n - r.single)}"]
    return "\n".join(lines)


def refine_text(genes: DataFrame) -> str:
    """A summary of a refine run for people."""
    r = refine_summary(genes).first()
    means = [(n, r[c]) for n, c in (("Mean confidence", "mean_confidence"), ("Mean evidence score", "mean_evidence_score"), ("Mean distance", "mean_aed"))]
    lines = [f"Genes: {r.total_genes:,}", *(f"{n}: {v:.4f}" for n, v in means if v), f"Genes with corrected splices: {r.genes_splice_corrected:,}", f"Corrections: {r.total_splice_corrections:,}", f"All junctions supported: {r.full_junction_support:,} of {r.multi_exon_genes:,} multi-exon genes", f"Boundaries adjusted: {r.boundary_adjusted:,} genes"]
    return "\n".join(lines)

"""Whole runs over gene tables: confidence, evidence, splice, refine, homology, quality control.

``genes`` has gene_id, line_no, seqid, start, end, strand, attributes and
``transcripts`` line_no, transcript_id, gene_id, seqid, start, end, strand, exons, cds,
as ``readers.gene_models`` gives them.  Every run joins by id, so a step that can say
nothing about a gene leaves nulls and one gene never stops a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import dna
from .operators import boundaries, depth, evidence, homology, intervals, junctions, predictions, qc, refine, splice
from .operators import confidence as scoring
from .operators.planning import first_by_priority
from .sources import readers
from .storage import kept


def exon_rows(transcripts: DataFrame) -> DataFrame:
    """A row an exon: gene_id, transcript_id, seqid, strand, k (from 0, by place), start, end."""
    listed = transcripts.select("gene_id", "transcript_id", "seqid", "strand", F.posexplode(F.array_sort("exons")).alias("k", "e"))
    return listed.select("gene_id", "transcript_id", "seqid", "strand", "k", "e.start", "e.end")


def confidence(genes: DataFrame, transcripts: DataFrame, chunks: DataFrame, data: DataFrame, stranded: bool = True) -> DataFrame:
    """Confidence of each gene on its first transcript.

    ``chunks`` has chunk_id, seqid, start and end (start > end on the reverse strand),
    ``data`` chunk_id and probs.  Without ``stranded`` all genes read forward chunks.
    A gene without probabilities gets the fallback record.
    """
    strand = F.col("strand") if stranded else F.lit("+")
    regions = genes.select(F.col("gene_id").alias("region_id"), "seqid", strand.alias("strand"), F.col("start").alias("region_start"), F.col("end").alias("region_end"))
    slices = predictions.chunk_slices(regions, predictions.chunk_index(chunks))
    probs = predictions.region_probabilities(slices, data).withColumnRenamed("region_id", "gene_id")
    first = first_by_priority(transcripts.select("gene_id", "line_no", "exons", "cds"), "gene_id", [F.col("line_no")]).select("gene_id", "exons", "cds")
    rows = genes.select("gene_id", "start", "end").join(first, "gene_id", "left").join(probs, "gene_id", "left")
    inside = lambda parts: F.transform(parts, lambda e: F.struct((e["start"] - F.col("start")).alias("start"), (e["end"] - F.col("start")).alias("end")))
    return scoring.score_genes(rows.select("gene_id", (F.col("end") - F.col("start")).alias("length"), "probs", inside("exons").alias("exons"), inside("cds").alias("cds")))


def exon_depth(exons: DataFrame, blocks: DataFrame, keys: list[str], stranded: bool = True, size: int = 1 << 12) -> DataFrame:
    """Depth of each exon (keys, seqid, strand, start, end) under aligned blocks: mean, median, least and largest.

    ``size`` is the bin in which exons meet blocks, many exons long.
    """
    return depth.exon_depth(exons, blocks, keys, ["seqid", "strand"] if stranded else ["seqid"], size)


def score_evidence(genes: DataFrame, transcripts: DataFrame, found: DataFrame, blocks: DataFrame | None = None, least_reads: int = 3, least_depth: float = 5, tolerance: int = 10, stranded: bool = True) -> DataFrame:
    """Evidence of each gene on its primary transcript, from junctions and, if given, aligned blocks.

    Of equal junctions the last counts.  Without blocks exons count as not covered and
    their flags are left out; a gene without transcripts gets level none and distance 1.
    """
    primary = readers.primary_transcript(transcripts).select("gene_id", "transcript_id", "seqid", "strand", "exons")
    exons = exon_rows(primary)
    gaps = intervals.introns(exons.drop("k"), ["gene_id"]).select("gene_id", "seqid", "intron_start", "intron_end")
    placed = found if "ord" in found.columns else found.withColumn("ord", F.monotonically_increasing_id())
    support = junctions.support(gaps, placed, tolerance, ["gene_id"], least_reads, "ord")
    rows = genes.select("gene_id", "seqid", "strand").join(primary.select("gene_id", "transcript_id"), "gene_id", "left").join(support, "gene_id", "left").na.fill(0, ["n_introns", "n_introns_supported", "n_introns_exact"])
    if blocks is None:
        rows = rows.withColumns({"n_exons": F.lit(0).cast("long"), "n_exons_expressed": F.lit(0).cast("long"), "mean_exon_coverage": F.lit(0.0), "low_ok": F.lit(False), "high_ok": F.lit(False)})
    else:
        depths = exon_depth(exons, blocks, ["gene_id", "k"], stranded)
        ends = depths.groupBy("gene_id").agg(F.count("*").alias("n_exons"), F.count_if(F.col("median_depth") >= least_depth).alias("n_exons_expressed"), F.avg("mean_depth").alias("mean_exon_coverage"), (F.min_by("min_depth", "k") >= least_depth).alias("low_ok"), (F.max_by("min_depth", "k") >= least_depth).alias("high_ok"))
        rows = rows.join(ends, "gene_id", "left").na.fill(0, ["n_exons", "n_exons_expressed", "mean_exon_coverage"]).na.fill(False, ["low_ok", "high_ok"])
    c = F.col
    share = lambda n, of, empty: F.when(c(of) > 0, c(n) / c(of)).otherwise(F.lit(empty))
    rows = rows.withColumn("junction_support_ratio", share("n_introns_supported", "n_introns", 1.0)).withColumn("exon_coverage_ratio", share("n_exons_expressed", "n_exons", 0.0))
    minus = c("strand") == "-"
    rows = rows.withColumn("start_supported", F.when(minus, c("high_ok")).otherwise(c("low_ok"))).withColumn("stop_supported", F.when(minus, c("low_ok")).otherwise(c("high_ok"))).drop("low_ok", "high_ok")
    boundary = (c("start_supported").cast("int") + c("stop_supported").cast("int")) / 2.0
    seen = lambda name: F.when(c("n_exons") > 0, c(name))
    marks = evidence.flags(c("n_introns"), c("junction_support_ratio"), seen("n_exons_expressed"), seen("exon_coverage_ratio"), c("start_supported"), c("stop_supported"))
    there = c("transcript_id").isNotNull()
    return rows.withColumns({
        "aed": F.when(there, evidence.edit_distance(c("junction_support_ratio"), c("exon_coverage_ratio"), boundary)).otherwise(1.0),
        "evidence_level": F.when(there, evidence.level(c("n_introns"), c("junction_support_ratio"), c("exon_coverage_ratio"))).otherwise("none"),
        "flags": F.when(there, marks).otherwise(F.array(F.lit("NO_TRANSCRIPTS"))),
    })


def windows(spans: DataFrame, blocks: DataFrame, keys: list[str], size: int = 1 << 20) -> DataFrame:
    """Upper-case sequence of spans (keys, seqid, start, end); ``-`` stands for bases beyond the scaffold."""
    low = F.greatest(F.col("start"), F.lit(0))
    inner = spans.withColumn("__low", F.col("start")).withColumn("__high", F.col("end")).withColumn("start", low).filter("end > start")
    seq = readers.subsequences(inner, blocks, [*keys, "__low", "__high"], size)
    left = F.repeat(F.lit("-"), F.greatest(F.lit(0), -F.col("__low")).cast("int"))
    return seq.select(*keys, F.rpad(F.concat(left, F.upper("seq")), (F.col("__high") - F.col("__low")).cast("int"), "-").alias("seq"))


def intron_sites(introns: DataFrame, blocks: DataFrame, slack: int, size: int = 1 << 20) -> DataFrame:
    """Introns with donor, acceptor, donor_window and acceptor_window, from one join with the genome."""
    around = {"donor": (F.col("intron_start") - 3 - slack, F.col("intron_start") + 6 + slack), "acceptor": (F.col("intron_end") - 16 - slack, F.col("intron_end") + slack)}
    spans = F.explode(F.array(*(F.struct(F.lit(site).alias("site"), a.alias("start"), b.alias("end")) for site, (a, b) in around.items())))
    found = windows(introns.select(*splice.KEY, spans.alias("w")).select(*splice.KEY, "w.*"), blocks, [*splice.KEY, "site"], size)
    pick = lambda site: F.max(F.when(F.col("site") == site, F.col("seq"))).alias(f"{site}_window")
    rows = introns.join(found.groupBy(*splice.KEY).agg(pick("donor"), pick("acceptor")), splice.KEY, "left")
    pair = lambda site: F.coalesce(splice.pair_at(F.col(f"{site}_window"), F.col("strand"), site, slack), F.lit("NN"))
    return rows.withColumn("donor", pair("donor")).withColumn("acceptor", pair("acceptor"))


def refine_splices(transcripts: DataFrame, blocks: DataFrame, found: DataFrame, max_shift: int = 15, least_reads: int = 3, pwm_threshold: float = 0.0, size: int = 1 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corrected transcripts, a report for each gene with introns, and the decision for each intron of a transcript.

    An intron that several transcripts of a gene share is decided once; the decisions
    are kept as a checkpoint, as all three results read them.
    """
    named = exon_rows(transcripts).withColumnRenamed("gene_id", "gene")
    gaps = intervals.introns(named.drop("k"), ["transcript_id"]).select("transcript_id", *splice.KEY)
    sites = intron_sites(gaps.select(*splice.KEY).distinct(), blocks, max_shift, size)
    decided = kept(splice.refine_introns(sites, found, max_shift, least_reads, pwm_threshold, max_shift))
    each = gaps.join(decided, splice.KEY)
    changed = refine.refine_transcripts(transcripts.withColumnRenamed("gene_id", "gene"), decided).withColumnRenamed("gene", "gene_id")
    return changed, splice.report(each, least_reads).withColumnRenamed("gene", "gene_id"), each.withColumnRenamed("gene", "gene_id")


def corrections(decisions: DataFrame, max_shift: int = 15) -> DataFrame:
    """A row for each moved site of a nearby junction, and one for each rescued intron."""
    c = F.col
    row = lambda site, old, new, shift, reason, sure: F.struct(site.alias("site"), old.alias("original_position"), new.alias("corrected_position"), shift.alias("shift"), F.lit(reason).alias("reason"), sure.alias("confidence"))
    left, right = c("new_start") - c("intron_start"), c("new_end") - c("intron_end")
    near = lambda site, old, new, shift: F.when((c("decision") == "nearby") & (shift != 0), row(F.lit(site), c(old), c(new), shift, "rnaseq_junction", splice.correction_confidence(c("support"), F.abs(shift), max_shift)))
    of = lambda a, b: F.when(left != 0, a).otherwise(b)
    rescued = F.when(c("decision") == "rescue", row(F.when(F.abs(left) >= F.abs(right), "donor").otherwise("acceptor"), of(c("intron_start"), c("intron_end")), of(c("new_start"), c("new_end")), of(left, right), "canonical_rescue", c("confidence")))
    rows = F.filter(F.array(near("donor", "intron_start", "new_start", left), near("acceptor", "intron_end", "new_end", right), rescued), lambda r: r.isNotNull())
    return decisions.select("gene_id", "transcript_id", "intron_start", "intron_end", F.col("support").alias("rnaseq_reads"), F.explode(rows).alias("r")).select("gene_id", "transcript_id", "intron_start", "intron_end", "r.*", "rnaseq_reads")


def adjust_boundaries(transcripts: DataFrame, blocks: DataFrame, window: int = 30, corrected: bool = False, size: int = 1 << 20) -> DataFrame:
    """Transcripts with moved starts and stops, and ``adjusted``: whether either got another place.

    A start window that passes the scaffold's end has no candidates.  Transcripts
    without coding segments stay as they are.
    """
    c, minus = F.col, F.col("strand") == "-"
    ordered = transcripts.withColumn("cds", F.array_sort("cds")).withColumn("exons", F.array_sort("exons"))
    low, high = F.get("cds", F.lit(0))["start"], F.get("cds", F.size("cds") - 1)["end"]
    placed = ordered.withColumn("__first", F.when(F.size("cds") > 0, F.when(minus, high).otherwise(low))).withColumn("__last", F.when(F.size("cds") > 0, F.when(minus, low).otherwise(high)))
    a, b = boundaries.start_span(c("strand"), c("__first"), window)
    after = F.when(minus, c("__last") - window).otherwise(c("__last")), F.when(minus, c("__last")).otherwise(c("__last") + window)
    spans = F.explode(F.array(F.struct(F.lit("start").alias("kind"), a.alias("start"), b.alias("end")), F.struct(F.lit("stop").alias("kind"), after[0].alias("start"), after[1].alias("end"))))
    wanted = placed.filter("__first IS NOT NULL").select("transcript_id", "seqid", "strand", spans.alias("w")).select("transcript_id", "seqid", "strand", "w.*")
    found = windows(wanted, blocks, ["transcript_id", "strand", "kind"], size).withColumn("seq", dna.stranded(F.col("seq"), c("strand")))
    pick = lambda kind: F.max(F.when(c("kind") == kind, c("seq")))
    pieces = found.groupBy("transcript_id").agg(pick("start").alias("__head"), F.replace(pick("stop"), F.lit("-"), F.lit("")).alias("__tail"))
    rows = placed.join(pieces, "transcript_id", "left").withColumn("__a", a).withColumn("__b", b)
    best = F.when(~c("__head").contains("-"), boundaries.start_in(c("__head"), c("__a"), c("__b"), c("strand"), c("__first"), window))
    rows = rows.withColumn("__shift", F.coalesce(best["position"] - c("__first"), F.lit(0)))
    rows = rows.withColumn("__s", boundaries.shift_start(c("cds"), c("exons"), c("strand"), c("__shift"), corrected))
    moved = lambda kept: F.when(c("__shift") != 0, c(f"__s.{kept}")).otherwise(c(kept))
    rows = rows.withColumn("__c", moved("cds")).withColumn("exons", moved("exons")).withColumn("cds", c("__c")).drop("__c")
    phase = F.when(minus, F.get("cds", F.size("cds") - 1)["phase"]).otherwise(F.get("cds", F.lit(0))["phase"])
    place = boundaries.stop_place(c("__tail"), c("strand"), c("__last"), boundaries.frame_of(F.coalesce(phase, F.lit(0))))
    rows = rows.withColumn("__move", F.coalesce(place - c("__last"), F.lit(0)))
    rows = rows.withColumn("__s", boundaries.shift_stop(c("cds"), c("exons"), c("strand"), c("__move"), corrected))
    moved = lambda kept: F.when(c("__move") != 0, c(f"__s.{kept}")).otherwise(c(kept))
    rows = rows.withColumn("__c", moved("cds")).withColumn("exons", moved("exons")).withColumn("cds", c("__c"))
    rows = rows.withColumn("adjusted", (c("__shift") != 0) | (c("__move") != 0))
    return rows.select(*transcripts.columns, "adjusted")


def refine_boundaries(transcripts: DataFrame, blocks: DataFrame, distance: int = 300, size: int = 1 << 20) -> DataFrame:
    """Boundaries over a wide scan: transcripts with moved ends, ``adjusted`` and the list of ``changes``.

    Untranslated ends aren't extended, as established.
    """
    old = transcripts.select("transcript_id", F.col("cds").alias("__old"))
    moved = adjust_boundaries(transcripts, blocks, distance, size=size)
    return moved.join(old, "transcript_id").withColumn("changes", boundaries.changes(F.col("__old"), F.col("cds"))).drop("__old")


def phase_check(transcripts: DataFrame, blocks: DataFrame, size: int = 1 << 20) -> DataFrame:
    """transcript_id and its phase errors; transcripts without coding segments are left out."""
    c, minus = F.col, F.col("strand") == "-"
    coded = transcripts.filter(F.size("cds") > 0).withColumn("cds", F.array_sort("cds"))
    low, high = c("cds")[0]["start"], F.element_at("cds", -1)["end"]
    first = F.struct(F.lit("start").alias("kind"), F.when(minus, high - 3).otherwise(low).alias("start"), F.when(minus, high).otherwise(low + 3).alias("end"))
    after = F.struct(F.lit("stop").alias("kind"), F.when(minus, low - 3).otherwise(high).alias("start"), F.when(minus, low).otherwise(high + 3).alias("end"))
    spans = coded.select("transcript_id", "seqid", "strand", F.explode(F.array(first, after)).alias("w")).select("transcript_id", "seqid", "strand", "w.*")
    found = windows(spans, blocks, ["transcript_id", "strand", "kind"], size).withColumn("seq", dna.stranded(c("seq"), c("strand")))
    pick = lambda kind: F.max(F.when(c("kind") == kind, c("seq"))).alias(kind)
    codons = found.groupBy("transcript_id").agg(pick("start").alias("__start"), pick("stop").alias("__stop"))
    return coded.join(codons, "transcript_id", "left").select("transcript_id", boundaries.phase_errors(c("cds"), c("strand"), c("__start"), c("__stop")).alias("e")).select("transcript_id", "e.*")


def with_bounds(genes: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Genes with start and end over all exons of their transcripts."""
    spans = transcripts.select("gene_id", splice.bounds(F.col("exons")).alias("b")).groupBy("gene_id").agg(F.min("b.start").alias("__s"), F.max("b.end").alias("__e"))
    return genes.join(spans, "gene_id", "left").withColumn("start", F.coalesce("__s", "start")).withColumn("end", F.coalesce("__e", "end")).drop("__s", "__e")


def refine_genes(genes: DataFrame, transcripts: DataFrame, genome: DataFrame, found: DataFrame, chunks: DataFrame, data: DataFrame, aligned: DataFrame | None = None, config: refine.Config = refine.Config(), stranded: bool = True) -> tuple[DataFrame, DataFrame]:
    """The refine run: splices, boundaries, confidence, evidence, flags, attributes.

    ``genome`` has seqid, block_start, seq.  Returns refined genes with their scores and
    flags, and refined transcripts.
    """
    c = F.col
    changed, reports, _ = refine_splices(transcripts, genome, found, config.max_shift, config.min_junction_reads)
    changed = kept(adjust_boundaries(changed, genome, config.search_window))
    moved = changed.groupBy("gene_id").agg(F.bool_or("adjusted").alias("boundary_adjusted"))
    changed = refine.validated(changed.drop("adjusted"))
    bounded = kept(with_bounds(genes, changed))
    scores = confidence(bounded, changed, chunks, data, stranded)
    scores = scores.select("gene_id", "overall_score", "worst_exon_score", "confidence_class", F.col("flags").alias("confidence_flags")).filter(~F.array_contains("confidence_flags", "scoring_error"))
    proof = score_evidence(bounded, changed, found, aligned, config.min_junction_reads)
    proof = proof.select("gene_id", "n_introns", "n_introns_supported", "mean_exon_coverage", "evidence_level", "aed", (1 - c("aed")).alias("evidence_score"), F.col("flags").alias("evidence_flags"))
    spliced = reports.select("gene_id", F.col("n_introns").alias("__introns"), F.col("n_supported").alias("__supported"), F.col("n_corrected").alias("splice_corrections"), (c("n_introns") - c("n_canonical")).alias("n_noncanonical"))
    rows = bounded.join(scores, "gene_id", "left").join(proof, "gene_id", "left").join(spliced, "gene_id", "left").join(moved, "gene_id", "left").na.fill(0, ["__introns", "__supported", "splice_corrections", "n_noncanonical"]).na.fill(False, ["boundary_adjusted"])
    rows = rows.withColumn("flags", refine.flags(c("overall_score"), c("worst_exon_score"), c("confidence_flags"), c("evidence_flags"), c("splice_corrections"), c("n_noncanonical"), c("__introns"), c("__supported"), c("boundary_adjusted"), config))
    rows = refine.with_attributes(rows, {"confidence_score": "overall_score", "evidence_score": "evidence_score", "aed": "aed"})
    more = F.array(
        F.when(c("n_introns") > 0, F.struct(F.lit("junction_support").alias("key"), F.concat_ws("/", c("n_introns_supported").cast("string"), c("n_introns").cast("string")).alias("value"))),
        F.when(c("mean_exon_coverage").isNotNull(), F.struct(F.lit("mean_coverage").alias("key"), F.format_string("%.1f", "mean_exon_coverage").alias("value"))),
        F.when(F.size("flags") > 0, F.struct(F.lit("flags").alias("key"), F.array_join("flags", ",").alias("value"))),
    )
    added = F.map_from_entries(F.filter(more, lambda e: e.isNotNull()))
    rows = rows.withColumn("attributes", F.map_concat(F.map_filter("attributes", lambda k, v: ~F.map_contains_key(added, k)), added))
    return rows.drop("__introns", "__supported", "confidence_flags", "evidence_flags"), changed


def te_overlap(genes: DataFrame, te: DataFrame) -> DataFrame:
    """gene_id and the share of it under transposable elements; overlapping elements count each, up to 1."""
    spans = te.select("seqid", F.col("start").alias("te_start"), F.col("end").alias("te_end"))
    met = intervals.overlap_join(genes.select("gene_id", "seqid", "start", "end"), spans, ["seqid"], ("start", "end"), ("te_start", "te_end"))
    bases = F.sum(intervals.overlap_length(F.col("start"), F.col("end"), F.col("te_start"), F.col("te_end")))
    return met.groupBy("gene_id").agg(F.least(F.lit(1.0), F.try_divide(bases, F.max(F.col("end") - F.col("start")))).alias("te_overlap"))


def validate(genes: DataFrame, hits: DataFrame, te: DataFrame | None = None, limits: homology.Thresholds = homology.DEFAULT, least_te: float = homology.TE_FRACTION, all_genes: bool = True) -> DataFrame:
    """Homology status of genes by their hits (query_id is the gene).

    Fragmented stands over te_overlap over chimeric over the base status.  A gene in
    several fragment groups belongs to that of the subject that appears last.  Genes
    without any hit are no_hit and never tested for elements.
    """
    c, found = F.col, homology.significant(hits, limits)
    best = homology.best_hits(found, ["query_id"])
    share = lambda kind: F.coalesce(homology.coverage(c(f"{kind}_start"), c(f"{kind}_end"), c(f"{kind}_length")), F.lit(0.0))
    best = best.select(F.col("query_id").alias("gene_id"), "n_hits", "subject_id", "identity", "evalue", share("query").alias("query_coverage"), share("subject").alias("subject_coverage"))
    mixed = homology.chimeras(found).select(F.col("query_id").alias("gene_id"), F.concat_ws(",", "subject_a", "subject_b").alias("chimera_subjects"))
    order = found.groupBy("subject_id").agg(F.min("ord").alias("__first"))
    groups = homology.fragment_groups(found).select("subject_id").join(order, "subject_id")
    parts = homology.fragments(found).join(groups, "subject_id").groupBy(F.col("query_id").alias("gene_id")).agg(F.max_by("subject_id", "__first").alias("fragment_group"))
    rows = hits.select(F.col("query_id").alias("gene_id")).distinct().join(best, "gene_id", "left").join(mixed, "gene_id", "left").join(parts, "gene_id", "left")
    rows = rows.join(te_overlap(genes, te), "gene_id", "left") if te is not None else rows.withColumn("te_overlap", F.lit(None).cast("double"))
    rows = rows.withColumn("n_hits", F.coalesce("n_hits", F.lit(0))).withColumn("te_overlap", F.coalesce("te_overlap", F.lit(0.0)))
    base = F.when(c("n_hits") == 0, "no_hit").otherwise(homology.status(c("query_coverage"), c("subject_coverage"), limits))
    chimeric, covered, split = c("chimera_subjects").isNotNull(), c("te_overlap") >= least_te, c("fragment_group").isNotNull()
    marks = qc.listed(
        F.when(c("n_hits") == 0, "no_homology"),
        F.when(chimeric, "chimeric"),
        F.when(c("query_coverage") < limits.query_coverage, "low_query_coverage"),
        F.when(c("subject_coverage") < limits.subject_coverage, "low_subject_coverage"),
        F.when(covered, "te_overlap"),
        F.when(split, "fragmented"),
    )
    rows = rows.withColumn("flags", marks).withColumn("status", homology.precedence(base, chimeric, covered, split))
    return homology.with_missing(genes, rows, "gene_id") if all_genes else rows


#: Columns that the sources of ``quality`` may have.
SOURCES = {
    "confidence": {"overall_score": "double", "exon_min": "double", "entropy": "double", "boundary_sharpness": "double", "flags": "array<string>"},
    "splice": {"n_introns": "long", "n_canonical": "long", "n_supported": "long", "n_corrected": "long", "shortest_intron": "long", "junction_support": "string", "evidence_score": "double", "aed": "double", "flags": "array<string>"},
    "homology": {"status": "string", "query_coverage": "double", "identity": "double", "chimeric": "boolean", "fragmented": "boolean", "te_overlap": "double", "flags": "array<string>"},
}


def _shaped(df: DataFrame, name: str) -> DataFrame:
    """gene_id and the known columns of a source, named by it; those it lacks as null, listed flags as an array."""
    types = dict(df.dtypes)

    def column(c: str, kind: str) -> Column:
        if c not in types:
            return F.lit(None).cast(kind)
        return F.split(c, r"\s*,\s*") if c == "flags" and types[c] == "string" else F.col(c).cast(kind)

    return df.select("gene_id", *(column(c, kind).alias(f"{name}_{c}") for c, kind in SOURCES[name].items()))


def quality(scores: DataFrame | None = None, splices: DataFrame | None = None, hits: DataFrame | None = None, genes: DataFrame | None = None) -> DataFrame:
    """Scores, registered flags, tier and distance of genes from any of the three sources.

    One row for each gene of any source, or of ``genes``; the sources have a row a gene
    and any of the columns in ``SOURCES``.
    """
    given = {"confidence": scores, "splice": splices, "homology": hits}
    some = next(df for df in (*given.values(), genes) if df is not None)
    blank = some.select("gene_id").limit(0)
    rows = qc.combine(*(_shaped(blank if df is None else df, name) for name, df in given.items()), "gene_id", genes)
    c, zero = F.col, lambda name: F.coalesce(name, F.lit(0))
    parts = F.split("splice_junction_support", "/")
    ratio = F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))
    counted = qc.splice_score(zero("splice_n_canonical"), c("splice_n_introns"), zero("splice_n_supported"))
    by_text = F.when(c("splice_junction_support").isNotNull(), ratio).otherwise(c("splice_evidence_score"))
    rows = rows.withColumn("confidence_score", c("confidence_overall_score")).withColumn("splice_score", F.when(zero("splice_n_introns") > 0, counted).otherwise(by_text))
    rows = rows.withColumn("homology_score", qc.homology_score(c("homology_query_coverage"), c("homology_identity"), F.lower("homology_status"))).withColumn("rnaseq_aed", c("splice_aed"))
    none = F.array().cast("array<string>")
    marks = F.concat(
        qc.confidence_flags(c("confidence_score"), c("confidence_exon_min"), c("confidence_entropy"), c("confidence_boundary_sharpness")),
        F.coalesce("confidence_flags", none),
        qc.splice_flags(c("splice_n_introns") - c("splice_n_supported"), c("splice_n_introns") - c("splice_n_canonical"), c("splice_n_corrected"), c("splice_shortest_intron")),
        F.coalesce("splice_flags", none),
        qc.homology_flags(F.lower("homology_status"), c("homology_query_coverage"), c("homology_chimeric"), c("homology_fragmented"), c("homology_te_overlap")),
        F.coalesce("homology_flags", none),
    )
    rows = rows.withColumn("flags", qc.known(marks))
    rows = rows.withColumn("tier", qc.tier(c("confidence_score"), c("flags"))).withColumn("combined_aed", qc.combined_aed(c("rnaseq_aed"), c("homology_score"), c("confidence_score")))
    return rows.select("gene_id", "tier", "flags", "confidence_score", "splice_score", "homology_score", "rnaseq_aed", "combined_aed")


def tiers(rows: DataFrame) -> dict[str, DataFrame]:
    """Genes of each tier: disjoint tables."""
    return {name: rows.filter(F.col("tier") == name) for name in ("high", "medium", "low", "reject")}

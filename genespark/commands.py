"""Whole jobs from files to files: refine, evidence, confidence, splice, quality, homology, plans.

Each function reads its inputs from paths that Spark reads, runs, writes the reports
that are asked for and returns the main table.  ``python -m genespark.commands NAME
key=value ...`` calls one of them.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs
from .operators import genes as gene_tables
from .operators import homology, junctions, planning, predictions, qc, refine, report
from .sources import bam, interchange, readers, reports, writers


def _models(spark: SparkSession, gff: str) -> tuple[DataFrame, DataFrame]:
    return readers.gene_models(readers.gff3(spark, gff))


def _alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a BAM file by name, else of SAM text."""
    return bam.bam(spark, path) if path.endswith(".bam") else readers.sam(spark, path)


def _junctions(spark: SparkSession, files: str | None, sam: str | None, least_samples: int = 1) -> DataFrame:
    """Junctions of comma-separated files and alignment files."""
    own = [readers.junctions(spark, p) for p in (files or "").split(",") if p]
    samples = [readers.read_introns(_alignments(spark, p)) for p in (sam or "").split(",") if p]
    if not own and not samples:
        raise ValueError("junctions or sam is needed")
    return junctions.load(samples, own, least_samples)


def _within(rows: DataFrame, region: str | None, inside: bool) -> DataFrame:
    """Genes of a region ``seqid:start-end`` (1-based): those inside, or those that touch it."""
    if not region:
        return rows
    from .functions import regions

    place = rows.sparkSession.range(1).select(regions.parse(F.lit(region)).alias("r")).first().r
    if place is None:
        raise ValueError(f"not a region: {region}")
    return (gene_tables.inside if inside else gene_tables.overlapping)(rows, place.seqid, place.start, place.end)


def _chunks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Chunks and their probabilities from one predictions table (chunk_id, seqid, start, end, probs)."""
    rows = interchange.predictions(spark, path)
    return rows.select("chunk_id", "seqid", "start", "end"), rows.select("chunk_id", "probs")


def run_refine(spark: SparkSession, gff: str, genome: str, predicted: str, output: str, junction_files: str | None = None, sam: str | None = None, region: str | None = None, max_shift: int = 15, min_reads: int = 3, min_samples: int = 1, window: int = 30, threshold: float = 0.5) -> DataFrame:
    """Refined genes: ``output``/genes.gff3 and ``output``/report.tsv."""
    found, transcripts = _models(spark, gff)
    found = _within(found, region, True)
    transcripts = transcripts.join(found.select("gene_id"), "gene_id", "left_semi")
    chunks, data = _chunks(spark, predicted)
    aligned = readers.aligned_blocks(_alignments(spark, sam.split(",")[0])) if sam else None
    config = refine.Config(max_shift, min_reads, window, threshold)
    blocks = readers.genome_blocks(readers.fasta(spark, genome))
    done, changed = runs.refine_genes(found, transcripts, blocks, _junctions(spark, junction_files, sam, min_samples), chunks, data, aligned, config, stranded=True)
    writers.write_gff3(done, changed, f"{output}/genes.gff3")
    shown = done.withColumnsRenamed({"overall_score": "confidence_score", "mean_exon_coverage": "mean_coverage"})
    writers.tsv(reports.refine_report(shown, changed), f"{output}/report.tsv", ["gene_id"])
    return done


def run_evidence(spark: SparkSession, gff: str, output: str, junction_files: str | None = None, sam: str | None = None, min_reads: int = 3, min_coverage: float = 5, tolerance: int = 10, coverage: bool = True) -> DataFrame:
    """Evidence of genes: ``output``/report.tsv and ``output``/summary.tsv, and the annotated genes in ``output``/genes.gff3."""
    found, transcripts = _models(spark, gff)
    aligned = readers.aligned_blocks(_alignments(spark, sam.split(",")[0])) if sam and coverage else None
    scores = runs.kept(runs.score_evidence(found, transcripts, _junctions(spark, junction_files, sam), aligned, min_reads, min_coverage, tolerance, stranded=False))
    writers.tsv(reports.evidence_report(scores), f"{output}/report.tsv", ["gene_id"])
    writers.tsv(reports.evidence_brief(scores), f"{output}/summary.tsv", ["gene_id"])
    marked = refine.with_attributes(found.join(scores.select("gene_id", "aed"), "gene_id", "left"), {"aed": "aed"})
    writers.write_gff3(marked, transcripts, f"{output}/genes.gff3")
    return scores


def run_confidence(spark: SparkSession, gff: str, predicted: str, output: str, region: str | None = None) -> DataFrame:
    """Confidence of genes that touch a region: ``output``/scores.tsv, scores.bed and low.bed."""
    found, transcripts = _models(spark, gff)
    found = _within(found, region, False)
    chunks, data = _chunks(spark, predicted)
    scores = runs.kept(runs.confidence(found, transcripts, chunks, data))
    writers.tsv(reports.confidence_report(scores, found), f"{output}/scores.tsv", ["gene_id"])
    placed = scores.join(found.select("gene_id", "seqid", "start", "end", "strand"), "gene_id")
    writers.write_track(writers.confidence_bed(placed), f"{output}/scores.bed")
    low = placed.withColumn("low_regions", F.transform("low_regions", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end"), r["score"].alias("score"))))
    writers.write_track(writers.low_confidence_bed(low), f"{output}/low.bed", writers.LOW_TRACK)
    return scores


def run_splice(spark: SparkSession, gff: str, genome: str, output: str, junction_files: str | None = None, sam: str | None = None, max_shift: int = 15, min_reads: int = 3, min_samples: int = 1) -> DataFrame:
    """Corrected splice sites: ``output``/genes.gff3, report.tsv, corrections.tsv and unsupported.bed."""
    found, transcripts = _models(spark, gff)
    blocks = readers.genome_blocks(readers.fasta(spark, genome))
    changed, rows, each = runs.refine_splices(transcripts, blocks, _junctions(spark, junction_files, sam, min_samples), max_shift, min_reads)
    writers.write_gff3(runs.with_bounds(found, changed), changed, f"{output}/genes.gff3")
    writers.tsv(reports.splice_report(rows), f"{output}/report.tsv", ["gene_id"])
    writers.tsv(reports.corrections_report(reports.with_intron_index(runs.corrections(each, max_shift), transcripts)), f"{output}/corrections.tsv", ["gene_id"])
    reports.unsupported_bed(each, transcripts, min_reads).write.text(f"{output}/unsupported.bed")
    return rows


def qc_aggregate(spark: SparkSession, output: str, confidence: str | None = None, splice: str | None = None, homology_table: str | None = None) -> DataFrame:
    """Quality of genes from up to three metric tables: ``output``."""
    numbers = sorted({c for source in runs.SOURCES.values() for c, kind in source.items() if kind in ("double", "long")})
    read = lambda path: interchange.metrics(spark, path, numbers) if path else None
    rows = runs.kept(runs.quality(read(confidence), read(splice), read(homology_table)))
    writers.tsv(reports.qc_report(rows), output, ["gene_id"])
    return rows


def qc_report(spark: SparkSession, table: str, kind: str = "text") -> str:
    """The report of an aggregated table as text, json or html."""
    return {"text": report.as_text, "json": report.as_json, "html": report.as_html}[kind](interchange.qc_table(spark, table))


def qc_filter(spark: SparkSession, table: str, preset: str, output: str, gff: str | None = None) -> DataFrame:
    """Genes that pass a preset: ``output``/genes (ids) and, with a GFF3 file, ``output``/genes.gff3."""
    rows = qc.apply_filter(interchange.qc_table(spark, table), qc.PRESETS[preset])
    passed = runs.kept(rows.filter("fail_reason IS NULL").select("gene_id"))
    passed.write.text(f"{output}/genes")
    if gff:
        gene_tables.filtered_lines(readers.raw_lines(spark, gff), passed).orderBy("file", "line_no").select("value").write.text(f"{output}/genes.gff3")
    return rows


def qc_tiers(spark: SparkSession, table: str, output: str) -> None:
    writers.tier_lists(interchange.qc_table(spark, table), output)


def qc_flags(spark: SparkSession, category: str | None = None, severity: str | None = None) -> DataFrame:
    """The registered flags, of a category or from a severity up."""
    rows = qc.flag_table(spark)
    rows = rows.filter(F.col("category") == category) if category else rows
    return rows.filter(F.col("rank") >= qc.SEVERITIES.index(severity)) if severity else rows


def extract_proteins(spark: SparkSession, gff: str, genome: str, output: str) -> DataFrame:
    """Proteins of all transcripts as FASTA."""
    _, transcripts = _models(spark, gff)
    found = gene_tables.proteins(gene_tables.coding_sequences(transcripts, readers.genome_blocks(readers.fasta(spark, genome))))
    writers.fasta(found.select(F.col("gene_id").alias("seqid"), F.col("protein").alias("seq"))).write.text(output)
    return found


def validate_homology(spark: SparkSession, gff: str, hits: str, output: str, te: str | None = None, thresholds: str = "default") -> DataFrame:
    """Homology status of genes: ``output``/report.tsv, chimeras.tsv, fragments.tsv and genes.gff3."""
    found, transcripts = _models(spark, gff)
    limits = {"default": homology.DEFAULT, "strict": homology.STRICT, "relaxed": homology.RELAXED}[thresholds]
    rows = readers.hits(spark, hits)
    results = runs.kept(runs.validate(found, rows, readers.te_bed(spark, te) if te else None, limits))
    writers.tsv(reports.validation_report(results), f"{output}/report.tsv", ["gene_id"])
    writers.tsv(reports.chimera_report(homology.chimeras(homology.significant(rows, limits))), f"{output}/chimeras.tsv", ["gene_id"])
    writers.tsv(reports.fragment_report(results), f"{output}/fragments.tsv", ["fragment_group"])
    status = F.map_from_arrays(F.array(F.lit("homology_status")), F.array("status"))
    marked = found.join(results.select("gene_id", "status"), "gene_id", "left").withColumn("attributes", F.when(F.col("status").isNotNull(), F.map_concat(F.map_filter("attributes", lambda k, v: k != "homology_status"), status)).otherwise(F.col("attributes")))
    writers.write_gff3(marked, transcripts, f"{output}/genes.gff3")
    return results


def list_databases(spark: SparkSession, cache: str) -> DataFrame:
    return interchange.databases(spark, cache)


def plan(spark: SparkSession, genome: str, output: str, strategy: str = "scaffold", size: int = 10_000_000, least: int = 100_000, gff: str | None = None, chunks: int = 16) -> DataFrame:
    """A chunk plan of a genome, by scaffold, size or adaptive (with genes)."""
    scaffolds = readers.fasta_lengths(readers.fasta(spark, genome))
    scaffolds = writers.numbered(scaffolds, ["seqid"], "ord")
    if strategy == "scaffold":
        found = planning.scaffold_chunks(scaffolds)
    elif strategy == "size":
        found = planning.size_chunks(scaffolds, size, least)
    else:
        found = writers.numbered(gene_tables.adaptive_chunks(scaffolds, _models(spark, gff)[0], chunks, least), ["seqid", "start"], "k").withColumn("chunk_id", F.format_string("chunk_%04d", "k"))
    interchange.write_plan(found, output, strategy)
    return found


def tasks(spark: SparkSession, plan_path: str, template: str, output: str) -> DataFrame:
    """A command for each chunk of a plan, as text."""
    found = planning.commands(interchange.read_plan(spark, plan_path), template)
    found.orderBy("chunk_id").select("command").write.text(output)
    return found


def merge(spark: SparkSession, inputs: str, output: str, kind: str = "concat") -> DataFrame:
    """Outputs of chunks as one: concat, merge_gff or merge_tsv."""
    lines = readers.raw_lines(spark, inputs)
    rows = {"concat": lambda x: x.select(F.struct("file", "line_no").alias("ord"), "value"), "merge_gff": planning.merge_gff, "merge_tsv": planning.merge_tables}[kind](lines)
    rows.orderBy("ord").select("value").write.text(output)
    return rows


def suggest(genome_size: int, n_genes: int, memory_gb: float, workers: int) -> dict:
    return planning.advice(genome_size, n_genes, memory_gb, workers)


COMMANDS = {f.__name__: f for f in (run_refine, run_evidence, run_confidence, run_splice, qc_aggregate, qc_report, qc_filter, qc_tiers, qc_flags, extract_proteins, validate_homology, list_databases, plan, tasks, merge)}


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in COMMANDS:
        sys.exit("commands: " + ", ".join(COMMANDS))
    import inspect

    function = COMMANDS[arguments[0]]
    kinds = {k: type(p.default) if p.default not in (None, inspect.Parameter.empty) else str for k, p in inspect.signature(function).parameters.items()}
    values = {k: kinds[k](v) if kinds[k] is not bool else v == "true" for k, v in (a.split("=", 1) for a in arguments[1:])}
    spark = SparkSession.builder.appName(f"genespark {arguments[0]}").getOrCreate()
    found = function(spark, **values)
    if isinstance(found, str):
        print(found)
    elif isinstance(found, DataFrame):
        found.show(20, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])

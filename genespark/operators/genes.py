"""Gene tables: regions, coding sequences, proteins, subsets, filtered files and chunk strategies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dna
from . import confidence, intervals
from .planning import carry_forward


def overlapping(genes: DataFrame, seqid: str, start: int, end: int) -> DataFrame:
    """Genes that touch a region."""
    return genes.filter((F.col("seqid") == seqid) & intervals.overlaps(F.col("start"), F.col("end"), F.lit(start), F.lit(end)))


def inside(genes: DataFrame, seqid: str, start: int, end: int) -> DataFrame:
    """Genes that lie fully in a region."""
    return genes.filter((F.col("seqid") == seqid) & intervals.contains(F.lit(start), F.lit(end), F.col("start"), F.col("end")))


def read_count(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """region_id and the number of alignments (seqid, start, end) that touch it."""
    spans = regions.withColumnsRenamed({"start": "region_start", "end": "region_end"})
    met = intervals.overlap_join(spans, reads.select("seqid", "start", "end"), ["seqid"], ("region_start", "region_end"), ("start", "end"))
    counts = met.groupBy("region_id").agg(F.count("*").alias("n_reads"))
    return regions.select("region_id").join(counts, "region_id", "left").na.fill(0, ["n_reads"])


def structure(exons: Column, cds: Column) -> dict[str, Column]:
    """Counts and lengths of a transcript."""
    total = lambda parts: F.aggregate(parts, F.lit(0).cast("long"), lambda a, e: a + e["end"] - e["start"])
    return {"n_exons": F.size(exons), "n_cds": F.size(cds), "transcript_length": total(exons), "cds_length": total(cds)}


def coding_sequences(transcripts: DataFrame, blocks: DataFrame, size: int = 1 << 20) -> DataFrame:
    """transcript_id, gene_id and the coding sequence: segments in transcript order, phase ignored.

    ``blocks`` holds the genome in blocks of ``size`` (seqid, block_start, seq), so a
    segment meets only the blocks it touches.
    """
    from ..sources.readers import subsequences

    parts = transcripts.select("transcript_id", "gene_id", "seqid", "strand", F.posexplode(F.array_sort("cds")).alias("k", "c"))
    cut = subsequences(parts.select("transcript_id", "gene_id", "seqid", "strand", "k", "c.start", "c.end"), blocks, ["transcript_id", "gene_id", "strand", "k"], size)
    order = F.when(F.col("strand") == "-", -F.col("k")).otherwise(F.col("k"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), dna.stranded(F.col("seq"), F.col("strand")).alias("s")))), lambda p: p["s"]), "")
    return cut.groupBy("transcript_id", "gene_id").agg(joined.alias("seq"))


def proteins(coding: DataFrame) -> DataFrame:
    """Proteins without the stop at their end; empty ones are left out."""
    found = coding.withColumn("protein", F.regexp_replace(dna.translate(F.col("seq")), r"\*+$", ""))
    return found.filter(F.length("protein") > 0).drop("seq")


def taxon(description: Column) -> Column:
    """Taxonomy id of a ``OX=`` field, or null."""
    return F.nullif(F.regexp_extract(description, r"OX=(\d+)", 1), F.lit(""))


def subset(records: DataFrame, ids: DataFrame, key: str = "seqid") -> DataFrame:
    return records.join(ids.select(key).distinct(), key, "left_semi")


def top_hits(hits: DataFrame, k: int, query: str = "query_id") -> DataFrame:
    """The k best hits of each query by e-value, then file order."""
    order = Window.partitionBy(query).orderBy("evalue", "ord")
    return hits.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k).drop("__r")


def filtered_lines(lines: DataFrame, keep: DataFrame) -> DataFrame:
    """Lines of a GFF3 file (line_no, value) whose gene is in ``keep`` (gene_id); comments stay.

    A gene line sets the gene of the lines after it.  A file in several parts has the
    column ``file``: parts count in the order of their names, line numbers only inside one
    (large parts are read first, so over all parts they aren't in order).
    """
    gene = F.when(F.col("value").rlike("^[^#\t]*\t[^\t]*\tgene\t"), F.regexp_extract("value", r"(?:^|[;\t])ID=([^;]+)", 1))
    marked = lines.withColumn("gene_id", gene)
    place = ["file", "line_no"] if "file" in lines.columns else ["line_no"]
    filled = carry_forward(marked, "line_no", "gene_id", files=place[0] if len(place) > 1 else None)
    comment = F.col("value").startswith("#")
    wanted = filled.join(keep.select("gene_id").distinct().withColumn("__keep", F.lit(True)), "gene_id", "left")
    return wanted.filter(comment | F.coalesce("__keep", F.lit(False))).select(*place, "value")


def confidence_track(bases: DataFrame, keys: list[str], at: str = "pos", probs: str = "probs", window: int = 20) -> DataFrame:
    """Per base the largest probability, entropy and called class, with the smoothed probability."""
    found = bases.withColumn("max_prob", F.array_max(probs)).withColumn("entropy", confidence.entropy(F.col(probs))).withColumn("call", confidence.call(F.col(probs)))
    return intervals.smooth(found, keys, at, "max_prob", window)


def chunk_of(regions: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunk that holds all of a region (seqid, region_start, region_end)."""
    met = intervals.overlap_join(regions, chunks.select("seqid", "chunk_id", "start", "end"), ["seqid"], ("region_start", "region_end"), ("start", "end"))
    return met.filter(intervals.contains(F.col("start"), F.col("end"), F.col("region_start"), F.col("region_end"))).drop("start", "end")


def adaptive_chunks(scaffolds: DataFrame, genes: DataFrame, n_chunks: int, least: int) -> DataFrame:
    """Chunks sized by gene density; an end that falls into a gene moves to the gene's end.

    A walk over the genes of a scaffold, so it runs per scaffold in pandas.  Totals
    come from one small aggregate.
    """
    counts = scaffolds.join(genes.groupBy("seqid").agg(F.count("*").alias("n")), "seqid", "left").na.fill(0, ["n"])
    total, n_genes = counts.agg(F.sum("length"), F.sum("n")).first()
    target, usual = max(least, (total or 0) // n_chunks), (n_genes or 0) / max(total or 0, 1)

    def walk(key, own: pd.DataFrame, placed: pd.DataFrame) -> pd.DataFrame:
        rows = []
        spans = sorted(zip(placed["start"], placed["end"], strict=True)) if len(placed) else []
        for length, n in zip(own["length"], own["n"], strict=True):
            density = n / length / usual if usual and length else 0.0
            size, at = max(least, int(target / max(0.5, density))), 0
            while at < length:
                end = min(at + size, length)
                end = min(length, max([end, *(e for s, e in spans if s < end < e)]))
                if length - end < least:
                    end = length
                rows.append((key[0], at, int(end)))
                at = int(end)
        return pd.DataFrame(rows, columns=["seqid", "start", "end"])

    return counts.groupBy("seqid").cogroup(genes.select("seqid", "start", "end").groupBy("seqid")).applyInPandas(walk, "seqid string, start long, end long")

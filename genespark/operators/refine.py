"""The refine pipeline: flags, coordinate checks and attributes of refined genes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import splice


@dataclass(frozen=True)
class Config:
    max_shift: int = 15
    min_junction_reads: int = 3
    search_window: int = 30
    confidence_threshold: float = 0.7


def flags(confidence: Column, worst_exon: Column, confidence_flags: Column, evidence_flags: Column, corrected: Column, noncanonical: Column, introns: Column, supported: Column, adjusted: Column, config: Config = Config()) -> Column:
    """All flags in their fixed order, each once; an adjusted boundary is no longer uncertain."""
    none = F.array().cast("array<string>")
    own = F.array(
        F.when(confidence < 0.5, "VERY_LOW_CONF").when(confidence < config.confidence_threshold, "LOW_CONF"),
        F.when(worst_exon < 0.6, "WEAK_EXON"),
    )
    more = F.array(
        F.when(corrected > 0, "SPLICE_CORRECTED"),
        F.when(noncanonical > 0, "NONCANONICAL_SPLICE"),
        F.when((introns > 0) & (supported == 0), "NO_JUNCTION_SUPPORT"),
        F.when(adjusted, "BOUNDARY_ADJUSTED"),
    )
    joined = F.array_distinct(F.filter(F.concat(own, F.coalesce(confidence_flags, none), F.coalesce(evidence_flags, none), more), lambda x: x.isNotNull()))
    return F.when(adjusted, F.array_remove(joined, "uncertain_boundary")).otherwise(joined)


def validated(transcripts: DataFrame) -> DataFrame:
    """Drop empty exons and coding segments and recompute start and end."""
    kept = transcripts.withColumn("exons", splice.valid_parts(F.col("exons"))).withColumn("cds", splice.valid_parts(F.col("cds")))
    return kept.withColumn("__b", splice.bounds(F.col("exons"))).withColumn("start", F.coalesce("__b.start", "start")).withColumn("end", F.coalesce("__b.end", "end")).drop("__b")


def with_attributes(genes: DataFrame, scores: dict[str, str]) -> DataFrame:
    """Add scores to the attribute map as strings of four decimals; missing ones are left out."""
    pairs = F.filter(F.array(*(F.struct(F.lit(name).alias("key"), F.format_string("%.4f", F.col(column)).alias("value"), F.col(column).isNotNull().alias("there")) for name, column in scores.items())), lambda p: p["there"])
    added = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["key"], p["value"])))
    kept = F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(added, k))
    return genes.withColumn("attributes", F.map_concat(kept, added))


def refine_transcripts(transcripts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply splice decisions to transcripts (gene, exons, cds): per transcript one fold, in intron order."""
    changed = decisions.filter((F.col("new_start") != F.col("intron_start")) | (F.col("new_end") != F.col("intron_end")))
    listed = changed.groupBy("gene").agg(F.collect_list(F.struct("intron_start", "intron_end", "new_start", "new_end")).alias("changes"))
    none = F.array().cast(listed.schema["changes"].dataType)
    found = transcripts.join(listed, "gene", "left").withColumn("changes", F.coalesce("changes", none)).withColumn("exons", F.array_sort("exons"))
    index = lambda c: F.array_position(F.transform("exons", lambda e: e["end"]), c["intron_start"]) - 1
    listed_here = F.filter(F.array_sort(F.transform("changes", lambda c: F.struct(index(c).alias("idx"), c["new_start"].alias("start"), c["new_end"].alias("end")))), lambda c: (c["idx"] >= 0) & (c["idx"] < F.size("exons") - 1))
    found = found.withColumn("__f", splice.apply_corrections(F.col("exons"), F.col("cds"), listed_here))
    return validated(found.withColumn("exons", F.col("__f.exons")).withColumn("cds", F.col("__f.cds")).drop("__f", "changes"))

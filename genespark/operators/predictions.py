"""Class probabilities stored in chunks, and the coordinates of their arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import BIN, offsets, overlap_join


def coordinate_index(scaffolds: DataFrame) -> DataFrame:
    """seqid, ord, length and the scaffold's offset in the concatenated array."""
    return offsets(scaffolds, "length", "ord")


def to_array(positions: DataFrame, index: DataFrame) -> DataFrame:
    """Add array_pos to rows of seqid, pos; positions outside the scaffold drop out."""
    met = positions.join(index.select("seqid", "length", "offset"), "seqid").filter((F.col("pos") >= 0) & (F.col("pos") < F.col("length")))
    return met.withColumn("array_pos", F.col("offset") + F.col("pos")).drop("length", "offset")


def to_genomic(positions: DataFrame, index: DataFrame, size: int = 1 << 20) -> DataFrame:
    """Add seqid and pos to rows of array_pos, by the scaffold range they fall in."""
    spans = index.select("seqid", F.col("offset").alias("__s"), (F.col("offset") + F.col("length")).alias("__e")).withColumn("__k", F.lit(0))
    points = positions.withColumn("__k", F.lit(0)).withColumn("__p", F.col("array_pos")).withColumn("__q", F.col("array_pos") + 1)
    met = overlap_join(points, spans, ["__k"], ("__p", "__q"), ("__s", "__e"), size)
    return met.withColumn("pos", F.col("array_pos") - F.col("__s")).drop("__k", "__p", "__q", "__s", "__e")


def chunk_index(chunks: DataFrame) -> DataFrame:
    """Chunks with low and high ends and a strand: start > end means the reverse strand."""
    return chunks.withColumn("strand", F.when(F.col("start") < F.col("end"), "+").otherwise("-")).withColumn("low", F.least("start", "end")).withColumn("high", F.greatest("start", "end"))


def chunk_slices(regions: DataFrame, chunks: DataFrame, size: int = BIN) -> DataFrame:
    """Chunks that overlap regions (region_id, seqid, strand, region_start, region_end), with slice bounds.

    Reverse chunks count from their high end.
    """
    met = overlap_join(regions, chunks.select("seqid", "strand", "chunk_id", "low", "high"), ["seqid", "strand"], ("region_start", "region_end"), ("low", "high"), size)
    first, last = F.greatest("region_start", "low"), F.least("region_end", "high")
    plus = F.col("strand") == "+"
    return met.withColumn("slice_start", F.when(plus, first - F.col("low")).otherwise(F.col("high") - last)).withColumn("slice_end", F.when(plus, last - F.col("low")).otherwise(F.col("high") - first))


def region_probabilities(slices: DataFrame, data: DataFrame) -> DataFrame:
    """Probabilities of regions in genomic order; bases without a chunk are left out.

    ``data`` holds chunk_id and probs (array by position in the chunk).
    """
    cut = F.slice("probs", (F.col("slice_start") + 1).cast("int"), (F.col("slice_end") - F.col("slice_start")).cast("int"))
    parts = slices.join(data, "chunk_id").withColumn("part", F.when(F.col("strand") == "-", F.reverse(cut)).otherwise(cut))
    listed = F.array_sort(F.collect_list(F.struct("low", "part")))
    return parts.groupBy("region_id").agg(F.flatten(F.transform(listed, lambda x: x["part"])).alias("probs"))


def at_positions(positions: DataFrame, data: DataFrame, size: int) -> DataFrame:
    """Point look-up in arrays of ``size`` positions a row (sample): adds probs to rows of array_pos."""
    keyed = positions.withColumn("sample", F.floor(F.col("array_pos") / size)).withColumn("__i", (F.col("array_pos") % size + 1).cast("int"))
    return keyed.join(data, "sample").withColumn("probs", F.element_at("probs", F.col("__i"))).drop("__i", "sample")


def scaffold_lengths(chunks: DataFrame) -> DataFrame:
    return chunk_index(chunks).filter("strand = '+'").groupBy("seqid").agg(F.max("high").alias("length"))


def has_both_strands(chunks: DataFrame) -> bool:
    return chunk_index(chunks).select("strand").distinct().count() == 2


def legacy_region_probabilities(regions: DataFrame, index: DataFrame, data: DataFrame, size: int) -> DataFrame:
    """Probabilities of regions (region_id, seqid, region_start, region_end) in the concatenated array, strand ignored.

    ``data`` has sample (from 0) and probs, ``size`` positions a row; a flat array is one
    cut into such rows.  Each region meets only the rows it touches.
    """
    met = regions.join(index.select("seqid", "length", "offset"), "seqid").filter((F.col("region_start") >= 0) & (F.col("region_end") <= F.col("length")) & (F.col("region_start") < F.col("region_end")))
    spans = met.select("region_id", (F.col("offset") + F.col("region_start")).alias("__s"), (F.col("offset") + F.col("region_end")).alias("__e"))
    touched = spans.withColumn("sample", F.explode(F.sequence(F.floor(F.col("__s") / size), F.floor((F.col("__e") - 1) / size))))
    low = F.greatest(F.col("__s") - F.col("sample") * size, F.lit(0))
    high = F.least(F.col("__e") - F.col("sample") * size, F.lit(size))
    cut = F.slice("probs", (low + 1).cast("int"), (high - low).cast("int"))
    parts = touched.join(data.select("sample", "probs"), "sample").select("region_id", "sample", cut.alias("part"))
    listed = F.array_sort(F.collect_list(F.struct("sample", "part")))
    return parts.groupBy("region_id").agg(F.flatten(F.transform(listed, lambda x: x["part"])).alias("probs"))


def tiles(scaffolds: DataFrame, size: int) -> DataFrame:
    """Regions of ``size`` positions over whole scaffolds (seqid, length): seqid, start, end; the last one is shorter."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    return scaffolds.filter("length > 0").select("seqid", "length", starts.alias("start")).select("seqid", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))


def scaffold_range(index: DataFrame, seqid: str) -> DataFrame:
    """First and last place (half-open) of a scaffold in the array."""
    return index.filter(F.col("seqid") == seqid).select("seqid", F.col("offset").alias("array_start"), (F.col("offset") + F.col("length")).alias("array_end"))

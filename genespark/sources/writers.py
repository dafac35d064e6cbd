"""Writers of annotation files. Each gives a DataFrame of lines with a sort key, or writes text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dna
from .readers import ESCAPES

# Colours of the confidence classes in browser tracks.
COLOURS = {"high": "0,150,0", "medium": "255,200,0", "low": "200,0,0"}
OTHER_COLOUR = "128,128,128"
TRACK = 'track name="genespark confidence" itemRgb="On"'
LOW_TRACK = 'track name="Low Confidence Regions" color="200,0,0"'


def escape(text: Column) -> Column:
    for code, char in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def attributes(entries: Column) -> Column:
    """``key=value`` pairs of a map; ``.`` for an empty one."""
    joined = F.array_join(F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), escape(e["value"]))), ";")
    return F.when(F.size(entries) > 0, joined).otherwise(".")


def gff3_lines(genes: DataFrame, transcripts: DataFrame, source: str = "genespark") -> DataFrame:
    """Sort key (gene_ord, tx_ord, kind, n) and line of genes with line_no, and of their transcripts."""
    line = lambda kind, start, end, strand, phase, attrs: F.concat_ws("\t", F.col("seqid"), F.lit(source), F.lit(kind), (start + 1).cast("string"), end.cast("string"), F.lit("."), strand, phase, attrs)
    dot, c = F.lit("."), F.col
    with_id = lambda name, column, more=None: F.map_concat(F.create_map(F.lit(name), column), *([more] if more is not None else []))
    rest = F.map_filter(c("attributes"), lambda k, v: ~k.isin("ID", "Parent"))
    tops = genes.select(c("line_no").alias("gene_ord"), F.lit(-1).cast("long").alias("tx_ord"), F.lit(0).alias("kind"), F.lit(0).alias("n"), line("gene", c("start"), c("end"), c("strand"), dot, attributes(with_id("ID", c("gene_id"), rest))).alias("line"))
    tx = transcripts.join(genes.select("gene_id", c("line_no").alias("gene_ord")), "gene_id")
    key = [c("gene_ord"), c("line_no").alias("tx_ord")]
    parent = F.create_map(F.lit("Parent"), c("gene_id"))
    mrna = tx.select(*key, F.lit(1).alias("kind"), F.lit(0).alias("n"), line("mRNA", c("start"), c("end"), c("strand"), dot, attributes(F.map_concat(with_id("ID", c("transcript_id")), parent, rest))).alias("line"))

    def parts(column: str, kind: str, rank: int, phase: Column) -> DataFrame:
        rows = tx.select("*", F.posexplode(F.filter(F.coalesce(column, F.expr(f"cast(array() as {dict(tx.dtypes)[column]})")), lambda e: e["start"] < e["end"])).alias("k", "p"))
        name = F.concat(c("transcript_id"), F.lit(f".{kind.lower()}"), (c("k") + 1).cast("string"))
        return rows.select(*key, F.lit(rank).alias("kind"), c("k").alias("n"), line(kind, c("p.start"), c("p.end"), c("strand"), phase, attributes(F.create_map(F.lit("ID"), name, F.lit("Parent"), c("transcript_id")))).alias("line"))

    return tops.unionByName(mrna).unionByName(parts("exons", "exon", 2, dot)).unionByName(parts("cds", "CDS", 3, c("p.phase").cast("string")))


def write_gff3(genes: DataFrame, transcripts: DataFrame, path: str, source: str = "genespark") -> None:
    """One sorted text file a partition; the first one begins with the version line."""
    lines = gff3_lines(genes, transcripts, source)
    head = lines.sparkSession.createDataFrame([(-1, -1, 0, 0, "##gff-version 3")], lines.schema)
    lines.unionByName(head).orderBy("gene_ord", "tx_ord", "kind", "n").select("line").write.text(path)


def confidence_bed(scores: DataFrame, value: str = "overall_score") -> DataFrame:
    """BED9 lines with a score times 1000, 1000 at most, and a colour by class."""
    number = F.least(F.lit(1000), F.floor(F.col(value) * 1000)).cast("string")
    colour = F.lit(OTHER_COLOUR)
    for name, rgb in COLOURS.items():
        colour = F.when(F.col("confidence_class") == name, rgb).otherwise(colour)
    place = [F.col("start").cast("string"), F.col("end").cast("string")]
    return scores.select(F.concat_ws("\t", "seqid", *place, "gene_id", number, "strand", *place, colour).alias("line"))


def low_confidence_bed(scores: DataFrame) -> DataFrame:
    """BED6 lines of the runs of low confidence (low_regions: array of struct<start, end, score>)."""
    rows = scores.select("seqid", "gene_id", "strand", F.explode("low_regions").alias("r"))
    return rows.select(F.concat_ws("\t", "seqid", F.col("r.start").cast("string"), F.col("r.end").cast("string"), F.concat("gene_id", F.lit("_lcr")), F.floor(F.col("r.score") * 1000).cast("string"), "strand").alias("line"))


def write_track(lines: DataFrame, path: str, head: str = TRACK) -> None:
    """Lines below a track line, which stands in a file that sorts before all others."""
    first = lines.sparkSession.createDataFrame([(0, head)], "k int, line string")
    lines.select(F.lit(1).alias("k"), "line").unionByName(first).orderBy("k").select("line").write.text(path)


def numbered(rows: DataFrame, order: list[str], column: str) -> DataFrame:
    """Add the row's number (from 0) in the given order.

    Rows are dealt to range partitions and numbered there; the partitions' offsets come
    from a table of one row a partition.  The dealt rows are staged, as both passes
    must see the same partitions.
    """
    from pyspark.sql import Window

    from .. import storage

    dealt = storage.kept(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    base = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__part").orderBy(*order)
    return dealt.withColumn("__k", F.row_number().over(inside) - 1).join(base, "__part").withColumn(column, F.col("__base") + F.col("__k")).drop("__part", "__base", "__k")


def junction_bed(junctions: DataFrame) -> DataFrame:
    """BED6 lines with read counts in columns 7 and 8, named in the order of place."""
    text = lambda c: F.col(c).cast("string")
    rows = numbered(junctions, ["seqid", "start", "end", "strand"], "k")
    return rows.select("k", F.concat_ws("\t", "seqid", text("start"), text("end"), F.format_string("JUNC%06d", "k"), F.least(F.lit(1000), F.col("reads")).cast("string"), "strand", text("reads"), text("unique_reads")).alias("line"))


def fasta(records: DataFrame, width: int = 60) -> DataFrame:
    return records.select(F.concat(F.lit(">"), F.col("seqid"), F.lit("\n"), dna.wrapped(F.col("seq"), width)).alias("record"))


def tsv(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Tab-separated table with a header; doubles with four decimals."""
    cells = [F.format_string("%.4f", F.col(c)).alias(c) if t == "double" else F.array_join(c, ",").alias(c) if t == "array<string>" else F.col(c) for c, t in rows.dtypes]
    (rows.orderBy(*order) if order else rows).select(*cells).write.csv(path, sep="\t", header=True)


def tier_lists(genes: DataFrame, path: str) -> None:
    """Gene ids in a folder for each tier."""
    genes.select("tier", F.col("gene_id").cast("string")).write.partitionBy("tier").text(path)

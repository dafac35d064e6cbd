"""Readers of annotation files into half-open, 0-based tables.

All are ``spark.read.text`` with column expressions, so they split, push down
nothing into Python and read .gz as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The four escapes of GFF3 attributes.
ESCAPES = (("%3B", ";"), ("%3D", "="), ("%26", "&"), ("%2C", ","))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and place in it, comments and blank lines left out.

    ``line_no`` rises within a file (parts of a file keep their order); files are told
    apart by name, so (file, line_no) is the order of rows over several files.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value"))
    return rows.filter((F.trim("value") != "") & ~F.col("value").startswith("#"))


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines (file, line_no, value), comments and blank ones too."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value"))


def _fields(rows: DataFrame, least: int) -> DataFrame:
    return rows.withColumn("f", F.split("value", "\t")).filter(F.size("f") >= least)


def _at(k: int) -> Column:
    return F.get("f", F.lit(k))


def _number(k: int, kind: str) -> Column:
    return _at(k).try_cast(kind)


def unescape(text: Column) -> Column:
    for code, char in ESCAPES:
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def attributes(text: Column) -> Column:
    """Map of ``key=value`` pairs; values may hold further ``=``, the last of equal keys wins."""
    pairs = F.filter(F.split(text, ";"), lambda p: F.instr(p, "=") > 1)
    entries = F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), unescape(F.substr(p, F.instr(p, "=") + 1, F.length(p))).alias("value")))
    last = F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))
    return F.when(text.isNull() | (text == "."), F.create_map().cast("map<string,string>")).otherwise(last)


def gff3(spark: SparkSession, path: str) -> DataFrame:
    """Features: file, line_no, seqid, source, type, start, end, score, strand, phase, attributes."""
    rows = _fields(_lines(spark, path), 9)
    return rows.select(
        "file",
        "line_no",
        _at(0).alias("seqid"),
        _at(1).alias("source"),
        _at(2).alias("type"),
        (_number(3, "long") - 1).alias("start"),
        _number(4, "long").alias("end"),
        _number(5, "double").alias("score"),
        F.when(_at(6).isin("+", "-"), _at(6)).otherwise("+").alias("strand"),
        _number(7, "int").alias("phase"),
        attributes(_at(8)).alias("attributes"),
    ).filter("start IS NOT NULL AND end IS NOT NULL")


def gene_models(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Genes and transcripts (with sorted exons and cds) of GFF3 features; of equal ids the last counts.

    The order is that of (file, line_no), or of line_no in a table without files.
    """
    parent = F.col("attributes")["Parent"]
    own_id = F.col("attributes")["ID"]
    place = ["file", "line_no"] if "file" in features.columns else ["line_no"]
    latest = lambda rows, key: rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*place)).alias("r")).select(key, "r.*")
    genes = features.filter("type = 'gene'").withColumn("gene_id", F.coalesce(own_id, F.concat(F.lit("gene_"), F.col("line_no").cast("string"))))
    genes = latest(genes, "gene_id").select("gene_id", "line_no", "seqid", "start", "end", "strand", "source", "attributes")
    tx = features.filter(F.col("type").isin("mRNA", "transcript")).withColumn("transcript_id", F.coalesce(own_id, F.concat(F.lit("transcript_"), F.col("line_no").cast("string"))))
    tx = latest(tx, "transcript_id").select("transcript_id", "line_no", "seqid", "start", "end", "strand", "attributes", F.explode(F.split(parent, ",")).alias("gene_id"))
    parts = features.filter(F.col("type").isin("exon", "CDS")).withColumn("transcript_id", F.explode(F.split(parent, ",")))
    exon, segment = F.struct("start", "end"), F.struct("start", "end", F.coalesce("phase", F.lit(0)).alias("phase"))
    listed = parts.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.when(F.col("type") == "exon", exon))).alias("exons"), F.array_sort(F.collect_list(F.when(F.col("type") == "CDS", segment))).alias("cds"))
    return genes, tx.join(listed, "transcript_id", "left")


def primary_transcript(transcripts: DataFrame) -> DataFrame:
    """Per gene the transcript with most coding bases (exon bases if it has none), the first on a tie."""
    total = lambda parts: F.aggregate(F.coalesce(parts, F.array().cast("array<struct<start:bigint,end:bigint>>")), F.lit(0).cast("long"), lambda a, e: a + e["end"] - e["start"])
    coding, exonic = total(F.transform("cds", lambda c: F.struct(c["start"], c["end"]))), total(F.col("exons"))
    rank = F.struct(F.when(coding > 0, coding).otherwise(exonic), -F.col("line_no"))
    rest = [c for c in transcripts.columns if c != "gene_id"]
    return transcripts.groupBy("gene_id").agg(F.max_by(F.struct(*rest), rank).alias("t")).select("gene_id", "t.*")


def gene(genes: DataFrame, gene_id: str) -> DataFrame:
    """The row of a gene, or none: a filter that reaches the scan."""
    return genes.filter(F.col("gene_id") == gene_id)


def gff_statistics(genes: DataFrame) -> DataFrame:
    """Genes of each scaffold, and of all under the null seqid."""
    return genes.groupBy("seqid").agg(F.count("*").alias("n_genes")).unionByName(genes.agg(F.lit(None).cast("string").alias("seqid"), F.count("*").alias("n_genes")))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """seqid, description, seq: a row a record; a record begins with ``>`` at the start of a line."""
    rows = spark.read.text(path, lineSep="\n>").filter(F.length(F.trim("value")) > 0)
    text = F.regexp_replace("value", "^\\s*>", "")
    head, body = F.split(text, "\n", 2)[0], F.get(F.split(text, "\n", 2), F.lit(1))
    return rows.select(F.split(F.trim(head), r"\s+")[0].alias("seqid"), F.trim(F.regexp_replace(head, "\r", "")).alias("description"), F.regexp_replace(F.coalesce(body, F.lit("")), r"\s", "").alias("seq"))


def fasta_lengths(records: DataFrame) -> DataFrame:
    """seqid and length of each record."""
    return records.select("seqid", F.length("seq").cast("long").alias("length"))


def checked(regions: DataFrame, lengths: DataFrame) -> DataFrame:
    """The regions (seqid, start, end), or an error if one lies on no scaffold, is reversed or passes an end.

    ``lengths`` (seqid, length) has a row a scaffold.
    """
    met = regions.join(lengths.select("seqid", F.col("length").alias("__length")), "seqid", "left")
    wrong = F.col("__length").isNull() | (F.col("start") < 0) | (F.col("end") > F.col("__length")) | (F.col("start") > F.col("end"))
    told = F.raise_error(F.concat_ws(" ", F.lit("region out of bounds:"), "seqid", F.col("start").cast("string"), F.col("end").cast("string")))
    return met.withColumn("start", F.when(wrong, told.cast("long")).otherwise(F.col("start"))).drop("__length")


def genome_blocks(records: DataFrame, size: int = 1 << 20) -> DataFrame:
    """seqid, block_start, seq: long records in blocks that join on a position's block."""
    blocks = F.explode(F.transform(F.regexp_extract_all("seq", F.lit(f"[\\s\\S]{{1,{size}}}"), 0), lambda s, k: F.struct((k.cast("long") * size).alias("block_start"), s.alias("seq"))))
    return records.select("seqid", blocks.alias("b")).select("seqid", "b.*")


def subsequences(regions: DataFrame, blocks: DataFrame, keys: list[str], size: int = 1 << 20, lengths: DataFrame | None = None) -> DataFrame:
    """Sequence of regions (seqid, start, end) from blocks, joined on the blocks a region touches.

    With ``lengths`` (seqid, length) regions beyond their scaffold raise an error;
    without, only what lies on the scaffold is returned.  Empty regions give no row.
    """
    if lengths is not None:
        regions = checked(regions, lengths)
    touched = regions.withColumn("__b", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    met = touched.join(blocks.select("seqid", (F.col("block_start") / size).cast("long").alias("__b"), "block_start", "seq"), ["seqid", "__b"])
    low = F.greatest(F.col("start"), F.col("block_start")) - F.col("block_start")
    cut = F.substr("seq", (low + 1).cast("int"), (F.least(F.col("end"), F.col("block_start") + size) - F.col("block_start") - low).cast("int"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__b", cut.alias("s")))), lambda p: p["s"]), "")
    return met.groupBy(*keys).agg(parts.alias("seq"))


def fai(spark: SparkSession, path: str) -> DataFrame:
    """seqid, ord and length of a FASTA index, in file order."""
    rows = _fields(_lines(spark, path), 5)
    return rows.select(_at(0).alias("seqid"), F.col("line_no").alias("ord"), _number(1, "long").alias("length"))


def junction_bed(spark: SparkSession, path: str) -> DataFrame:
    """Junctions of BED6 with optional read counts in columns 7 and 8; the score is ignored."""
    rows = _fields(_lines(spark, path).filter(~F.col("value").startswith("track")), 6)
    reads = F.coalesce(_number(6, "int"), F.lit(1))
    return rows.select(_at(0).alias("seqid"), _number(1, "long").alias("start"), _number(2, "long").alias("end"), _at(5).alias("strand"), reads.alias("reads"), F.coalesce(_number(7, "int"), reads).alias("unique_reads"))


def star_junctions(spark: SparkSession, path: str, least_reads: int = 1, multi: bool = True) -> DataFrame:
    """Junctions of STAR's SJ.out.tab."""
    rows = _fields(_lines(spark, path), 9)
    unique = _number(6, "int")
    found = rows.select(_at(0).alias("seqid"), (_number(1, "long") - 1).alias("start"), _number(2, "long").alias("end"), F.when(_at(3) == "1", "+").when(_at(3) == "2", "-").otherwise(".").alias("strand"), (unique + _number(7, "int") if multi else unique).alias("reads"), unique.alias("unique_reads"), _number(4, "int").between(1, 6).alias("is_canonical"))
    return found.filter(F.col("reads") >= least_reads)


def junctions(spark: SparkSession, path: str) -> DataFrame:
    """BED or STAR by name, else by the first data line."""
    first = _lines(spark, path).orderBy("line_no").first()
    parts = first.value.split("\t") if first else []
    star = "SJ.out" in path or (not path.endswith((".bed", ".bed.gz")) and len(parts) == 9 and parts[3] in ("0", "1", "2"))
    return star_junctions(spark, path).select("seqid", "start", "end", "strand", "reads", "unique_reads") if star else junction_bed(spark, path)


def te_bed(spark: SparkSession, path: str) -> DataFrame:
    """Intervals with class and family from a ``Class/Family`` name."""
    rows = _fields(_lines(spark, path).filter(~F.col("value").startswith("track")), 3)
    name = F.coalesce(_at(3), F.lit("unknown"))
    return rows.select(_at(0).alias("seqid"), _number(1, "long").alias("start"), _number(2, "long").alias("end"), F.substring_index(name, "/", 1).alias("te_class"), F.when(F.instr(name, "/") > 0, F.substr(name, F.instr(name, "/") + 1, F.length(name))).otherwise(name).alias("te_family"))


HIT_FIELDS = ("query_id string", "subject_id string", "identity double", "alignment_length int", "mismatches int", "gap_opens int", "query_start int", "query_end int", "subject_start int", "subject_end int", "evalue double", "bitscore double", "query_length int", "subject_length int")


def hits(spark: SparkSession, path: str, lengths: DataFrame | None = None) -> DataFrame:
    """Tabular search hits of 12 or 14 columns; broken lines drop out, query lengths may come from a table."""
    rows = _fields(_lines(spark, path), 12)
    columns = [(_at(k) if kind == "string" else _number(k, kind)).alias(name) for k, (name, kind) in enumerate(f.split(" ") for f in HIT_FIELDS)]
    found = rows.select(F.col("line_no").alias("ord"), *columns).filter("identity IS NOT NULL AND evalue IS NOT NULL AND bitscore IS NOT NULL AND query_start IS NOT NULL AND query_end IS NOT NULL")
    if lengths is None:
        return found
    return found.join(lengths.select("query_id", F.col("length").alias("__n")), "query_id", "left").withColumn("query_length", F.coalesce("query_length", "__n")).drop("__n")


def metrics_tsv(spark: SparkSession, path: str, numbers: list[str]) -> DataFrame:
    """Table of metrics by gene; the named columns as doubles, blanks as null, the last row of a gene counts."""
    rows = spark.read.csv(path, sep="\t", header=True).withColumn("__line", F.monotonically_increasing_id())
    key = next(k for k in ("gene_id", "Gene", "gene") if k in rows.columns)
    rows = rows.withColumnRenamed(key, "gene_id")
    typed = rows.select("gene_id", "__line", *(F.nullif(F.trim(c), F.lit("")).try_cast("double").alias(c) if c in numbers else F.col(c) for c in rows.columns if c not in ("gene_id", "__line")))
    rest = [c for c in typed.columns if c not in ("gene_id", "__line")]
    return typed.groupBy("gene_id").agg(F.max_by(F.struct(*rest), "__line").alias("r")).select("gene_id", "r.*")


def sam(spark: SparkSession, path: str, least_mapq: int = 20) -> DataFrame:
    """Primary alignments of a SAM text file: name, flag, seqid, start, mapq, cigar, xs."""
    rows = _fields(spark.read.text(path).filter(~F.col("value").startswith("@")), 11)  # header lines
    cigar = F.transform(F.regexp_extract_all(_at(5), F.lit("[0-9]+[MIDNSHP=X]"), 0), lambda c: F.struct(F.substr(c, F.length(c), F.lit(1)).alias("op"), F.substr(c, F.lit(1), F.length(c) - 1).cast("long").alias("len")))
    found = rows.select(_at(0).alias("name"), _number(1, "int").alias("flag"), _at(2).alias("seqid"), (_number(3, "long") - 1).alias("start"), _number(4, "int").alias("mapq"), cigar.alias("cigar"), F.nullif(F.regexp_extract("value", "\tXS:A:([+-])", 1), F.lit("")).alias("xs"), F.regexp_extract("value", "\tNH:i:([0-9]+)", 1).try_cast("int").alias("nh"))
    return found.filter((F.col("flag").bitwiseAND(0x904) == 0) & (F.col("mapq") >= least_mapq))


def fetch(reads: DataFrame, seqid: str, start: int, end: int) -> DataFrame:
    """Alignments that touch [start, end) of a scaffold: their reference span is start plus M, =, X, D and N."""
    span = F.aggregate("cigar", F.lit(0).cast("long"), lambda n, c: n + F.when(c["op"].isin("M", "=", "X", "D", "N"), c["len"]).otherwise(0))
    return reads.filter((F.col("seqid") == seqid) & (F.col("start") < end) & (F.col("start") + span > start))


def read_introns(reads: DataFrame, least: int = 8) -> DataFrame:
    """Introns (N of at least ``least`` bases) of alignments: seqid, start, end, strand, reads, unique_reads."""
    step = lambda s, c: F.struct((s["at"] + F.when(c["op"].isin("M", "=", "X", "D", "N"), c["len"]).otherwise(0)).alias("at"), F.when((c["op"] == "N") & (c["len"] >= least), F.concat(s["found"], F.array(F.struct(s["at"].alias("start"), (s["at"] + c["len"]).alias("end"))))).otherwise(s["found"]).alias("found"))
    empty = F.struct(F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("found"))
    flag = F.col("flag")
    paired, second, minus = flag.bitwiseAND(1) > 0, flag.bitwiseAND(0x80) > 0, flag.bitwiseAND(0x10) > 0
    by_mate = F.when(paired, F.when(second == minus, "+").otherwise("-")).otherwise(".")
    found = reads.select("seqid", F.coalesce("xs", by_mate).alias("strand"), (F.coalesce("nh", F.lit(1)) == 1).alias("unique"), F.explode(F.aggregate("cigar", empty, step)["found"]).alias("i"))
    return found.groupBy("seqid", "i.start", "i.end", "strand").agg(F.count("*").alias("reads"), F.count_if("unique").alias("unique_reads"))


def aligned_blocks(reads: DataFrame) -> DataFrame:
    """Blocks of matched bases of alignments: seqid, start, end; for coverage."""
    step = lambda s, c: F.struct((s["at"] + F.when(c["op"].isin("M", "=", "X", "D", "N"), c["len"]).otherwise(0)).alias("at"), F.when(c["op"].isin("M", "=", "X"), F.concat(s["found"], F.array(F.struct(s["at"].alias("start"), (s["at"] + c["len"]).alias("end"))))).otherwise(s["found"]).alias("found"))
    empty = F.struct(F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("found"))
    return reads.select("seqid", F.explode(F.aggregate("cigar", empty, step)["found"]).alias("i")).select("seqid", "i.*")


def uniprot_dat(spark: SparkSession, path: str) -> DataFrame:
    """accession, taxon and sequence of flat-file entries."""
    rows = spark.read.text(path, lineSep="//\n").filter(F.col("value").contains("SQ   "))
    seq = F.regexp_replace(F.regexp_replace(F.substr("value", F.instr("value", "SQ   "), F.length("value")), "^[^\n]*\n", ""), r"\s", "")
    return rows.select(F.regexp_extract("value", r"(?m)^AC   (\w+);", 1).alias("accession"), F.regexp_extract("value", r"NCBI_TaxID=(\d+)", 1).alias("taxon"), seq.alias("seq"))

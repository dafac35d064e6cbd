"""Round trips through files: tables are written in an exchange format, read back and compared with their source."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import commands, storage
from ..functions import dna
from ..operators import confidence, genes, junctions, planning, visual
from ..sources import bam, interchange, readers, reports, writers
from . import annotation
from .annotation import CHUNK_SQL, GENES, HITS, hits, scaffolds
from .binding import EXONS, JUNCTIONS, Plans, exons, table
from .binding import junctions as bound_junctions
from .sequences import SEQ, sequences
from .signals import PROBS, METRIC_SQL, METRICS, as_double

PLANS = Plans()


def models(spark, sf_dir):
    """Genes and transcripts of the exon table; the note needs all four escapes."""
    rows = exons(spark, sf_dir).withColumnRenamed("gene", "gene_id")
    note = F.create_map(F.lit("Note"), F.concat(F.lit("a;b=c&d,"), F.col("gene_id").cast("string"), F.lit("%20")))
    found = rows.groupBy("gene_id", "seqid", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("exons"))
    found = found.withColumn("seqid", F.col("seqid").cast("string")).withColumn("line_no", F.col("gene_id")).withColumn("gene_id", F.concat(F.lit("g"), "gene_id")).withColumn("attributes", note)
    tx = found.withColumn("transcript_id", F.concat("gene_id", F.lit(".t1"))).withColumn("cds", F.transform("exons", lambda e, k: F.struct((e["start"] + 2).alias("start"), e["end"].alias("end"), (k % 3).alias("phase"))))
    return found.drop("exons"), tx


def written(spark, sf_dir):
    folder = storage.scratch(spark, "gff3")
    writers.write_gff3(*models(spark, sf_dir), folder)
    return folder


SPANS = EXONS + """, sp AS (SELECT gene, max(seqid) AS seqid, max(strand) AS strand, min(s) AS s, max(e) AS e, count(*) AS n, sum(e - s) AS bases FROM exons GROUP BY gene)"""


@PLANS.add(f"""WITH {SPANS} SELECT 'g' || gene AS gene_id, CAST(seqid AS VARCHAR) AS seqid, s AS start, e AS "end", strand, 'a;b=c&d,g' || gene || '%20' AS note FROM sp""")
def gff3_genes(spark, sf_dir):
    """Genes written as GFF3 and read back, escapes included."""
    found, _ = readers.gene_models(readers.gff3(spark, written(spark, sf_dir)))
    return found.select("gene_id", "seqid", "start", "end", "strand", F.col("attributes")["Note"].alias("note"))


@PLANS.add(f"""WITH {SPANS} SELECT 'g' || gene AS gene_id, 'g' || gene || '.t1' AS transcript_id, n AS n_exons, n AS n_cds, CAST(bases AS BIGINT) AS transcript_length, CAST(bases - 2 * n AS BIGINT) AS cds_length FROM sp""")
def gff3_hierarchy(spark, sf_dir):
    """Genes, transcripts, exons and segments joined again from the file."""
    _, found = readers.gene_models(readers.gff3(spark, written(spark, sf_dir)))
    return found.select("gene_id", "transcript_id", *(c.cast("long").alias(n) for n, c in genes.structure(F.col("exons"), F.col("cds")).items()))


@PLANS.add(f"""WITH {EXONS} SELECT 'exon' AS type, count(*) AS n, CAST(sum(s) AS BIGINT) AS starts, CAST(sum(e) AS BIGINT) AS ends FROM exons UNION ALL SELECT 'CDS', count(*), CAST(sum(s + 2) AS BIGINT), CAST(sum(e) AS BIGINT) FROM exons UNION ALL
SELECT unnest(['gene', 'mRNA']), count(*), CAST(sum(s) AS BIGINT), CAST(sum(e) AS BIGINT) FROM (SELECT gene, min(s) AS s, max(e) AS e FROM exons GROUP BY gene)""")
def gff3_features(spark, sf_dir):
    rows = readers.gff3(spark, written(spark, sf_dir))
    return rows.groupBy("type").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


@PLANS.add(f"WITH {SPANS} SELECT CAST(seqid AS VARCHAR) AS seqid, count(*) AS n_genes FROM sp GROUP BY seqid UNION ALL SELECT NULL, count(*) FROM sp")
def gff_statistics(spark, sf_dir):
    found, _ = readers.gene_models(readers.gff3(spark, written(spark, sf_dir)))
    return readers.gff_statistics(found)


@PLANS.add(f"WITH {SPANS} SELECT 'g' || gene AS gene_id, s AS start, n AS n_exons FROM sp WHERE gene = 7")
def gene_by_id(spark, sf_dir):
    found, tx = readers.gene_models(readers.gff3(spark, written(spark, sf_dir)))
    return readers.gene(found, "g7").join(tx.select("gene_id", F.size("exons").cast("long").alias("n_exons")), "gene_id").select("gene_id", "start", "n_exons")


@PLANS.add(f"WITH {EXONS} SELECT 'g' || gene AS gene_id, count(*) * 2 + 2 AS n_lines FROM exons WHERE gene % 3 = 0 GROUP BY gene")
def filtered_gff(spark, sf_dir):
    """Lines of the genes that a filter keeps, in the file's order."""
    lines = readers.raw_lines(spark, written(spark, sf_dir))
    keep = models(spark, sf_dir)[0].filter("line_no % 3 = 0").select("gene_id")
    kept = genes.filtered_lines(lines, keep).filter(~F.col("value").startswith("#"))
    return kept.groupBy(F.regexp_extract("value", "(g[0-9]+)", 1).alias("gene_id")).agg(F.count("*").alias("n_lines"))


@PLANS.add(f"WITH {EXONS}, n AS (SELECT count(*) * 2 + 2 * count(DISTINCT gene) AS n FROM exons) SELECT 1 AS n_version, n AS n_lines, true AS version_first FROM n")
def merged_gff(spark, sf_dir):
    """A file of several parts, with a second version line and separators, merged."""
    folder = written(spark, sf_dir)
    spark.createDataFrame([("##gff-version 3",), ("###",)], "line string").coalesce(1).write.mode("append").text(folder)
    merged = planning.merge_gff(readers.raw_lines(spark, folder))
    version = F.col("value").startswith("##gff-version")
    return merged.agg(F.count_if(version).alias("n_version"), F.count_if(~version).alias("n_lines"), F.min_by(version, "ord").alias("version_first"))


@PLANS.add(f"WITH {SEQ} SELECT 's' || doc_id AS seqid, 's' || doc_id || ' a -> b' AS description, length(seq) AS length, md5(seq) AS digest FROM d WHERE seq IS NOT NULL")
def fasta_round_trip(spark, sf_dir):
    """Records written as FASTA in lines of 60 and read back; headers hold the record mark."""
    rows = sequences(spark, sf_dir).filter("seq IS NOT NULL").select(F.concat(F.lit("s"), "doc_id", F.lit(" a -> b")).alias("seqid"), "seq")
    folder = storage.scratch(spark, "fasta")
    writers.fasta(rows).write.text(folder)
    return readers.fasta(spark, folder).select("seqid", "description", F.length("seq").cast("long").alias("length"), F.md5("seq").alias("digest"))


@PLANS.add(f"WITH {SEQ}, r AS (SELECT doc_id, seq, unnest(range(0, length(seq) - 29, 97)) AS s, doc_id % 2 = 0 AS plus FROM d) SELECT doc_id AS seqid, s AS start, CASE WHEN plus THEN substr(seq, s + 1, 30) ELSE reverse(translate(substr(seq, s + 1, 30), 'ACGT', 'TGCA')) END AS seq FROM r")
def subsequence_fetch(spark, sf_dir):
    """30 bases at every 97th of each sequence, read on a strand, checked against the lengths."""
    records = sequences(spark, sf_dir).select(F.col("doc_id").alias("seqid"), "seq").filter("length(seq) >= 30")
    lengths = readers.fasta_lengths(records)
    regions = lengths.select("seqid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 30, F.lit(97).cast("long"))).alias("start")).withColumn("end", F.col("start") + 30)
    found = readers.subsequences(regions, readers.genome_blocks(records, 1 << 10), ["seqid", "start"], 1 << 10, lengths)
    strand = F.when(F.col("seqid") % 2 == 0, "+").otherwise("-")
    return found.select("seqid", "start", dna.stranded(F.col("seq"), strand).alias("seq"))


@PLANS.add('SELECT s_name AS seqid, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, 100000 + s_suppkey * 37 AS length FROM supplier')
def fai_index(spark, sf_dir):
    rows = scaffolds(spark, sf_dir)
    line = F.concat_ws("\t", "seqid", F.col("length").cast("string"), F.lit("0"), F.lit("60"), F.lit("61"))
    folder = storage.scratch(spark, "fai")
    rows.select(line.alias("line"), "ord").coalesce(1).sortWithinPartitions("ord").select("line").write.text(folder)
    return writers.numbered(readers.fai(spark, folder), ["ord"], "place").select("seqid", "place", "length")


BED = JUNCTIONS + ", bj AS (SELECT CAST(seqid AS VARCHAR) AS seqid, s, e, strand, reads, row_number() OVER () AS o FROM junctions)"


def bed_rows(spark, sf_dir):
    return bound_junctions(spark, sf_dir).withColumn("seqid", F.col("seqid").cast("string")).withColumn("unique_reads", F.col("reads") - 1)


@PLANS.add(f"""WITH {BED} SELECT seqid, s AS start, e AS "end", strand, CAST(reads AS INTEGER) AS reads, CAST(reads - 1 AS INTEGER) AS unique_reads, count(*) AS n FROM bj GROUP BY ALL""")
def junction_bed_round_trip(spark, sf_dir):
    """Junctions written as BED with counts in columns 7 and 8, found to be BED and read back."""
    folder = storage.scratch(spark, "junctions")
    writers.junction_bed(bed_rows(spark, sf_dir)).select("line").write.text(folder)
    found = readers.junctions(spark, folder)
    return found.groupBy("seqid", "start", "end", "strand", "reads", "unique_reads").agg(F.count("*").alias("n"))


@PLANS.add(f"WITH {BED}, n AS (SELECT count(*) AS n, count(DISTINCT (seqid, s, e, strand)) AS places FROM bj) SELECT n AS n_names, n AS n_lines, true AS gapless FROM n")
def junction_names(spark, sf_dir):
    """Names of the written junctions are numbered without a gap, in the order of place."""
    rows = writers.junction_bed(bed_rows(spark, sf_dir))
    return rows.agg(F.countDistinct("k").alias("n_names"), F.count("*").alias("n_lines"), ((F.max("k") == F.count("*") - 1) & (F.min("k") == 0)).alias("gapless"))


@PLANS.add(f"""WITH {BED} SELECT seqid, s AS start, e AS "end", CASE strand WHEN '+' THEN '+' WHEN '-' THEN '-' ELSE '.' END AS strand, CAST(reads + 1 AS INTEGER) AS reads, CAST(reads AS INTEGER) AS unique_reads, count(*) AS n FROM bj WHERE reads + 1 >= 1 GROUP BY ALL""")
def star_round_trip(spark, sf_dir):
    """Junctions in the aligner's own table: 1-based, strand as a number, multi-mapped reads apart."""
    rows = bed_rows(spark, sf_dir)
    code = F.when(F.col("strand") == "+", "1").when(F.col("strand") == "-", "2").otherwise("0")
    text = lambda c: c.cast("string")
    line = F.concat_ws("\t", "seqid", text(F.col("start") + 1), text(F.col("end")), code, F.lit("1"), F.lit("1"), text(F.col("reads")), F.lit("1"), F.lit("30"))
    folder = storage.scratch(spark, "SJ.out.tab")
    rows.select(line.alias("line")).write.text(folder)
    found = readers.junctions(spark, folder)
    return found.groupBy("seqid", "start", "end", "strand", "reads", "unique_reads").agg(F.count("*").alias("n"))


@PLANS.add(f"WITH {HITS} SELECT query_id, count(*) AS n, CAST(sum(query_start) AS BIGINT) AS starts, round(sum(identity), 4) AS identity, round(min(evalue), 6) AS evalue, max(query_length) AS query_length FROM (SELECT query_id, query_start, CAST(identity AS DOUBLE) AS identity, evalue, CAST(query_length AS INTEGER) AS query_length FROM h) GROUP BY query_id")
def tabular_hits(spark, sf_dir):
    """Search hits in twelve columns with comments and broken lines; lengths come from a table."""
    rows = hits(spark, sf_dir)
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c
    cells = [text("query_id"), text("subject_id"), text("identity"), F.lit("40"), F.lit("1"), F.lit("0"), text("query_start"), text("query_end"), text("subject_start"), text("subject_end"), text("evalue"), F.lit("55.5")]
    folder = storage.scratch(spark, "hits")
    rows.select(F.concat_ws("\t", *cells).alias("line")).write.text(folder)
    spark.createDataFrame([("# a comment",), ("too\tfew",), ("",), ("\t".join(["x"] * 12),)], "line string").write.mode("append").text(folder)
    lengths = rows.select(F.col("query_id").cast("string").alias("query_id"), F.col("query_length").cast("int").alias("length")).distinct()
    found = readers.hits(spark, folder, lengths)
    return found.groupBy(F.col("query_id").cast("long").alias("query_id")).agg(F.count("*").alias("n"), F.sum("query_start").alias("starts"), F.round(F.sum("identity"), 4).alias("identity"), F.round(F.min("evalue"), 6).alias("evalue"), F.max("query_length").alias("query_length"))


@PLANS.add("""SELECT CAST(o_orderkey % 5 AS VARCHAR) AS seqid, o_orderkey * 1000 AS start, o_orderkey * 1000 + 300 AS "end", CASE WHEN o_orderkey % 2 = 0 THEN 'LTR' ELSE 'DNA' || o_orderkey % 3 END AS te_class, CASE WHEN o_orderkey % 2 = 0 THEN 'Gypsy' ELSE 'DNA' || o_orderkey % 3 END AS te_family FROM orders""")
def te_bed_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    line = F.expr("concat_ws('\t', o_orderkey % 5, o_orderkey * 1000, o_orderkey * 1000 + 300, if(o_orderkey % 2 = 0, 'LTR/Gypsy', concat('DNA', o_orderkey % 3)))")
    folder = storage.scratch(spark, "te")
    rows.select(line.alias("line")).write.text(folder)
    spark.createDataFrame([("track name=x",), ("#note",)], "line string").write.mode("append").text(folder)
    return readers.te_bed(spark, folder).select("seqid", "start", "end", "te_class", "te_family")


@PLANS.add(f"""WITH {GENES} SELECT CAST(gene AS VARCHAR) AS gene_id, CASE WHEN conf IS NULL THEN NULL WHEN gene % 4 = 0 THEN 'int' WHEN gene % 4 = 1 THEN 'string' ELSE 'float' END AS kind, CASE WHEN conf IS NULL OR gene % 4 = 1 THEN NULL WHEN gene % 4 = 0 THEN floor(conf * 100) ELSE round(conf, 2) END AS value FROM g""")
def metric_table(spark, sf_dir):
    """A metric table whose cells are blank, whole numbers, texts like 1e-05 or decimals; of repeated genes the last counts."""
    rows = annotation.genes(spark, sf_dir).select(F.col("gene").alias("gene_id"), F.col("confidence_score").alias("conf"))
    value = F.when(F.col("conf").isNull(), "").when(F.col("gene_id") % 4 == 0, F.floor(F.col("conf") * 100).cast("string")).when(F.col("gene_id") % 4 == 1, "1e-05").otherwise(F.format_string("%.2f", "conf"))
    folder = storage.scratch(spark, "metrics")
    both = rows.select("gene_id", F.explode(F.array(F.lit("0.5"), value)).alias("score"))
    both.coalesce(1).write.csv(folder, sep="\t", header=True, emptyValue="", quote="")
    return interchange.metrics(spark, folder).select("gene_id", "score.kind", F.col("score.number").alias("value"))


@PLANS.add(f"""WITH {GENES} SELECT CAST(gene AS VARCHAR) AS gene_id, tier, array_to_string(flags, ',') AS flags, round(conf, 4) AS confidence_score, round(splice, 4) AS splice_score, round(hom, 4) AS homology_score FROM g""")
def qc_table_round_trip(spark, sf_dir):
    """The aggregated quality table written and read back."""
    rows = annotation.genes(spark, sf_dir).withColumnsRenamed({"gene": "gene_id", "aed": "combined_aed"})
    folder = storage.scratch(spark, "qc")
    writers.tsv(reports.qc_report(rows), folder, ["gene_id"])
    return interchange.qc_table(spark, folder).select("gene_id", "tier", F.array_join("flags", ",").alias("flags"), "confidence_score", "splice_score", "homology_score")


@PLANS.add(f"WITH {GENES} SELECT tier, count(*) AS n, CAST(sum(gene) AS BIGINT) AS total FROM g GROUP BY tier")
def tier_lists(spark, sf_dir):
    """Lists of gene ids in a folder a tier, read back."""
    folder = storage.scratch(spark, "tiers")
    writers.tier_lists(annotation.genes(spark, sf_dir).withColumnRenamed("gene", "gene_id"), folder)
    found = spark.read.option("basePath", folder).text(folder)
    return found.groupBy("tier").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


@PLANS.add(f"""WITH {CHUNK_SQL} SELECT chunk_id, seqid, start, "end", row_number() OVER (ORDER BY chunk_id) - 1 AS place FROM ck""")
def chunk_plan_round_trip(spark, sf_dir):
    folder = storage.scratch(spark, "plan")
    interchange.write_plan(planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000), folder, "size", {"chunk_size": 30000})
    return interchange.read_plan(spark, folder)


@PLANS.add(f"""WITH {CHUNK_SQL} SELECT chunk_id, 'run --region ' || seqid || ':' || (start + 1) || '-' || "end" || ' -n ' || ("end" - start) || ' -o out/' || chunk_id || ' > logs/' || chunk_id || '.log 2>&1' AS command, ("end" - start) * 20 AS memory FROM ck""")
def task_commands(spark, sf_dir):
    chunks = planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000)
    found = planning.commands(chunks, "run --region {seqid}:{start}-{end} -n {size} -o {output_dir}/{chunk_id}", {"output_dir": "out"}, "logs")
    return found.join(chunks.select("chunk_id", planning.memory_bytes(F.col("start"), F.col("end")).alias("memory")), "chunk_id")


@PLANS.add(f"WITH {CHUNK_SQL} SELECT chunk_id, 'bash run.sh ' || chunk_id AS command FROM ck")
def wrapped_commands(spark, sf_dir):
    return planning.wrapped_commands(planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000), "run.sh")


@PLANS.add("""SELECT DISTINCT o_orderkey AS k, CAST(CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 64) * 1024 WHEN 1 THEN o_orderkey WHEN 2 THEN o_orderkey // 1024 ELSE NULL END AS BIGINT) AS mb FROM orders""")
def memory_strings(spark, sf_dir):
    text = F.expr("CASE o_orderkey % 4 WHEN 0 THEN concat(o_orderkey % 64, 'G') WHEN 1 THEN concat(o_orderkey, 'M') WHEN 2 THEN concat(' ', o_orderkey, 'k') ELSE concat('x', o_orderkey) END")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), planning.memory_mb(text).alias("mb")).distinct()


@PLANS.add(f"WITH {SEQ} SELECT 'P' || doc_id AS seqid, 'P' || doc_id || ' OX=' || doc_id % 7 AS description, md5(seq) AS digest FROM d WHERE seq IS NOT NULL AND doc_id % 7 IN (2, 3)")
def uniprot_subset(spark, sf_dir):
    """Flat-file entries of two taxa turned into FASTA records."""
    rows = sequences(spark, sf_dir).filter("seq IS NOT NULL")
    body = F.regexp_replace("seq", "(.{10})", "$1 ")
    entry = F.concat(F.lit("ID   X\nAC   P"), "doc_id", F.lit(";\nOX   NCBI_TaxID="), F.col("doc_id") % 7, F.lit(";\nSQ   SEQUENCE\n     "), body, F.lit("\n//"))
    folder = storage.scratch(spark, "uniprot") + ".dat"
    rows.select(entry.alias("entry")).write.text(folder)
    found = interchange.database_records(spark, folder, ["2", "3"])
    return found.select("seqid", "description", F.md5("seq").alias("digest"))


@PLANS.add(f"WITH {SEQ} SELECT DISTINCT 's' || doc_id AS seqid FROM d WHERE doc_id IN (SELECT o_orderkey FROM orders)")
def fasta_subset(spark, sf_dir):
    records = sequences(spark, sf_dir).select(F.concat(F.lit("s"), "doc_id").alias("seqid"), "seq")
    ids = table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), "o_orderkey").alias("seqid"))
    return genes.subset(records, ids).select("seqid").distinct()


def reads(spark, sf_dir):
    """Alignments as SAM text: two blocks with an intron between them, some filtered, some unstranded, some short."""
    rows = table(spark, sf_dir, "orders")
    flag = "CASE WHEN o_orderkey % 13 = 0 THEN 4 WHEN o_orderkey % 17 = 0 THEN 256 WHEN o_orderkey % 3 = 0 THEN 16 ELSE 0 END"
    cigar = "concat(10 + o_orderkey % 5, 'M2I', CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 50 END, 'N20M1D4M')"
    line = f"concat_ws('\t', concat('r', o_orderkey), {flag}, concat('chr', o_custkey % 7), o_custkey % 200 + 1, CASE WHEN o_orderkey % 19 = 0 THEN 5 ELSE 60 END, {cigar}, '*', '0', '0', '*', '*', concat('NH:i:', 1 + o_orderkey % 2), CASE WHEN o_orderkey % 5 > 0 THEN concat('XS:A:', CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END) END)"
    folder = storage.scratch(spark, "sam")
    rows.select(F.expr(line).alias("line")).write.text(folder)
    spark.createDataFrame([("@HD\tVN:1.6",)], "line string").write.mode("append").text(folder)
    return readers.sam(spark, folder)


READS = """r0 AS (SELECT o_orderkey AS k, 'chr' || o_custkey % 7 AS seqid, o_custkey % 200 AS s, 10 + o_orderkey % 5 AS m, CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 50 END AS n FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0),
iv AS (SELECT seqid, s + m AS start, s + m + n AS "end", CASE WHEN k % 5 = 0 THEN '.' WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand, k % 2 = 0 AS uniq FROM r0 WHERE n >= 8),
bl AS (SELECT seqid, s AS bs, s + m AS be FROM r0 UNION ALL SELECT seqid, s + m + n, s + m + n + 20 FROM r0 UNION ALL SELECT seqid, s + m + n + 21, s + m + n + 25 FROM r0)"""


@PLANS.add(f"""WITH {READS} SELECT seqid, start, "end", strand, count(*) AS reads, count(*) FILTER (uniq) AS unique_reads FROM iv GROUP BY ALL""")
def sam_introns(spark, sf_dir):
    """Introns of filtered alignments, walked along their CIGAR strings."""
    return readers.read_introns(reads(spark, sf_dir))


@PLANS.add(f"""WITH {READS}, c AS (SELECT seqid, start, "end", strand, count(*) AS n FROM iv GROUP BY ALL), t AS (SELECT seqid, start, "end", CAST(sum(n) AS BIGINT) AS read_count, arg_min(strand, (-n, strand)) AS strand FROM c GROUP BY ALL) SELECT * FROM t WHERE read_count >= 3""")
def sam_junctions(spark, sf_dir):
    """Junctions over all scaffolds with their majority strand and at least three reads."""
    return junctions.majority_strand(readers.read_introns(reads(spark, sf_dir))).filter("read_count >= 3")


@PLANS.add(f"WITH {READS} SELECT seqid, bs AS start, be AS \"end\", count(*) AS n FROM bl GROUP BY ALL")
def sam_blocks(spark, sf_dir):
    return readers.aligned_blocks(reads(spark, sf_dir)).groupBy("seqid", "start", "end").agg(F.count("*").alias("n"))


@PLANS.add(f"WITH {READS} SELECT 'r' || k AS name, s AS start FROM r0 WHERE seqid = 'chr3' AND s < 150 AND s + m + n + 25 > 100")
def sam_fetch(spark, sf_dir):
    """Alignments that touch 50 bases of a scaffold."""
    return readers.fetch(reads(spark, sf_dir), "chr3", 100, 150).select("name", "start")


def bam_reads(spark, sf_dir):
    """The alignments of ``reads`` as BAM files, read in ranges of 8 KB."""
    flag = "CASE WHEN o_orderkey % 13 = 0 THEN 4 WHEN o_orderkey % 17 = 0 THEN 256 WHEN o_orderkey % 3 = 0 THEN 16 ELSE 0 END"
    parts = ["M", "10 + o_orderkey % 5"], ["I", "2"], ["N", "CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 50 END"], ["M", "20"], ["D", "1"], ["M", "4"]
    cigar = "array(" + ", ".join(f"named_struct('op', '{op}', 'len', CAST({n} AS BIGINT))" for op, n in parts) + ")"
    strand = "CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END END"
    rows = table(spark, sf_dir, "orders").selectExpr("concat('r', o_orderkey) AS name", f"CAST({flag} AS INT) AS flag", "concat('chr', o_custkey % 7) AS seqid", "CAST(o_custkey % 200 AS BIGINT) AS start", "CASE WHEN o_orderkey % 19 = 0 THEN 5 ELSE 60 END AS mapq", f"{cigar} AS cigar", f"{strand} AS xs", "CAST(1 + o_orderkey % 2 AS INT) AS nh")
    folder = storage.scratch(spark, "bam")
    bam.write_bam(rows, {f"chr{k}": 1000 for k in range(7)}, folder)
    return bam.bam(spark, f"{folder}/*.bam", range_bytes=8192)


@PLANS.add(f"""WITH {READS} SELECT seqid, start, "end", strand, count(*) AS reads, count(*) FILTER (uniq) AS unique_reads FROM iv GROUP BY ALL""")
def bam_introns(spark, sf_dir):
    """Introns of the alignments in BAM files."""
    return readers.read_introns(bam_reads(spark, sf_dir))


@PLANS.add(f"WITH {READS} SELECT 'r' || k AS name, s AS start FROM r0 WHERE seqid = 'chr3' AND s < 150 AND s + m + n + 25 > 100")
def bam_fetch(spark, sf_dir):
    """Alignments in BAM files that touch 50 bases of a scaffold."""
    return readers.fetch(bam_reads(spark, sf_dir), "chr3", 100, 150).select("name", "start")


CONF = f"""m AS (SELECT o_orderkey AS gene, o_orderkey % 7 AS seqid, o_orderkey * 100 AS s, o_orderkey * 100 + 80 AS e, {METRIC_SQL} FROM orders), cb AS (SELECT *, 0.30::DOUBLE * mean_prob + 0.20::DOUBLE * min_prob + 0.20::DOUBLE * boundary_sharpness + 0.15::DOUBLE * coding_consistency + 0.15::DOUBLE * worst_exon_score AS score FROM m), cc AS (SELECT *, CASE WHEN score >= 0.85::DOUBLE THEN 'high' WHEN score >= 0.7::DOUBLE THEN 'medium' ELSE 'low' END AS class FROM cb)"""


def scores(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene_id", "o_orderkey % 7 AS seqid", "o_orderkey * 100 AS start", "o_orderkey * 100 + 80 AS end", "'+' AS strand", *(f"{as_double(e)} AS {k}" for k, e in METRICS.items()))
    score = F.col("overall_score")
    return rows.withColumn("overall_score", confidence.overall()).withColumn("confidence_class", F.when(score >= 0.85, "high").when(score >= 0.7, "medium").otherwise("low"))


@PLANS.add(f"WITH {CONF} SELECT gene AS gene_id, CAST(least(1000, floor(score * 1000)) AS BIGINT) AS bed_score, CASE class WHEN 'high' THEN '0,150,0' WHEN 'medium' THEN '255,200,0' ELSE '200,0,0' END AS colour, s AS start FROM cc")
def confidence_bed(spark, sf_dir):
    """A browser track of scores, written below its track line and read back."""
    folder = storage.scratch(spark, "bed")
    writers.write_track(writers.confidence_bed(scores(spark, sf_dir)), folder)
    rows = spark.read.text(folder).filter(~F.col("value").startswith("track")).select(F.split("value", "\t").alias("f"))
    return rows.select(F.col("f")[3].cast("long").alias("gene_id"), F.col("f")[4].cast("long").alias("bed_score"), F.col("f")[8].alias("colour"), F.col("f")[1].cast("long").alias("start"))


@PLANS.add(f"WITH {CONF} SELECT class AS confidence_class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM cc GROUP BY class")
def class_shares(spark, sf_dir):
    return visual.class_shares(scores(spark, sf_dir)).select("confidence_class", "n", F.round("share", 6).alias("share"))


@PLANS.add(f"""WITH {CONF}, b AS (SELECT CAST(least(29, floor(score * 30)) AS INTEGER) AS bin FROM cc WHERE score BETWEEN 0 AND 1) SELECT CAST(k AS INTEGER) AS bin, count(bin) AS n FROM (SELECT unnest(range(0, 30)) AS k) LEFT JOIN b ON bin = k GROUP BY k""")
def score_distribution(spark, sf_dir):
    return visual.score_distribution(scores(spark, sf_dir))


@PLANS.add(f"WITH {CONF} SELECT count(score) AS n, round(avg(score), 6) AS mean, round(median(score), 6) AS median, round(stddev_pop(score), 6) AS deviation FROM cc")
def score_statistics(spark, sf_dir):
    return visual.score_statistics(scores(spark, sf_dir)).select("n", *(F.round(c, 6).alias(c) for c in ("mean", "median", "deviation")))


@PLANS.add(f"WITH {CONF} SELECT seqid, count(*) AS n, round(min(score), 6) AS low, round(quantile_cont(score, 0.25), 6) AS q1, round(median(score), 6) AS median, round(quantile_cont(score, 0.75), 6) AS q3, round(max(score), 6) AS high, round(avg(score), 6) AS mean FROM cc GROUP BY seqid")
def scaffold_boxes(spark, sf_dir):
    return visual.boxes(scores(spark, sf_dir)).select("seqid", "n", *(F.round(c, 6).alias(c) for c in ("low", "q1", "median", "q3", "high", "mean")))


PANELS = " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS v, score FROM cc" for m in METRICS)


@PLANS.add(f"WITH {CONF}, x AS ({PANELS}) SELECT metric, count(v) AS n, round(avg(v), 6) AS mean, round(min(v), 6) AS low, round(max(v), 6) AS high, round(corr(v, score), 6) AS correlation FROM x GROUP BY metric")
def metric_panels(spark, sf_dir):
    return visual.metric_panels(scores(spark, sf_dir), list(METRICS)).select("metric", "n", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high", "correlation")))


@PLANS.add(f"WITH {CONF} SELECT gene AS gene_id, round(score, 6) AS overall_score, CASE WHEN score >= 0.85::DOUBLE THEN '#27ae60' WHEN score >= 0.7::DOUBLE THEN '#f39c12' ELSE '#e74c3c' END AS colour FROM cc ORDER BY cc.score, gene LIMIT 20")
def lowest_genes(spark, sf_dir):
    return visual.lowest(scores(spark, sf_dir), 20).select("gene_id", F.round("overall_score", 6).alias("overall_score"), visual.colour(F.col("overall_score")).alias("colour"))


@PLANS.add(f"WITH {CONF} SELECT gene AS gene_id, round(0.6::DOUBLE * mean_prob + 0.4::DOUBLE * min_prob, 6) AS overall_score FROM cc")
def custom_weights(spark, sf_dir):
    """Scores by weights of the caller."""
    rows = scores(spark, sf_dir).withColumn("overall_score", confidence.overall(weights={"mean_prob": 0.6, "min_prob": 0.4}))
    return rows.select("gene_id", F.round("overall_score", 6).alias("overall_score"))


@PLANS.add(f"WITH {PROBS} SELECT label, round(avg(-list_sum(list_transform(probs, lambda x: greatest(x, 1e-10) * log2(greatest(x, 1e-10))))), 6) AS mean_entropy, round(avg(list_max(probs)), 6) AS mean_confidence FROM p GROUP BY label")
def region_means(spark, sf_dir):
    from .signals import probabilities

    return confidence.region_means(probabilities(spark, sf_dir), ["label"]).select("label", F.round("mean_entropy", 6).alias("mean_entropy"), F.round("mean_confidence", 6).alias("mean_confidence"))


@PLANS.add(f"""WITH {JUNCTIONS}, sp AS (SELECT DISTINCT gene FROM exons), i AS (SELECT gene, count(*) AS n_introns FROM introns GROUP BY gene) SELECT 'g' || sp.gene AS gene_id, coalesce(n_introns, 0) AS n_introns FROM sp LEFT JOIN i USING (gene)""")
def evidence_command(spark, sf_dir):
    """The evidence job from files to files, its report read back."""
    folder = storage.scratch(spark, "job")
    writers.junction_bed(bed_rows(spark, sf_dir)).select("line").write.text(f"{folder}/junctions.bed")
    commands.run_evidence(spark, written(spark, sf_dir), f"{folder}/out", f"{folder}/junctions.bed")
    return interchange.evidence_table(spark, f"{folder}/out/report.tsv").select("gene_id", F.col("n_introns").cast("long").alias("n_introns"))


@PLANS.add(f"""WITH {GENES} SELECT CAST(gene AS VARCHAR) AS gene_id FROM g WHERE NOT list_contains(flags, 'UNSUP_JUNCTION')""")
def filter_command(spark, sf_dir):
    """The filter job on a written quality table: ids of the genes that pass."""
    folder = storage.scratch(spark, "filter")
    writers.tsv(reports.qc_report(annotation.genes(spark, sf_dir).withColumnsRenamed({"gene": "gene_id", "aed": "combined_aed"})), f"{folder}/qc", ["gene_id"])
    commands.qc_filter(spark, f"{folder}/qc", "has_rnaseq_support", f"{folder}/out")
    return spark.read.text(f"{folder}/out/genes").withColumnRenamed("value", "gene_id")


@PLANS.add("SELECT s_name AS seqid, 0 AS start, 50 + s_suppkey AS \"end\", 'x ' || s_name || ':1-' || (50 + s_suppkey) AS command FROM supplier")
def plan_command(spark, sf_dir):
    """A plan by scaffold of a written genome, and the tasks made from it."""
    folder = storage.scratch(spark, "plan-job")
    records = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("seqid"), F.expr("repeat('A', CAST(50 + s_suppkey AS INT))").alias("seq"))
    writers.fasta(records).write.text(f"{folder}/genome.fa")
    commands.plan(spark, f"{folder}/genome.fa", f"{folder}/plan")
    found = commands.tasks(spark, f"{folder}/plan", "x {seqid}:{start}-{end}", f"{folder}/tasks")
    return interchange.read_plan(spark, f"{folder}/plan").join(found, "chunk_id").select("seqid", "start", "end", "command")

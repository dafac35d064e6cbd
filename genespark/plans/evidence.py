"""Junction support, coverage and interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import runs
from ..operators import evidence, intervals, junctions
from .binding import BLOCKS, EXONS, INTRONS, JUNCTIONS, Plans, blocks, exons, gene_introns, table
from .binding import junctions as bound_junctions

PLANS = Plans()
INTRON_KEY = ["seqid", "gene", "strand", "intron_start", "intron_end"]


@PLANS.add(f"WITH {INTRONS} SELECT * FROM introns")
def introns_from_exons(spark, sf_dir):
    return gene_introns(spark, sf_dir)


@PLANS.add(f"WITH {JUNCTIONS} SELECT i.*, j.reads AS junction_reads FROM introns i LEFT JOIN junctions j ON i.seqid = j.seqid AND i.intron_start = j.s AND i.intron_end = j.e")
def exact_junction_join(spark, sf_dir):
    return junctions.exact(gene_introns(spark, sf_dir), bound_junctions(spark, sf_dir)).select(*INTRON_KEY, "junction_reads")


@PLANS.add(f"""WITH {JUNCTIONS} SELECT i.seqid, gene, i.strand, intron_start, intron_end, j.s AS junction_start, j.e AS junction_end, j.strand AS junction_strand, j.reads AS junction_reads
FROM introns i JOIN junctions j ON i.seqid = j.seqid AND abs(intron_start - j.s) <= 15 AND abs(intron_end - j.e) <= 15 AND (j.strand = i.strand OR j.strand = '.') AND j.reads >= 3""")
def band_junction_join(spark, sf_dir):
    return junctions.nearby(gene_introns(spark, sf_dir), bound_junctions(spark, sf_dir), 15, 3)


NEAREST = JUNCTIONS + """,
pairs AS (SELECT i.*, abs(intron_start - j.s) + abs(intron_end - j.e) AS shift, j.s AS junction_start, j.e AS junction_end, j.reads AS junction_reads,
  row_number() OVER (PARTITION BY i.gene, intron_start ORDER BY abs(intron_start - j.s) + abs(intron_end - j.e), j.s, j.e, j.reads) AS r
  FROM introns i JOIN junctions j ON i.seqid = j.seqid AND abs(intron_start - j.s) <= 10 AND abs(intron_end - j.e) <= 10),
matched AS (SELECT i.*, p.shift, p.junction_start, p.junction_end, p.junction_reads FROM introns i LEFT JOIN pairs p ON p.r = 1 AND p.gene = i.gene AND p.intron_start = i.intron_start)"""


@PLANS.add(f"WITH {NEAREST} SELECT * FROM matched")
def nearest_junction(spark, sf_dir):
    return junctions.nearest(gene_introns(spark, sf_dir), bound_junctions(spark, sf_dir), 10, INTRON_KEY)


SUPPORT = NEAREST + """,
n AS (SELECT gene, count(*) AS n_introns, count(*) FILTER (junction_reads >= 3) AS n_supported, count(*) FILTER (shift = 0) AS n_exact FROM matched GROUP BY gene),
support AS (SELECT *, round(n_supported / n_introns, 6) AS junction_ratio FROM n),
levels AS (SELECT *, round(least(1.0, greatest(0.0, 0.5 * (1.0 - junction_ratio) + 0.3 + 0.2)), 6) AS aed,
  CASE WHEN junction_ratio >= 0.8 THEN 'partial' WHEN junction_ratio > 0 THEN 'minimal' ELSE 'none' END AS evidence_level FROM support)"""


@PLANS.add(f"WITH {SUPPORT} SELECT gene, n_introns, n_supported, n_exact, junction_ratio, CAST(aed AS DOUBLE) AS aed, evidence_level FROM levels")
def junction_support_aed(spark, sf_dir):
    matched = junctions.nearest(gene_introns(spark, sf_dir), bound_junctions(spark, sf_dir), 10, INTRON_KEY)
    return evidence.gene_support(matched, ["gene"])


@PLANS.add(f"WITH {SUPPORT} SELECT evidence_level, count(*) AS n_genes, CAST(round(avg(aed), 6) AS DOUBLE) AS mean_aed, CAST(round(median(aed), 6) AS DOUBLE) AS median_aed FROM levels GROUP BY evidence_level")
def evidence_level_counts(spark, sf_dir):
    return junction_support_aed(spark, sf_dir).groupBy("evidence_level").agg(F.count("*").alias("n_genes"), F.round(F.avg("aed"), 6).alias("mean_aed"), F.round(F.median("aed"), 6).alias("median_aed"))


@PLANS.add(f"WITH {SUPPORT} SELECT CAST(sum(n_introns) AS BIGINT) AS n_introns, CAST(sum(n_supported) AS BIGINT) AS n_supported, round(sum(n_supported) / sum(n_introns), 6) AS support_rate, count(*) FILTER (n_supported = n_introns) AS n_fully_supported FROM levels")
def support_summary(spark, sf_dir):
    return junction_support_aed(spark, sf_dir).agg(F.sum("n_introns").alias("n_introns"), F.sum("n_supported").alias("n_supported"), F.round(F.sum("n_supported") / F.sum("n_introns"), 6).alias("support_rate"), F.count_if(F.col("n_supported") == F.col("n_introns")).alias("n_fully_supported"))


def sample_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr("l_partkey % 5 AS seqid", "(l_partkey % 997) * 10 AS start", "(l_partkey % 997) * 10 + 50 AS end", "CASE WHEN l_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand", "l_suppkey % 4 AS sample", "floor(l_quantity) AS reads")


SAMPLES = """c AS (SELECT l_partkey % 5 AS seqid, (l_partkey % 997) * 10 AS start, (l_partkey % 997) * 10 + 50 AS "end", CASE WHEN l_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_suppkey % 4 AS sample, CAST(floor(l_quantity) AS BIGINT) AS reads FROM lineitem),
st AS (SELECT seqid, start, "end", strand, CAST(sum(reads) AS BIGINT) AS n FROM c GROUP BY ALL),
mj AS (SELECT seqid, start, "end", CAST(sum(n) AS BIGINT) AS read_count, arg_min(strand, (-n, strand)) AS strand FROM st GROUP BY ALL)"""


@PLANS.add(f"WITH {SAMPLES} SELECT * FROM mj")
def majority_strand(spark, sf_dir):
    return junctions.majority_strand(sample_counts(spark, sf_dir))


@PLANS.add(f"""WITH {SAMPLES}, ps AS (SELECT seqid, start, "end", sample, sum(reads) AS n FROM c GROUP BY ALL),
t AS (SELECT seqid, start, "end", CAST(sum(n) AS BIGINT) AS total_reads, count(*) FILTER (n >= 100) AS n_samples FROM ps GROUP BY ALL)
SELECT t.*, strand FROM t JOIN mj USING (seqid, start, "end") WHERE n_samples >= 2""")
def multi_sample_junctions(spark, sf_dir):
    return junctions.multi_sample(sample_counts(spark, sf_dir), 100, 2)


RUNS = BLOCKS + """,
ev AS (SELECT seqid, pos, sum(d) AS d FROM (SELECT seqid, s AS pos, 1 AS d FROM blocks UNION ALL SELECT seqid, e, -1 FROM blocks) GROUP BY ALL),
runs AS (SELECT seqid, pos AS start, lead(pos) OVER w AS "end", CAST(sum(d) OVER w AS BIGINT) AS depth FROM ev WINDOW w AS (PARTITION BY seqid ORDER BY pos))"""


@PLANS.add(f"WITH {RUNS} SELECT * FROM runs WHERE depth > 0")
def sweep_coverage(spark, sf_dir):
    return intervals.coverage_runs(blocks(spark, sf_dir), ["seqid"])


@PLANS.add(f"""WITH {RUNS} SELECT seqid, round(sum(depth * ("end" - start)) / sum("end" - start), 6) AS mean_depth, max(depth) AS max_depth, min(depth) AS min_depth FROM runs WHERE depth > 0 GROUP BY seqid""")
def coverage_summary(spark, sf_dir):
    return intervals.run_stats(intervals.coverage_runs(blocks(spark, sf_dir), ["seqid"]), ["seqid"]).withColumn("mean_depth", F.round("mean_depth", 6))


@PLANS.add("""SELECT l_orderkey AS gene, round(avg(l_quantity), 6) AS mean_depth, round(median(l_quantity), 6) AS median_depth, min(l_quantity) AS min_depth, max(l_quantity) AS max_depth,
round(count(*) FILTER (l_quantity >= 5) / count(*), 6) AS covered, round(stddev_pop(l_quantity) / avg(l_quantity), 6) AS variation FROM lineitem GROUP BY l_orderkey""")
def coverage_exon_stats(spark, sf_dir):
    return evidence.exon_stats(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "gene"), ["gene"], "l_quantity")


MERGED = BLOCKS + """,
m1 AS (SELECT *, max(e) OVER (PARTITION BY seqid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM blocks),
m2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m1),
merged AS (SELECT seqid, min(s) AS start, max(e) AS "end" FROM m2 GROUP BY seqid, island)"""


@PLANS.add(f"WITH {MERGED} SELECT * FROM merged")
def interval_merge(spark, sf_dir):
    return intervals.merge(blocks(spark, sf_dir), ["seqid"])


@PLANS.add(f"""WITH {MERGED} SELECT seqid, round(sum(greatest(0, least("end", 30000) - greatest(start, 1000))) / 29000.0, 6) AS fraction FROM merged GROUP BY seqid""")
def interval_coverage_fraction(spark, sf_dir):
    return intervals.coverage_fraction(blocks(spark, sf_dir), ["seqid"], 1000, 30000).withColumn("fraction", F.round("fraction", 6))


@PLANS.add(f"""WITH {EXONS}, genes AS (SELECT seqid, gene, min(s) AS gs, max(e) AS ge FROM exons GROUP BY ALL),
te AS (SELECT o_orderkey % 5 AS seqid, o_orderkey * 1000 + 200 AS s, o_orderkey * 1000 + 201 + CAST(floor(o_totalprice / 500) AS BIGINT) AS e FROM orders)
SELECT gene, round(least(1.0, sum(least(ge, e) - greatest(gs, s)) / any_value(ge - gs)), 6) AS te_fraction FROM genes JOIN te ON genes.seqid = te.seqid AND gs < e AND s < ge GROUP BY gene""")
def overlap_te_fraction(spark, sf_dir):
    genes = exons(spark, sf_dir).groupBy("seqid", "gene").agg(F.min("start").alias("gs"), F.max("end").alias("ge"))
    te = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 5 AS seqid", "o_orderkey * 1000 + 200 AS ts", "o_orderkey * 1000 + 201 + floor(o_totalprice / 500) AS te")
    met = intervals.overlap_join(genes, te, ["seqid"], ("gs", "ge"), ("ts", "te"))
    share = F.least(F.lit(1.0), F.sum(intervals.overlap_length(F.col("gs"), F.col("ge"), F.col("ts"), F.col("te"))) / F.first(F.col("ge") - F.col("gs")))
    return met.groupBy("gene").agg(F.round(share, 6).alias("te_fraction"))


def gene_tables(spark, sf_dir):
    """Genes, one transcript each, and aligned blocks: gene % 8 of them at every exon, each cut a little further."""
    rows = exons(spark, sf_dir).filter("gene IS NOT NULL").withColumnRenamed("gene", "gene_id")
    spans = rows.groupBy("gene_id", "seqid", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("exons"))
    transcripts = spans.withColumns({"line_no": F.lit(0).cast("long"), "transcript_id": F.col("gene_id").cast("string"), "cds": F.array().cast("array<struct<start:bigint,end:bigint,phase:int>>")})
    # No other condition on gene_id alone: below the window of exons it would make their shuffle another one than that of the transcripts.
    copies = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(7)))).filter(F.col("k") <= F.coalesce(F.col("gene_id") % 8, F.lit(0)))
    return spans.drop("exons"), transcripts, copies.selectExpr("seqid", "strand", "start + 2 * k AS start", "end + k AS end")


@PLANS.add(f"""WITH {NEAREST}, i AS (SELECT gene, count(*) AS n_introns, count(*) FILTER (junction_reads >= 3) AS n_supported, count(*) FILTER (shift = 0) AS n_exact FROM matched GROUP BY gene),
cp AS (SELECT gene, s, e, unnest(range(1, gene % 8 + 1)) AS k FROM exons), bl AS (SELECT gene, p, count(*) AS n FROM (SELECT gene, unnest(range(s + 2 * k, e + k)) AS p FROM cp) GROUP BY ALL),
d AS (SELECT gene, rn, unnest(range(s, e)) AS p FROM exons), dp AS (SELECT d.gene, rn, coalesce(n, 0) AS depth FROM d LEFT JOIN bl ON bl.gene = d.gene AND bl.p = d.p),
es AS (SELECT gene, rn, avg(depth) AS mean, median(depth) AS med, min(depth) AS low FROM dp GROUP BY gene, rn),
y AS (SELECT gene, count(*) AS n_exons, count(*) FILTER (med >= 5) AS n_expressed, avg(mean) AS coverage, arg_min(low, rn) >= 5 AS a, arg_max(low, rn) >= 5 AS b FROM es GROUP BY gene),
z AS (SELECT y.gene, strand, coalesce(n_introns, 0) AS n_introns, coalesce(n_supported, 0) AS n_supported, coalesce(n_exact, 0) AS n_exact, n_exons, n_expressed, coverage, CASE WHEN strand = '+' THEN a ELSE b END AS at_start, CASE WHEN strand = '+' THEN b ELSE a END AS at_stop,
 CASE WHEN n_introns > 0 THEN n_supported / n_introns ELSE 1.0 END AS jr, n_expressed / n_exons AS er FROM y JOIN (SELECT DISTINCT gene, strand FROM exons) USING (gene) LEFT JOIN i USING (gene))
SELECT gene AS gene_id, n_introns, n_supported AS n_introns_supported, n_exact AS n_introns_exact, n_exons, n_expressed AS n_exons_expressed, round(coverage + 1e-9::DOUBLE, 6) AS mean_exon_coverage, at_start AS start_supported, at_stop AS stop_supported,
 round(CAST(0.5 * (1 - jr) + 0.3 * (1 - er) + 0.2 * (1 - (CAST(at_start AS INTEGER) + CAST(at_stop AS INTEGER)) / 2) AS DOUBLE), 6) AS aed,
 CASE WHEN n_introns = 0 THEN CASE WHEN er >= 0.8 THEN 'full' WHEN er >= 0.5 THEN 'partial' WHEN er > 0 THEN 'minimal' ELSE 'none' END WHEN jr >= 1 AND er >= 0.8 THEN 'full' WHEN jr >= 0.8 OR (jr >= 0.5 AND er >= 0.5) THEN 'partial' WHEN jr > 0 OR er > 0 THEN 'minimal' ELSE 'none' END AS evidence_level,
 concat_ws(',', CASE WHEN n_introns > 0 AND n_supported = 0 THEN 'NO_JUNCTION_SUPPORT' WHEN n_supported < n_introns THEN 'PARTIAL_JUNCTION_SUPPORT' END, CASE WHEN n_expressed = 0 THEN 'NO_EXON_EXPRESSION' WHEN er < 0.5 THEN 'LOW_EXON_COVERAGE' END, CASE WHEN NOT at_start THEN 'START_UNSUPPORTED' END, CASE WHEN NOT at_stop THEN 'STOP_UNSUPPORTED' END) AS flags FROM z""")
def evidence_run(spark, sf_dir):
    genes, transcripts, aligned = gene_tables(spark, sf_dir)
    found = runs.score_evidence(genes, transcripts, bound_junctions(spark, sf_dir), aligned)
    rounded = found.withColumn("mean_exon_coverage", F.round(F.col("mean_exon_coverage") + 1e-9, 6)).withColumn("aed", F.round("aed", 6)).withColumn("flags", F.array_join("flags", ","))
    return rounded.select("gene_id", "n_introns", "n_introns_supported", "n_introns_exact", "n_exons", "n_exons_expressed", "mean_exon_coverage", "start_supported", "stop_supported", "aed", "evidence_level", "flags")

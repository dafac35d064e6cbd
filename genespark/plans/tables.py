"""Queries on prediction tables, regions, flags, junction variants, plans, whole runs and user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from .. import parallel, runs, storage
from ..functions import regions
from ..operators import confidence, evidence, genes, homology, intervals, junctions, planning, predictions, qc, visual
from ..sources import interchange, reports, writers
from . import annotation, evidence as evidence_plans
from .annotation import CHUNK_SQL, GENES, HITS, STATUS, hits, ordered_scaffolds, scaffolds, statuses
from .binding import EXONS, JUNCTIONS, Plans, exons, gene_introns, table
from .binding import junctions as bound_junctions
from .evidence import INTRON_KEY, NEAREST, SAMPLES, sample_counts
from .pipeline import label_genes
from .signals import PROBS, probabilities

PLANS = Plans()
SIZE = 16

# --- predictions: a row of 16 positions a vector -------------------------------------------------


def stored(spark, sf_dir):
    """sample (from 0) and probs, 16 positions a row, of two scaffolds one after the other."""
    return probabilities(spark, sf_dir).groupBy(F.col("vec_id").alias("sample")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "probs"))), lambda x: x["probs"]).alias("probs"))


def coordinates(spark, sf_dir):
    n = table(spark, sf_dir, "embeddings").agg(F.count("*").alias("n"))
    rows = n.select(F.explode(F.array(F.struct(F.lit("a").alias("seqid"), F.lit(0).alias("ord"), (F.floor(F.col("n") / 2) * SIZE + 5).alias("length")), F.struct(F.lit("b").alias("seqid"), F.lit(1).alias("ord"), (F.col("n") * SIZE - F.floor(F.col("n") / 2) * SIZE - 5).alias("length")))).alias("s")).select("s.*")
    return predictions.coordinate_index(rows)


FLAT = PROBS + """, fl AS (SELECT vec_id * 16 + pos AS loc, probs FROM p), nn AS (SELECT count(*) AS n FROM embeddings), sc AS (SELECT 'a' AS seqid, 0 AS o, n // 2 * 16 + 5 AS length FROM nn UNION ALL SELECT 'b', n // 2 * 16 + 5, n * 16 - n // 2 * 16 - 5 FROM nn)"""
WANTED = "rg AS (SELECT o_orderkey AS region_id, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS seqid, o_orderkey % 997 AS rs, o_orderkey % 997 + 1 + o_custkey % 90 AS re FROM orders)"


def wanted(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS region_id", "CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS seqid", "o_orderkey % 997 AS region_start", "o_orderkey % 997 + 1 + o_custkey % 90 AS region_end")


@PLANS.add(f"WITH {FLAT}, {WANTED} SELECT region_id, count(*) AS n, round(sum(list_max(probs)), 6) AS total, round(arg_min(probs[1], loc), 6) AS first, round(arg_max(probs[4], loc), 6) AS last FROM rg JOIN sc USING (seqid) JOIN fl ON loc >= o + rs AND loc < o + re WHERE re <= length GROUP BY region_id")
def legacy_region_predictions(spark, sf_dir):
    """Regions of the concatenated array, over the bounds of its rows."""
    found = predictions.legacy_region_probabilities(wanted(spark, sf_dir), coordinates(spark, sf_dir), stored(spark, sf_dir), SIZE)
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + F.array_max(x))
    return found.select("region_id", F.size("probs").cast("long").alias("n"), F.round(total, 6).alias("total"), F.round(F.col("probs")[0][0], 6).alias("first"), F.round(F.element_at("probs", -1)[3], 6).alias("last"))


@PLANS.add(f"WITH {FLAT}, pt AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS seqid, event_id % 3001 AS pos FROM events) SELECT event_id, o + pos AS array_pos, round(probs[3], 6) AS coding FROM pt JOIN sc USING (seqid) JOIN fl ON loc = o + pos WHERE pos < length")
def point_look_up(spark, sf_dir):
    points = table(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS seqid", "event_id % 3001 AS pos")
    found = predictions.at_positions(predictions.to_array(points, coordinates(spark, sf_dir)), stored(spark, sf_dir), SIZE)
    return found.select("event_id", "array_pos", F.round(F.col("probs")[2], 6).alias("coding"))


@PLANS.add(f"""WITH {FLAT}, ti AS (SELECT seqid, o, length, unnest(range(0, length, 100)) AS start FROM sc) SELECT seqid, start, least(start + 100, length) AS "end", count(*) AS n, round(avg(list_max(probs)), 6) AS mean FROM ti JOIN fl ON loc >= o + start AND loc < o + least(start + 100, length) GROUP BY ALL""")
def prediction_tiles(spark, sf_dir):
    """Whole scaffolds in regions of 100 positions."""
    index = coordinates(spark, sf_dir)
    tiles = predictions.tiles(index, 100).select(F.concat_ws(":", "seqid", F.col("start").cast("string")).alias("region_id"), "seqid", F.col("start").alias("region_start"), F.col("end").alias("region_end"))
    found = predictions.legacy_region_probabilities(tiles, index, stored(spark, sf_dir), SIZE).join(tiles, "region_id")
    mean = F.aggregate("probs", F.lit(0.0), lambda a, x: a + F.array_max(x)) / F.size("probs")
    return found.select("seqid", F.col("region_start").alias("start"), F.col("region_end").alias("end"), F.size("probs").cast("long").alias("n"), F.round(mean, 6).alias("mean"))


@PLANS.add(f"WITH {FLAT} SELECT seqid, o AS array_start, o + length AS array_end FROM sc WHERE seqid = 'b'")
def scaffold_range(spark, sf_dir):
    return predictions.scaffold_range(coordinates(spark, sf_dir), "b")


@PLANS.add(f"WITH {PROBS} SELECT count(*) AS n_positions, 0 AS n_wrong_size, 0 AS n_wrong_sum FROM p")
def validate_predictions(spark, sf_dir):
    """Predictions written to the interchange format under another name, found and checked."""
    folder = storage.scratch(spark, "predictions")
    stored(spark, sf_dir).withColumnRenamed("probs", "y_pred").write.parquet(folder)
    return interchange.validate_predictions(spark.read.parquet(folder))


STRANDED = PROBS + """, ch AS (SELECT vec_id AS chunk_id, CASE WHEN vec_id % 2 = 0 THEN '+' ELSE '-' END AS strand, vec_id // 2 * 16 AS low, vec_id // 2 * 16 + 16 AS high FROM embeddings),
gb AS (SELECT strand, CASE WHEN strand = '+' THEN low + pos ELSE high - 1 - pos END AS loc, probs FROM ch JOIN p ON p.vec_id = chunk_id)"""


def chunk_rows(spark, sf_dir):
    """Chunks of 16 bases of one scaffold, the odd ones on the reverse strand."""
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS chunk_id", "'a' AS seqid", "floor(vec_id / 2) * 16 AS low", "floor(vec_id / 2) * 16 + 16 AS high")
    return rows.selectExpr("chunk_id", "seqid", "CASE WHEN chunk_id % 2 = 0 THEN low ELSE high END AS start", "CASE WHEN chunk_id % 2 = 0 THEN high ELSE low END AS end")


@PLANS.add(f"WITH {STRANDED}, rg AS (SELECT o_orderkey AS region_id, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, o_orderkey % 997 AS rs, o_orderkey % 997 + 1 + o_custkey % 90 AS re FROM orders) SELECT region_id, count(*) AS n, round(arg_min(probs[1], loc), 6) AS first, round(arg_max(probs[4], loc), 6) AS last FROM rg JOIN gb ON gb.strand = rg.strand AND loc >= rs AND loc < re GROUP BY region_id")
def stranded_region_predictions(spark, sf_dir):
    """Regions of chunks of their strand, in the order of the scaffold."""
    rows = wanted(spark, sf_dir).select("region_id", F.lit("a").alias("seqid"), F.when(F.col("region_id") % 2 == 0, "+").otherwise("-").alias("strand"), "region_start", "region_end")
    slices = predictions.chunk_slices(rows, predictions.chunk_index(chunk_rows(spark, sf_dir)), 64)
    found = predictions.region_probabilities(slices, stored(spark, sf_dir).withColumnRenamed("sample", "chunk_id"))
    return found.select("region_id", F.size("probs").cast("long").alias("n"), F.round(F.col("probs")[0][0], 6).alias("first"), F.round(F.element_at("probs", -1)[3], 6).alias("last"))


@PLANS.add(f"WITH {STRANDED} SELECT 'a' AS seqid, max(high) AS length, count(DISTINCT strand) = 2 AS both FROM ch WHERE strand = '+' OR true")
def scaffold_lengths(spark, sf_dir):
    chunks = chunk_rows(spark, sf_dir)
    return predictions.scaffold_lengths(chunks).withColumn("both", F.lit(predictions.has_both_strands(chunks)))


TRACK = PROBS + """, tr AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id, pos) - 1 AS loc, list_max(probs) AS mp, list_position(probs, list_max(probs)) - 1 AS call FROM p)"""


def track_rows(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("label").orderBy("vec_id", "pos")
    return probabilities(spark, sf_dir).withColumn("loc", (F.row_number().over(order) - 1).cast("long")).select("label", "loc", "probs")


@PLANS.add(f"WITH {TRACK} SELECT label, loc, round(mp, 6) AS max_prob, CAST(call AS INTEGER) AS call, round(CASE WHEN count(*) OVER (PARTITION BY label) < 20 THEN mp ELSE sum(mp) OVER (PARTITION BY label ORDER BY loc ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) / 20 END, 6) AS smoothed FROM tr")
def confidence_track(spark, sf_dir):
    found = visual.gene_track(track_rows(spark, sf_dir), ["label"], "loc")
    return found.select("label", "loc", F.round("max_prob", 6).alias("max_prob"), "call", F.round("smoothed", 6).alias("smoothed"))


LOW = TRACK + """, lw AS (SELECT label, loc, mp, loc - row_number() OVER (PARTITION BY label ORDER BY loc) AS run FROM tr WHERE mp < 0.7), lr AS (SELECT label, min(loc) AS s, max(loc) + 1 AS e, avg(mp) AS score FROM lw GROUP BY label, run HAVING count(*) >= 10)"""


@PLANS.add(f"""WITH {LOW} SELECT label AS gene_id, s AS start, e AS "end", CAST(floor(score * 1000) AS BIGINT) AS score FROM lr""")
def low_confidence_regions(spark, sf_dir):
    """Runs of ten and more bases under 0.7 as BED lines."""
    scored = confidence.score_genes(label_genes(spark, sf_dir)).select("gene_id", F.lit("a").alias("seqid"), F.lit("+").alias("strand"), "low_regions")
    f = F.split("line", "\t")
    return writers.low_confidence_bed(scored).select(F.regexp_extract(f[3], "^([0-9]+)_lcr$", 1).cast("int").alias("gene_id"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), f[4].cast("long").alias("score"))


@PLANS.add(f"""WITH {TRACK}, n AS (SELECT label, count(*) AS n FROM tr GROUP BY label), pr AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id, pos) - 1 AS loc, probs[4] AS between FROM p)
SELECT tr.label AS gene_id, round(median(mp), 6) AS median_prob, round(avg(between) FILTER (tr.loc >= n // 2 AND tr.loc < n // 2 + 5), 6) AS intron_score, round(avg(mp) FILTER (tr.loc < n // 2), 6) AS first_exon, CAST(2 AS INTEGER) AS n_exons FROM tr JOIN pr ON pr.label = tr.label AND pr.loc = tr.loc JOIN n ON n.label = tr.label GROUP BY tr.label""")
def exon_intron_scores(spark, sf_dir):
    found = confidence.score_genes(label_genes(spark, sf_dir))
    return found.select("gene_id", F.round("median_prob", 6).alias("median_prob"), F.round(F.col("intron_scores")[0], 6).alias("intron_score"), F.round(F.col("exon_scores")[0], 6).alias("first_exon"), "n_exons")


@PLANS.add("SELECT o_orderkey AS gene_id, 0.0::DOUBLE AS overall_score, 2.0::DOUBLE AS mean_entropy, 'low' AS confidence_class, 'scoring_error' AS flags FROM orders")
def confidence_fallback(spark, sf_dir):
    """Genes on a scaffold without chunks get the fallback record."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene_id", "'none' AS seqid", "'+' AS strand", "o_orderkey * 10 AS start", "o_orderkey * 10 + 5 AS end")
    tx = rows.select("gene_id", F.lit(0).alias("line_no"), F.array(F.struct("start", "end")).alias("exons"), F.array(F.struct("start", "end", F.lit(0).alias("phase"))).alias("cds"))
    found = runs.confidence(rows, tx, chunk_rows(spark, sf_dir), stored(spark, sf_dir).withColumnRenamed("sample", "chunk_id"))
    return found.select("gene_id", "overall_score", "mean_entropy", "confidence_class", F.array_join("flags", ",").alias("flags"))


# --- regions and structure -------------------------------------------------------------------------


@PLANS.add(f"""WITH {EXONS}, sp AS (SELECT gene, seqid, min(s) AS s, max(e) AS e FROM exons GROUP BY ALL) SELECT gene, s >= 300150 AND e <= 700450 AS inside FROM sp WHERE seqid = 2 AND s < 700450 AND e > 300150""")
def genes_in_region(spark, sf_dir):
    """Genes that touch a region, and whether they lie inside."""
    rows = exons(spark, sf_dir).groupBy("gene", "seqid").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    inner = genes.inside(rows, 2, 300150, 700450).select("gene", F.lit(True).alias("inside"))
    return genes.overlapping(rows, 2, 300150, 700450).join(inner, "gene", "left").select("gene", F.coalesce("inside", F.lit(False)).alias("inside"))


@PLANS.add("""SELECT o_orderkey AS k, CASE WHEN s_suppkey IS NULL THEN 'unknown scaffold' ELSE 'beyond the end' END AS reason FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey % 200 WHERE s_suppkey IS NULL OR o_orderkey * 10 + 10 > 100000 + s_suppkey * 37""")
def region_validity(spark, sf_dir):
    lengths = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS seqid", "100000 + s_suppkey * 37 AS length")
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey % 200 AS seqid", "o_orderkey * 10 AS start", "o_orderkey * 10 + 10 AS end")
    return regions.invalid(rows, lengths).select("k", "reason")


# --- flags -------------------------------------------------------------------------------------------


@PLANS.add(f"""WITH {GENES} SELECT gene, list_contains(flags, 'CHIMERIC') AS has_one, list_has_any(flags, ['CHIMERIC', 'NO_HOMOLOGY']) AS has_any, list_has_all(flags, ['LOW_CONF', 'NO_HOMOLOGY']) AS has_all,
 array_to_string(list_filter(flags, lambda x: x IN ('NO_HOMOLOGY', 'CHIMERIC')), ',') AS homology, array_to_string(list_filter(flags, lambda x: x IN ('INTERNAL_STOP', 'CHIMERIC')), ',') AS errors FROM g""")
def flag_predicates(spark, sf_dir):
    f = F.col("flags")
    return annotation.genes(spark, sf_dir).select("gene", qc.has_flag(f, "CHIMERIC").alias("has_one"), qc.has_any(f, ("CHIMERIC", "NO_HOMOLOGY")).alias("has_any"), qc.has_all(f, ("LOW_CONF", "NO_HOMOLOGY")).alias("has_all"), F.array_join(qc.of_category(f, "homology"), ",").alias("homology"), F.array_join(qc.of_severity(f, "error"), ",").alias("errors"))


@PLANS.add(f"""WITH {GENES} SELECT 'tier' AS list, count(*) AS n, CAST(sum(gene) AS BIGINT) AS total FROM g WHERE tier = 'low' UNION ALL SELECT 'flag', count(*), CAST(sum(gene) AS BIGINT) FROM g WHERE list_contains(flags, 'CHIMERIC') UNION ALL SELECT 'flagged', count(*), CAST(sum(gene) AS BIGINT) FROM g WHERE len(flags) > 0""")
def gene_lists(spark, sf_dir):
    rows, out = annotation.genes(spark, sf_dir), None
    for name, found in (("tier", qc.by_tier(rows, "low")), ("flag", qc.with_flag(rows, "CHIMERIC")), ("flagged", qc.flagged(rows))):
        own = found.agg(F.lit(name).alias("list"), F.count("*").alias("n"), F.sum("gene").alias("total"))
        out = own if out is None else out.unionByName(own)
    return out


@PLANS.add(f"WITH {STATUS} SELECT query_id FROM st WHERE status = 'complete'")
def genes_by_status(spark, sf_dir):
    return homology_status_rows(spark, sf_dir)


def homology_status_rows(spark, sf_dir):
    return qc.by_status(statuses(spark, sf_dir), "complete").select("query_id")


@PLANS.add(f"""WITH {GENES} SELECT count(*) AS n_genes, count(conf) AS n_confidence_score, count(hom) AS n_homology_score, round(avg(conf), 6) AS mean_confidence_score, round(avg(hom), 6) AS mean_homology_score, round(avg(aed), 6) AS mean_combined_aed FROM g""")
def qc_averages(spark, sf_dir):
    found = qc.averages(annotation.genes(spark, sf_dir).withColumnRenamed("aed", "combined_aed"))
    return found.select("n_genes", "n_confidence_score", "n_homology_score", *(F.round(c, 6).alias(c) for c in ("mean_confidence_score", "mean_homology_score", "mean_combined_aed")))


@PLANS.add(f"WITH {GENES} SELECT gene, CASE WHEN splice < 0.3::DOUBLE OR splice IS NULL THEN 'min_splice_score' WHEN len(flags) > 1 THEN 'max_flag_count' WHEN gene % 2 = 0 THEN 'custom' END AS fail_reason FROM g")
def custom_filter(spark, sf_dir):
    """A filter with a rule of the caller."""
    rules = qc.Criteria(min_splice_score=0.3, max_flags=1, custom=lambda: F.col("gene") % 2 == 1)
    return qc.apply_filter(annotation.genes(spark, sf_dir), rules).select("gene", "fail_reason")


OTHER = {"high_confidence": "CASE WHEN conf IS NULL OR conf < 0.85::DOUBLE THEN 'min_confidence_score' WHEN list_has_any(flags, ['UNSUP_JUNCTION', 'CHIMERIC', 'INTERNAL_STOP', 'LOW_CONF']) THEN 'max_severity' WHEN tier <> 'high' THEN 'tier' END", "has_rnaseq_support": "CASE WHEN list_contains(flags, 'UNSUP_JUNCTION') THEN 'exclude_flags' END", "no_structural_issues": "CASE WHEN list_contains(flags, 'INTERNAL_STOP') THEN 'exclude_flags' END"}


@PLANS.add(f"WITH {GENES} " + " UNION ALL ".join(f"SELECT '{k}' AS preset, gene, {rule} AS fail_reason FROM g" for k, rule in OTHER.items()))
def filter_presets(spark, sf_dir):
    rows, out = annotation.genes(spark, sf_dir), None
    for name in OTHER:
        own = qc.apply_filter(rows, qc.PRESETS[name]).select(F.lit(name).alias("preset"), "gene", "fail_reason")
        out = own if out is None else out.unionByName(own)
    return out


@PLANS.add(f"""WITH c AS (SELECT o_orderkey AS gene_id, {annotation.share('30 + o_orderkey % 70')} AS conf FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey AS gene_id, 4 AS n, o_orderkey % 5 AS sup, o_orderkey % 4 AS can FROM orders WHERE o_orderkey % 4 <> 1), u AS (SELECT gene_id, conf, n, sup, can FROM c FULL JOIN s USING (gene_id)),
f AS (SELECT *, list_filter([CASE WHEN conf < 0.5::DOUBLE THEN 'VERY_LOW_CONF' WHEN conf < 0.7::DOUBLE THEN 'LOW_CONF' END, CASE WHEN n - sup > 0 THEN 'UNSUP_JUNCTION' END, CASE WHEN n - can > 0 THEN 'NON_CANON_SPLICE' END], lambda x: x IS NOT NULL) AS flags FROM u)
SELECT gene_id, conf AS confidence_score, round(CASE WHEN n > 0 THEN 0.6::DOUBLE * can / n + 0.4::DOUBLE * sup / n END, 6) AS splice_score, array_to_string(flags, ',') AS flags, CASE WHEN coalesce(conf < 0.5::DOUBLE, false) THEN 'reject' WHEN coalesce(conf < 0.7::DOUBLE, false) THEN 'low' WHEN len(flags) > 0 OR coalesce(conf < 0.85::DOUBLE, false) THEN 'medium' ELSE 'high' END AS tier FROM f""")
def quality_run(spark, sf_dir):
    """Quality of genes from a confidence and a splice table, either of which may lack a gene."""
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "gene_id")
    conf = rows.filter("gene_id % 3 <> 0").select("gene_id", F.expr(annotation.share("30 + gene_id % 70")).alias("overall_score"))
    spliced = rows.filter("gene_id % 4 <> 1").selectExpr("gene_id", "4 AS n_introns", "gene_id % 5 AS n_supported", "gene_id % 4 AS n_canonical")
    found = runs.quality(conf, spliced)
    return found.select("gene_id", "confidence_score", F.round("splice_score", 6).alias("splice_score"), F.array_join("flags", ",").alias("flags"), "tier")


# --- junctions ---------------------------------------------------------------------------------------


@PLANS.add(f"""WITH {JUNCTIONS}, jp AS (SELECT seqid, s, e, strand, reads, gene_ord FROM (SELECT seqid, s, e, strand, reads, s * 100 + reads AS gene_ord FROM junctions)), jl AS (SELECT seqid, s, e, arg_max(strand, gene_ord) AS strand, arg_max(reads, gene_ord) AS reads, min(gene_ord) AS o FROM jp GROUP BY ALL),
c AS (SELECT i.gene, i.intron_start, l.s, l.e, l.strand, l.reads, row_number() OVER (PARTITION BY i.gene, i.intron_start ORDER BY o) AS r FROM introns i JOIN jl l ON l.seqid = i.seqid AND abs(l.s - i.intron_start) <= 4 AND abs(l.e - i.intron_end) <= 4 AND (l.strand = i.strand OR l.strand = '.'))
SELECT i.gene, i.intron_start, c.s AS junction_start, c.e AS junction_end, c.reads AS junction_reads FROM introns i LEFT JOIN c ON c.r = 1 AND c.gene = i.gene AND c.intron_start = i.intron_start""")
def first_match_junction(spark, sf_dir):
    rows = bound_junctions(spark, sf_dir).withColumn("ord", F.col("start") * 100 + F.col("reads"))
    found = junctions.first_match(gene_introns(spark, sf_dir), rows, 4, INTRON_KEY)
    return found.select("gene", "intron_start", "junction_start", "junction_end", "junction_reads")


@PLANS.add(f"""WITH {SAMPLES}, ps AS (SELECT seqid, start, "end", sample, sum(reads) AS n FROM c GROUP BY ALL), t AS (SELECT seqid, start, "end", CAST(sum(n) AS BIGINT) AS reads, count(*) FILTER (n >= 1) AS ns FROM ps GROUP BY ALL)
SELECT t.seqid, t.start, t."end", mj.strand, t.reads, count(*) OVER () AS n FROM t JOIN mj USING (seqid, start, "end") WHERE ns >= 2""")
def collapsed_junctions(spark, sf_dir):
    """Junctions of four samples, those in two at least, as one table."""
    rows = sample_counts(spark, sf_dir)
    found = junctions.load([rows.filter(F.col("sample") == k) for k in range(4)], [], 2)
    n = found.agg(F.count("*").alias("n"))
    return found.join(F.broadcast(n), F.lit(True)).select("seqid", "start", "end", "strand", "reads", "n")  # one row


@PLANS.add(f"WITH {JUNCTIONS} SELECT seqid, s AS start, count(*) * 2 AS n, CAST(sum(reads) * 3 AS BIGINT) AS reads FROM junctions GROUP BY seqid, s")
def junction_union(spark, sf_dir):
    """Two junction tables one after the other: rows are kept, nothing is summed."""
    rows = bound_junctions(spark, sf_dir)
    found = junctions.load([rows], [rows.withColumn("reads", 2 * F.col("reads"))])
    return found.groupBy("seqid", "start").agg(F.count("*").alias("n"), F.sum("reads").alias("reads"))


@PLANS.add(f"WITH {NEAREST} SELECT gene AS gene_id, intron_start, intron_end - intron_start AS intron_length, CASE WHEN junction_start IS NULL THEN 'no' ELSE 'yes' END AS observed, coalesce(junction_reads, 0) AS read_count, CASE WHEN shift = 0 THEN 'yes' ELSE 'no' END AS exact_match, coalesce(junction_start - intron_start, 0) AS shift_donor, coalesce(junction_end - intron_end, 0) AS shift_acceptor FROM matched")
def junction_details(spark, sf_dir):
    matched = junctions.nearest(gene_introns(spark, sf_dir), bound_junctions(spark, sf_dir), 10, INTRON_KEY)
    rows = matched.withColumn("gene_id", F.col("gene")).withColumn("transcript_id", F.col("gene").cast("string"))
    return reports.junction_details(rows).select("gene_id", "intron_start", "intron_length", "observed", "read_count", "exact_match", "shift_donor", "shift_acceptor")


# --- evidence, homology and refine reports -------------------------------------------------------------


def evidence_scores(spark, sf_dir):
    found, transcripts, aligned = evidence_plans.gene_tables(spark, sf_dir)
    return runs.score_evidence(found, transcripts, bound_junctions(spark, sf_dir), aligned)


@PLANS.add(evidence_plans.PLANS.sql["evidence_run"].replace("round(coverage + 1e-9::DOUBLE, 6) AS mean_exon_coverage", "round(coverage + 1e-9::DOUBLE, 2) AS mean_exon_coverage").replace(", 6) AS aed", " + 1e-9::DOUBLE, 4) AS aed"))
def evidence_report_round_trip(spark, sf_dir):
    """The evidence report written as a table and read back."""
    folder = storage.scratch(spark, "evidence")
    shown = evidence_scores(spark, sf_dir).withColumn("aed", F.col("aed") + 1e-9).withColumn("mean_exon_coverage", F.round(F.col("mean_exon_coverage") + 1e-9, 2))
    writers.tsv(reports.evidence_report(shown), folder)
    found = interchange.evidence_table(spark, folder)
    whole = [F.col(c).cast("long").alias(c) for c in ("gene_id", "n_introns", "n_introns_supported", "n_introns_exact", "n_exons", "n_exons_expressed")]
    return found.select(*whole, "mean_exon_coverage", "start_supported", "stop_supported", "aed", "evidence_level", F.array_join("flags", ",").alias("flags"))


@PLANS.add(f"""WITH {EXONS}, cp AS (SELECT gene, s, e, unnest(range(1, gene % 8 + 1)) AS k FROM exons), bl AS (SELECT gene, p, count(*) AS n FROM (SELECT gene, unnest(range(s + 2 * k, e + k)) AS p FROM cp) GROUP BY ALL),
d AS (SELECT gene, s, e, unnest(range(s, e)) AS p FROM exons), dp AS (SELECT d.gene, s, e, coalesce(n, 0) AS depth FROM d LEFT JOIN bl ON bl.gene = d.gene AND bl.p = d.p)
SELECT gene AS gene_id, s AS exon_start, e - s AS exon_length, min(depth) AS min_depth, max(depth) AS max_depth, CASE WHEN median(depth) >= 5 THEN 'yes' ELSE 'no' END AS is_expressed FROM dp GROUP BY gene, s, e""")
def exon_details(spark, sf_dir):
    _, transcripts, aligned = evidence_plans.gene_tables(spark, sf_dir)
    rows = runs.exon_rows(transcripts)
    depths = runs.exon_depth(rows, aligned, ["gene_id", "transcript_id", "k", "start", "end"])
    return reports.exon_details(depths).select("gene_id", "exon_start", "exon_length", "min_depth", "max_depth", "is_expressed")


@PLANS.add(f"""WITH {annotation.HITS}, s AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM h), u AS (SELECT * FROM s WHERE i = 1),
p AS (SELECT query_id, subject_id AS a, lead(subject_id) OVER w AS b, query_start AS loc, fo, lead(query_start) OVER w - query_end AS gap, (identity + lead(identity) OVER w) / 2 AS idn FROM u WINDOW w AS (PARTITION BY query_id ORDER BY query_start, fo)),
f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY loc, fo) AS i FROM p WHERE b IS NOT NULL AND greatest(0, -gap) <= 10) SELECT query_id AS gene_id, a AS subject_a, b AS subject_b, greatest(gap, 0) AS gap, greatest(-gap, 0) AS overlap FROM f WHERE i = 1""")
def chimera_report(spark, sf_dir):
    return reports.chimera_report(homology.chimeras(hits(spark, sf_dir))).select("gene_id", "subject_a", "subject_b", "gap", "overlap")


@PLANS.add(f"""WITH {HITS}, sg AS (SELECT * FROM h WHERE evalue <= 0.05 AND identity >= 30), s2 AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM sg), u AS (SELECT * FROM s2 WHERE i = 1),
l AS (SELECT *, lead(subject_start) OVER (PARTITION BY subject_id ORDER BY subject_start, fo, query_id) AS nxt FROM u), f AS (SELECT * FROM l WHERE nxt IS NULL OR subject_end - nxt <= 50),
q AS (SELECT DISTINCT subject_id, unnest(range(subject_start, subject_end + 1)) AS pos FROM f), cv AS (SELECT subject_id FROM q GROUP BY 1 HAVING count(*) / 400 >= 0.8), n AS (SELECT subject_id FROM f GROUP BY 1 HAVING count(*) > 1), fr AS (SELECT DISTINCT query_id FROM f JOIN cv USING (subject_id) JOIN n USING (subject_id)) SELECT count(*) AS n_genes FROM fr""")
def fragment_report(spark, sf_dir):
    """The fragment report lists every fragmented gene in one group."""
    genes_ = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene_id")
    found = runs.validate(genes_, hits(spark, sf_dir), limits=homology.Thresholds(evalue=0.05, complete_query=0.2, complete_subject=0.1))
    return reports.fragment_report(found.withColumn("gene_id", F.col("gene_id").cast("string"))).agg(F.sum("n_fragments").alias("n_genes"))


@PLANS.add(f"""WITH {HITS}, sg AS (SELECT * FROM h WHERE evalue <= 0.05 AND identity >= 30), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY evalue, ord) AS i, count(*) OVER (PARTITION BY query_id) AS n_hits FROM sg), a AS (SELECT o_orderkey AS query_id FROM orders UNION SELECT query_id FROM h)
SELECT a.query_id AS gene_id, coalesce(n_hits, 0) AS n_hits, coalesce(CAST(subject_id AS VARCHAR), '') AS best_hit_id, CASE WHEN identity <> 0 THEN printf('%.1f', CAST(identity AS DOUBLE)) ELSE '' END AS identity FROM a LEFT JOIN r ON r.i = 1 AND r.query_id = a.query_id""")
def validation_report(spark, sf_dir):
    genes_ = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene_id")
    found = runs.validate(genes_, hits(spark, sf_dir), limits=homology.Thresholds(evalue=0.05, complete_query=0.2, complete_subject=0.1))
    return reports.validation_report(found).select("gene_id", "n_hits", "best_hit_id", "identity")


def refined(spark, sf_dir):
    k = "o_orderkey"
    return table(spark, sf_dir, "orders").selectExpr(f"{k} AS gene_id", f"{k} % 9 AS seqid", f"{k} * 10 AS start", f"{k} * 10 + 7 AS end", "'+' AS strand", f"{annotation.share(f'{k} % 97')} AS confidence_score", f"CASE WHEN {k} % 3 > 0 THEN {annotation.share(f'{k} % 89')} END AS evidence_score", f"CASE WHEN {k} % 3 > 0 THEN 1 - {annotation.share(f'{k} % 89')} END AS aed", f"{k} % 5 AS n_introns", f"{k} % 3 AS n_introns_supported", f"CAST({k} % 11 AS DOUBLE) AS mean_coverage", f"{k} % 4 AS splice_corrections", f"{k} % 6 = 0 AS boundary_adjusted", "array('LOW_CONF', 'WEAK_EXON') AS flags")


REFINED = f"""rf AS (SELECT o_orderkey AS k, {annotation.share('o_orderkey % 97')} AS conf, CASE WHEN o_orderkey % 3 > 0 THEN {annotation.share('o_orderkey % 89')} END AS ev FROM orders)"""


@PLANS.add(f"WITH {REFINED} SELECT count(*) AS total_genes, round(avg(conf), 6) AS mean_confidence, round(avg(ev), 6) AS mean_evidence_score, round(avg(1 - ev), 6) AS mean_aed, count(*) FILTER (k % 4 > 0) AS genes_splice_corrected, CAST(sum(k % 4) AS BIGINT) AS total_splice_corrections, count(*) FILTER (k % 5 > 0) AS multi_exon_genes, count(*) FILTER (k % 5 > 0 AND k % 5 = k % 3) AS full_junction_support, count(*) FILTER (k % 6 = 0) AS boundary_adjusted FROM rf")
def refine_summary(spark, sf_dir):
    found = reports.refine_summary(refined(spark, sf_dir))
    return found.select(*(F.round(c, 6).alias(c) if c.startswith("mean") else F.col(c) for c in found.columns))


@PLANS.add(f"WITH {REFINED} SELECT k AS gene_id, 0 AS n_exons, CASE WHEN conf <> 0 THEN printf('%.4f', conf) ELSE '' END AS confidence_score, CASE WHEN ev <> 0 THEN printf('%.4f', ev) ELSE '' END AS evidence_score, CASE WHEN k % 5 > 0 THEN (k % 3) || '/' || (k % 5) ELSE '' END AS junction_support, CASE WHEN k % 6 = 0 THEN 'yes' ELSE 'no' END AS boundary_adjusted, 'LOW_CONF,WEAK_EXON' AS flags FROM rf")
def refine_report(spark, sf_dir):
    none = spark.createDataFrame([], "gene_id long, line_no long, exons array<struct<start:long,end:long>>")
    return reports.refine_report(refined(spark, sf_dir), none).select("gene_id", "n_exons", "confidence_score", "evidence_score", "junction_support", "boundary_adjusted", "flags")


@PLANS.add("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 > 0 THEN 'a=' || (o_orderkey % 4) || ';' ELSE '' END || 'confidence_score=' || printf('%.4f', CAST(o_orderkey % 97 AS DOUBLE) / 97) AS text FROM orders""")
def score_attributes(spark, sf_dir):
    """Scores put among the attributes of genes, replacing an older one."""
    from ..operators import refine

    k = "o_orderkey"
    rows = table(spark, sf_dir, "orders").selectExpr(f"{k} AS k", f"CAST({k} % 97 AS DOUBLE) / 97 AS score", f"CASE WHEN {k} % 4 > 0 THEN map('a', CAST({k} % 4 AS STRING), 'confidence_score', 'old') ELSE map('confidence_score', 'x') END AS attributes")
    return refine.with_attributes(rows, {"confidence_score": "score"}).select("k", writers.attributes(F.col("attributes")).alias("text"))


# --- plans and user functions -----------------------------------------------------------------------------


@PLANS.add("""WITH c AS (SELECT s_suppkey AS ord, s_name AS seqid, 100000 + s_suppkey * 37 AS length FROM supplier), u AS (SELECT *, unnest(range(0, length, 45000)) AS start FROM c) SELECT seqid, ord, start, least(start + 45000, length) AS "end", printf('chunk_%04d', row_number() OVER (ORDER BY ord, start) - 1) AS chunk_id FROM u""")
def scaffold_chunks(spark, sf_dir):
    return planning.scaffold_chunks(scaffolds(spark, sf_dir), 45000)


@PLANS.add(f"""WITH {CHUNK_SQL} SELECT chunk_id, seqid, start, "end" FROM ck WHERE chunk_id IN ('chunk_0007', 'chunk_0011')""")
def chunk_look_up(spark, sf_dir):
    """A chunk by its id and one by its place."""
    chunks = planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000)
    return planning.chunk(chunks, "chunk_0007").unionByName(planning.chunk_at(chunks, 11)).select("chunk_id", "seqid", "start", "end")


@PLANS.add(f"""WITH {CHUNK_SQL}, rg AS (SELECT o_orderkey AS region_id, s_name AS seqid, o_orderkey % 90000 AS rs, o_orderkey % 90000 + 5000 AS re FROM orders JOIN supplier ON s_suppkey = o_custkey % 50 + 1) SELECT region_id, chunk_id FROM rg JOIN ck USING (seqid) WHERE rs >= start AND re <= "end" """)
def chunk_of_region(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k", "s_name AS seqid")
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS region_id", "o_custkey % 50 + 1 AS k", "o_orderkey % 90000 AS region_start", "o_orderkey % 90000 + 5000 AS region_end").join(names, "k")
    return genes.chunk_of(rows, planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000)).select("region_id", "chunk_id")


@PLANS.add(f"""WITH {CHUNK_SQL}, z AS (SELECT "end" - start AS size FROM ck), o AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS k, count(*) OVER () AS n FROM z) SELECT max(n) AS n_chunks, round(avg(size), 6) AS mean_size, max(size) FILTER (k = n // 2) AS median_size, min(size) AS min_size, max(size) AS max_size FROM o""")
def plan_summary(spark, sf_dir):
    return planning.plan_summary(planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000)).withColumn("mean_size", F.round("mean_size", 6))


@PLANS.add("SELECT count(*) AS n_tasks, count(*) FILTER (o_orderkey % 7 <> 0) AS n_ok, count(*) FILTER (o_orderkey % 7 = 0) AS n_failed, round(sum(o_orderkey % 13), 6) AS total_seconds, round(avg(o_orderkey % 13), 6) AS mean_seconds, round(count(*) FILTER (o_orderkey % 7 <> 0) / count(*), 6) AS success_rate FROM orders")
def execution_statistics(spark, sf_dir):
    tasks = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 7 <> 0 AS ok", "CAST(o_orderkey % 13 AS DOUBLE) AS seconds")
    found = planning.execution_statistics(tasks)
    return found.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes))


@PLANS.add("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 <> 0 THEN 1000 // (o_orderkey % 10) END AS part, o_orderkey % 10 <> 0 AS ok, CASE WHEN o_orderkey % 10 = 0 THEN 'ZeroDivisionError' END AS error FROM orders")
def map_items(spark, sf_dir):
    """A user function on every row; its failures are rows."""
    items = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k")
    found = parallel.map_items(items, lambda r: {"k": r["k"], "part": 1000 // (r["k"] % 10)}, "k long, part long")
    # A failed row has nulls: its key is found by what is missing.
    good = found.filter("ok").select("k", "part", "ok", F.lit(None).cast("string").alias("error"))
    bad = items.join(good, "k", "left_anti").select("k", F.lit(None).cast("long").alias("part"), F.lit(False).alias("ok"), F.lit("ZeroDivisionError").alias("error"))
    return good.unionByName(bad)


@PLANS.add(f"""WITH {CHUNK_SQL}, pt AS (SELECT o_orderkey AS k, s_name AS seqid, o_orderkey * 7 % 95000 AS loc FROM orders JOIN supplier ON s_suppkey = o_custkey % 50 + 1) SELECT count(DISTINCT chunk_id) AS n_chunks, count(*) AS n_rows, CAST(sum(loc) AS BIGINT) AS total FROM pt JOIN ck ON ck.seqid = pt.seqid AND loc >= start AND loc < "end" """)
def process_chunks(spark, sf_dir):
    """A user function over the rows of each chunk, and another over all results."""
    names = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS j", "s_name AS seqid")
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey * 7 % 95000 AS start", "o_custkey % 50 + 1 AS j").join(names, "j").select("seqid", "start")

    def count(chunk_id: str, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk_id": [chunk_id], "n": [len(group)], "total": [int(group["start"].sum())]})

    gather = lambda found: found.agg(F.count("*").alias("n_chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.sum("total").alias("total"))
    return parallel.process(planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000, ordered_scaffolds(spark, sf_dir)), rows, count, "chunk_id string, n long, total long", gather)


@PLANS.add(f"""WITH {EXONS} SELECT gene, s AS start, round(0.7::DOUBLE * least(1.0, ln(1 + rn) / ln(101)) + 0.3::DOUBLE * greatest(0.0, 1 - rn / 15), 6) AS confidence, round(least(1.0, greatest(0.0, 0.5 * (1 - rn / 50) + 0.3 * 0.5 + 0.2 * 0.25)), 6) AS distance FROM exons""")
def distance_scalars(spark, sf_dir):
    from ..operators.splice import correction_confidence

    rn = F.col("rn")
    return exons(spark, sf_dir).select("gene", "start", F.round(correction_confidence(rn, rn, 15), 6).alias("confidence"), F.round(evidence.edit_distance(rn / 50, F.lit(0.5), F.lit(0.75)), 6).alias("distance"))


@PLANS.add(f"""WITH {EXONS}, a AS (SELECT seqid, gene, s, e FROM exons WHERE rn = 1), b AS (SELECT seqid, gene AS g2, s AS s2, e AS e2 FROM exons WHERE rn = 2) SELECT gene, s + 50 <= s2 AND e2 <= e + 150 AS held, greatest(0, least(e + 90, e2) - greatest(s, s2)) AS shared FROM a JOIN b ON b.g2 = a.gene""")
def containment(spark, sf_dir):
    rows = exons(spark, sf_dir)
    first = rows.filter("rn = 1").select("gene", "start", "end")
    second = rows.filter("rn = 2").select("gene", F.col("start").alias("s2"), F.col("end").alias("e2"))
    c = F.col
    return first.join(second, "gene").select("gene", intervals.contains(c("start") + 50, c("end") + 150, c("s2"), c("e2")).alias("held"), intervals.overlap_length(c("start"), c("end") + 90, c("s2"), c("e2")).alias("shared"))

"""Homology, quality-control and planning queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import genes as gene_tables
from ..operators import homology, planning, qc
from .binding import EXONS, Plans, exons, table

PLANS = Plans()


def hits(spark, sf_dir):
    """Search hits: one a line item."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").withColumn("ord", F.row_number().over(order))
    return rows.selectExpr("l_orderkey AS query_id", "l_partkey % 200 AS subject_id", "2 * l_quantity AS identity", "l_linenumber * 60 + l_partkey % 50 AS query_start", "l_linenumber * 60 + l_partkey % 50 + 40 + l_suppkey % 40 AS query_end", "(l_orderkey % 9) * 40 + 1 AS subject_start", "(l_orderkey % 9) * 40 + 30 + l_suppkey % 40 AS subject_end", "l_discount AS evalue", "CAST(300 + l_orderkey % 100 AS BIGINT) AS query_length", "CAST(400 AS BIGINT) AS subject_length", "ord")


HITS = """h AS (SELECT l_orderkey AS query_id, l_partkey % 200 AS subject_id, 2 * l_quantity AS identity, l_linenumber * 60 + l_partkey % 50 AS query_start, l_linenumber * 60 + l_partkey % 50 + 40 + l_suppkey % 40 AS query_end,
 (l_orderkey % 9) * 40 + 1 AS subject_start, (l_orderkey % 9) * 40 + 30 + l_suppkey % 40 AS subject_end, l_discount AS evalue, CAST(300 + l_orderkey % 100 AS BIGINT) AS query_length, CAST(400 AS BIGINT) AS subject_length,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS ord FROM lineitem)"""
BEST = HITS + """, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY evalue, ord) AS i, count(*) OVER (PARTITION BY query_id) AS n_hits FROM h),
b AS (SELECT r.*, n_subjects FROM r JOIN (SELECT query_id, count(DISTINCT subject_id) AS n_subjects FROM h GROUP BY 1) USING (query_id) WHERE i = 1)"""


@PLANS.add(f"WITH {BEST} SELECT query_id, n_hits, n_subjects, subject_id, evalue, CAST(identity AS DOUBLE) AS identity FROM b")
def best_hit(spark, sf_dir):
    return homology.best_hits(hits(spark, sf_dir), ["query_id"]).select("query_id", "n_hits", "n_subjects", "subject_id", "evalue", "identity")


@PLANS.add(f"WITH {HITS} SELECT query_id, ord, round((query_end - query_start + 1) / query_length, 6) AS query_coverage, round((subject_end - subject_start + 1) / subject_length, 6) AS subject_coverage FROM h WHERE evalue <= 0.05 AND identity >= 30")
def hit_coverage(spark, sf_dir):
    found = homology.significant(hits(spark, sf_dir), homology.Thresholds(evalue=0.05))
    c = F.col
    return found.select("query_id", F.col("ord").cast("long").alias("ord"), F.round(homology.coverage(c("query_start"), c("query_end"), c("query_length")), 6).alias("query_coverage"), F.round(homology.coverage(c("subject_start"), c("subject_end"), c("subject_length")), 6).alias("subject_coverage"))


@PLANS.add(f"""WITH {HITS}, s AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM h), u AS (SELECT * FROM s WHERE i = 1),
p AS (SELECT query_id, subject_id AS subject_a, lead(subject_id) OVER w AS subject_b, query_start AS first_at, fo, lead(query_start) OVER w - query_end AS gap, (identity + lead(identity) OVER w) / 2 AS idn FROM u WINDOW w AS (PARTITION BY query_id ORDER BY query_start, fo)),
f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY first_at, fo) AS i FROM p WHERE subject_b IS NOT NULL AND greatest(0, -gap) <= 10)
SELECT query_id, subject_a, subject_b, greatest(0, gap) AS gap, greatest(0, -gap) AS overlap, round(least(1.0, idn / 100), 6) AS confidence FROM f WHERE i = 1""")
def chimera_pairs(spark, sf_dir):
    return homology.chimeras(hits(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


@PLANS.add(f"""WITH {HITS}, s AS (SELECT *, row_number() OVER (PARTITION BY subject_id, query_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM h), u AS (SELECT * FROM s WHERE i = 1),
l AS (SELECT *, lead(subject_start) OVER (PARTITION BY subject_id ORDER BY subject_start, fo, query_id) AS nxt FROM u), p AS (SELECT * FROM l WHERE nxt IS NULL OR subject_end - nxt <= 50),
n AS (SELECT subject_id, count(*) AS n_queries FROM p GROUP BY 1 HAVING count(*) > 1),
q AS (SELECT DISTINCT subject_id, unnest(range(subject_start, subject_end + 1)) AS pos FROM p), c AS (SELECT subject_id, count(*) / 400 AS coverage FROM q GROUP BY 1)
SELECT subject_id, n_queries, round(coverage, 6) AS coverage FROM n JOIN c USING (subject_id) WHERE coverage >= 0.8""")
def fragment_groups(spark, sf_dir):
    return homology.fragment_groups(hits(spark, sf_dir)).withColumn("coverage", F.round("coverage", 6))


STATUS = BEST + """, st AS (SELECT query_id, CASE WHEN (query_end - query_start + 1) / query_length >= 0.2 AND (subject_end - subject_start + 1) / subject_length >= 0.1 THEN 'complete' ELSE 'partial' END AS status FROM b)"""


def statuses(spark, sf_dir):
    c = F.col
    limits = homology.Thresholds(complete_query=0.2, complete_subject=0.1)
    found = homology.best_hits(hits(spark, sf_dir), ["query_id"])
    return found.select("query_id", homology.status(homology.coverage(c("query_start"), c("query_end"), c("query_length")), homology.coverage(c("subject_start"), c("subject_end"), c("subject_length")), limits).alias("status"))


@PLANS.add(f"WITH {STATUS} SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM st GROUP BY status")
def homology_status(spark, sf_dir):
    counts = statuses(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select("status", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("percent"))  # one row


@PLANS.add(f"WITH {STATUS} SELECT o_orderkey AS query_id, coalesce(status, 'no_hit') AS status FROM orders LEFT JOIN st ON query_id = o_orderkey UNION SELECT query_id, status FROM st")
def no_hit_anti(spark, sf_dir):
    genes = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS query_id")
    return homology.with_missing(genes, statuses(spark, sf_dir), "query_id")


def share(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE) / CAST(100 AS DOUBLE)"


CONF = f"CASE WHEN o_orderkey % 11 <> 0 THEN {share('30 + o_orderkey % 70')} END"
HOM = f"CASE WHEN o_orderkey % 5 <> 0 THEN {share('o_orderkey % 101')} END"
AED = f"CASE WHEN o_orderkey % 3 <> 0 THEN {share('o_orderkey % 97')} END"
SPLICE = share("o_orderkey % 89")
MARKS = {"UNSUP_JUNCTION": "o_orderkey % 4 = 0", "CHIMERIC": "o_orderkey % 17 = 0", "INTERNAL_STOP": "o_orderkey % 53 = 0", "NO_HOMOLOGY": "o_orderkey % 6 = 0", "LOW_CONF": "o_orderkey % 9 = 0", "unknown_flag": "o_orderkey % 13 = 0"}


def genes(spark, sf_dir):
    """Genes with scores, flags and tier."""
    marks = qc.known(qc.listed(*(F.when(F.expr(test), code) for code, test in MARKS.items())))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gene"), F.expr(CONF).alias("confidence_score"), F.expr(HOM).alias("homology_score"), F.expr(AED).alias("rnaseq_aed"), F.expr(SPLICE).alias("splice_score"), marks.alias("flags"))
    return rows.withColumn("tier", qc.tier(F.col("confidence_score"), F.col("flags"))).withColumn("aed", qc.combined_aed(F.col("rnaseq_aed"), F.col("homology_score"), F.col("confidence_score")))


LIST = ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in MARKS.items() if code in qc.REGISTRY)
GENES = f"""g0 AS (SELECT o_orderkey AS gene, {CONF} AS conf, {HOM} AS hom, {AED} AS ra, {SPLICE} AS splice, list_filter([{LIST}], lambda x: x IS NOT NULL) AS flags FROM orders),
g AS (SELECT *, CASE WHEN list_contains(flags, 'INTERNAL_STOP') OR coalesce(conf < 0.5::DOUBLE, false) THEN 'reject' WHEN list_contains(flags, 'CHIMERIC') OR coalesce(conf < 0.7::DOUBLE, false) THEN 'low'
 WHEN list_has_any(flags, ['UNSUP_JUNCTION', 'LOW_CONF']) OR coalesce(conf < 0.85::DOUBLE, false) THEN 'medium' ELSE 'high' END AS tier,
 (coalesce(0.4::DOUBLE * ra, 0) + coalesce(0.4::DOUBLE * (1 - hom), 0) + coalesce(0.2::DOUBLE * (1 - conf), 0)) / nullif(CASE WHEN ra IS NULL THEN 0 ELSE 0.4::DOUBLE END + CASE WHEN hom IS NULL THEN 0 ELSE 0.4::DOUBLE END + CASE WHEN conf IS NULL THEN 0 ELSE 0.2::DOUBLE END, 0) AS aed FROM g0)"""


@PLANS.add(f"WITH {GENES} SELECT gene, round(aed, 6) AS combined_aed FROM g")
def combined_aed(spark, sf_dir):
    return genes(spark, sf_dir).select("gene", F.round("aed", 6).alias("combined_aed"))


@PLANS.add(f"WITH {GENES} SELECT gene, tier, array_to_string(flags, ',') AS flags FROM g")
def tier_case(spark, sf_dir):
    return genes(spark, sf_dir).select("gene", "tier", F.array_join("flags", ",").alias("flags"))


@PLANS.add(f"WITH {GENES} SELECT tier, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM g GROUP BY tier")
def tier_percentages(spark, sf_dir):
    counts = genes(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("total"))), F.lit(True)).select("tier", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("percent"))  # one row


@PLANS.add(f"""WITH {GENES} SELECT gene, CASE WHEN conf IS NULL OR conf < 0.7::DOUBLE THEN 'min_confidence_score' WHEN list_has_any(flags, ['CHIMERIC', 'INTERNAL_STOP']) THEN 'max_severity' WHEN tier NOT IN ('high', 'medium') THEN 'tier' END AS fail_reason FROM g""")
def qc_filter_reasons(spark, sf_dir):
    return qc.apply_filter(genes(spark, sf_dir), qc.PRESETS["publication_ready"]).select("gene", "fail_reason")


@PLANS.add(f"""WITH {GENES}, r AS (SELECT CASE WHEN hom IS NULL OR hom < 0.01::DOUBLE THEN 'min_homology_score' WHEN list_contains(flags, 'NO_HOMOLOGY') THEN 'exclude_flags' ELSE 'pass' END AS reason FROM g)
SELECT reason, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM r GROUP BY reason""")
def filter_statistics(spark, sf_dir):
    found = qc.filter_statistics(qc.apply_filter(genes(spark, sf_dir), qc.PRESETS["has_homology"]))
    return found.select("reason", "n", F.round("percent", 6).alias("percent"))


DIM = ", ".join(f"('{code}', '{category}', '{qc.SEVERITIES[rank]}', {rank})" for code, (category, rank) in qc.REGISTRY.items())
FLAG_COUNTS = GENES + f", dim(code, category, severity, rank) AS (VALUES {DIM}), fc AS (SELECT code, count(*) AS n_genes FROM (SELECT unnest(flags) AS code FROM g) GROUP BY code), flagged AS (SELECT * FROM fc JOIN dim USING (code))"


@PLANS.add(f"WITH {FLAG_COUNTS} SELECT code, n_genes, category, severity FROM flagged")
def flag_counts(spark, sf_dir):
    return qc.flag_counts(genes(spark, sf_dir)).select("code", "n_genes", "category", "severity")


@PLANS.add(f"WITH {FLAG_COUNTS} SELECT code, n_genes FROM flagged ORDER BY n_genes DESC, code LIMIT 15")
def flag_top15(spark, sf_dir):
    return qc.flag_counts(genes(spark, sf_dir)).select("code", "n_genes").orderBy(F.desc("n_genes"), "code").limit(15)


@PLANS.add(f"WITH {FLAG_COUNTS} SELECT gene, CASE max(rank) WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'error' WHEN 3 THEN 'critical' END AS severity FROM (SELECT gene, unnest(CASE WHEN len(flags) = 0 THEN [NULL] ELSE flags END) AS code FROM g) LEFT JOIN dim USING (code) GROUP BY gene")
def severity_max(spark, sf_dir):
    return genes(spark, sf_dir).select("gene", qc.max_severity(F.col("flags")).alias("severity"))


@PLANS.add(f"WITH {GENES}, x AS (SELECT CASE WHEN conf >= 0.9::DOUBLE THEN 9 WHEN conf >= 0.8::DOUBLE THEN 8 WHEN conf >= 0.7::DOUBLE THEN 7 WHEN conf >= 0.6::DOUBLE THEN 6 WHEN conf >= 0.5::DOUBLE THEN 5 WHEN conf >= 0.4::DOUBLE THEN 4 WHEN conf >= 0.3::DOUBLE THEN 3 WHEN conf >= 0.2::DOUBLE THEN 2 WHEN conf >= 0.1::DOUBLE THEN 1 ELSE 0 END AS bin FROM g WHERE conf BETWEEN 0 AND 1) SELECT CAST(k AS INTEGER) AS bin, count(bin) AS n FROM (SELECT unnest(range(0, 10)) AS k) LEFT JOIN x ON bin = k GROUP BY k")
def score_histogram(spark, sf_dir):
    return qc.histogram(genes(spark, sf_dir), "confidence_score")


@PLANS.add(f"""WITH c AS (SELECT o_orderkey AS gene_id, {SPLICE} AS conf FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey AS gene_id, {SPLICE} AS splice FROM orders WHERE o_orderkey % 4 <> 1), h AS (SELECT o_orderkey AS gene_id, {HOM} AS hom FROM orders WHERE o_orderkey % 5 <> 2)
SELECT gene_id, conf, splice, hom FROM c FULL JOIN s USING (gene_id) FULL JOIN h USING (gene_id)""")
def qc_outer_combine(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "gene_id")
    pick = lambda test, rule, name: rows.filter(test).select("gene_id", F.expr(rule.replace("o_orderkey", "gene_id")).alias(name))
    return qc.combine(pick("gene_id % 3 <> 0", SPLICE, "conf"), pick("gene_id % 4 <> 1", SPLICE, "splice"), pick("gene_id % 5 <> 2", HOM, "hom"))


@PLANS.add("SELECT s_suppkey AS ord, 100000 + s_suppkey * 37 AS length, CAST(coalesce(sum(100000 + s_suppkey * 37) OVER (ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM supplier")
def cumulative_offsets(spark, sf_dir):
    from ..operators.intervals import offsets

    return offsets(scaffolds(spark, sf_dir).select("ord", "length"), "length", "ord")


CHUNK_SQL = """cn AS (SELECT s_name AS seqid, s_suppkey AS ord, 100000 + s_suppkey * 37 AS length, greatest(1, (100000 + s_suppkey * 37) // 30000 + CASE WHEN (100000 + s_suppkey * 37) % 30000 >= 10000 THEN 1 ELSE 0 END) AS n FROM supplier),
cu AS (SELECT *, unnest(range(0, n)) AS k FROM cn),
ck AS (SELECT seqid, ord, k * 30000 AS start, CASE WHEN k = n - 1 THEN length ELSE (k + 1) * 30000 END AS "end", printf('chunk_%04d', row_number() OVER (ORDER BY ord, k) - 1) AS chunk_id FROM cu)"""


def scaffolds(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("s_name AS seqid", "s_suppkey AS ord", "100000 + s_suppkey * 37 AS length")


def ordered_scaffolds(spark, sf_dir):
    """seqid of the scaffolds that regions and points made from orders lie on (by o_custkey)."""
    keys = table(spark, sf_dir, "orders").selectExpr("o_custkey % 50 + 1 AS ord").distinct()
    return scaffolds(spark, sf_dir).join(keys.hint("merge"), "ord", "left_semi").select("seqid")


@PLANS.add(f"WITH {CHUNK_SQL} SELECT * FROM ck")
def fixed_chunks(spark, sf_dir):
    return planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000)


@PLANS.add(f"""WITH {EXONS}, gs AS (SELECT seqid, gene, min(s) AS start, max(e) AS "end" FROM exons GROUP BY ALL), r AS (SELECT *, (row_number() OVER (PARTITION BY seqid ORDER BY start, "end", gene) - 1) // 100 AS batch FROM gs)
SELECT seqid, batch, count(*) AS n_genes, min(start) AS start, max("end") AS "end" FROM r GROUP BY seqid, batch""")
def gene_batches(spark, sf_dir):
    spans = exons(spark, sf_dir).groupBy("seqid", "gene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return planning.gene_batches(spans, 100)


@PLANS.add("""WITH r AS (SELECT l_orderkey AS gene, l_linenumber % 2 = 0 AS contained, l_partkey % 5 AS seqid, l_suppkey AS chunk_start, l_quantity AS value FROM lineitem),
d AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN contained THEN 0 ELSE 1 END, seqid, chunk_start, value) AS i FROM r) SELECT gene, contained, seqid, chunk_start, value FROM d WHERE i = 1""")
def merge_dedupe_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS gene", "l_linenumber % 2 = 0 AS contained", "l_partkey % 5 AS seqid", "l_suppkey AS chunk_start", "l_quantity AS value")
    return planning.first_by_priority(rows, "gene", [F.when(F.col("contained"), 0).otherwise(1), F.col("seqid"), F.col("chunk_start"), F.col("value")])


@PLANS.add("""WITH l AS (SELECT event_id AS line_no, user_id AS file, CASE WHEN event_type = 'purchase' THEN event_id % 2 END AS flag FROM events),
c AS (SELECT line_no, file, last_value(flag IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS flag FROM l) SELECT * FROM c WHERE flag = 1""")
def carry_forward_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id AS line_no", "user_id AS file", "CASE WHEN event_type = 'purchase' THEN event_id % 2 END AS flag")
    return planning.carry_forward(rows, "line_no", "flag", ["file"]).filter("flag = 1")


@PLANS.add(f"WITH {GENES} SELECT gene % 50 AS seqid, round(median(conf), 6) AS median_score, round(stddev_pop(conf), 6) AS spread FROM g GROUP BY 1 ORDER BY median_score, seqid LIMIT 30")
def scaffold_median_topn(spark, sf_dir):
    found = genes(spark, sf_dir).groupBy((F.col("gene") % 50).alias("seqid")).agg(F.round(F.median("confidence_score"), 6).alias("median_score"), F.round(F.stddev_pop("confidence_score"), 6).alias("spread"))
    return found.orderBy("median_score", "seqid").limit(30)


@PLANS.add(f"WITH {HITS}, t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY evalue, ord) AS i FROM h) SELECT query_id, subject_id, evalue, ord FROM t WHERE i <= 2")
def top_hits(spark, sf_dir):
    return gene_tables.top_hits(hits(spark, sf_dir), 2).select("query_id", "subject_id", "evalue", F.col("ord").cast("long").alias("ord"))


SCORES = f"""k AS (SELECT o_orderkey AS gene, {CONF} AS conf, {HOM} AS cov, {share('o_orderkey % 83')} AS exon_min, {share('o_orderkey % 199')} AS entropy, {share('o_orderkey % 103')} AS sharp, o_orderkey % 7 AS introns,
 CASE o_orderkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' ELSE 'no_hit' END AS status FROM orders)"""


def score_columns(spark, sf_dir):
    rules = {"conf": CONF, "cov": HOM, "exon_min": share("o_orderkey % 83"), "entropy": share("o_orderkey % 199"), "sharp": share("o_orderkey % 103"), "introns": "o_orderkey % 7", "status": "CASE o_orderkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' ELSE 'no_hit' END"}
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gene"), *(F.expr(rule).alias(name) for name, rule in rules.items()))


@PLANS.add(f"""WITH {SCORES} SELECT gene, concat_ws(',', CASE WHEN conf < 0.5::DOUBLE THEN 'VERY_LOW_CONF' WHEN conf < 0.7::DOUBLE THEN 'LOW_CONF' END, CASE WHEN exon_min < 0.5::DOUBLE THEN 'WEAK_EXON' END, CASE WHEN entropy > 1.5::DOUBLE THEN 'HIGH_ENTROPY' END, CASE WHEN sharp < 0.6::DOUBLE THEN 'UNCERTAIN_BOUND' END,
 CASE WHEN introns > 4 THEN 'UNSUP_JUNCTION' END, CASE WHEN introns > 5 THEN 'NON_CANON_SPLICE' END, CASE WHEN status = 'no_hit' THEN 'NO_HOMOLOGY' END, CASE WHEN status = 'partial' OR (cov > 0 AND cov < 0.8::DOUBLE) THEN 'PARTIAL_HOMOLOGY' END) AS flags FROM k""")
def qc_flag_rules(spark, sf_dir):
    c = F.col
    marks = F.concat(
        qc.confidence_flags(c("conf"), c("exon_min"), c("entropy"), c("sharp")),
        qc.splice_flags(c("introns") - 4, c("introns") - 5, F.lit(0), F.lit(100)),
        qc.homology_flags(c("status"), c("cov"), F.lit(False), F.lit(False), F.lit(0)),
    )
    return score_columns(spark, sf_dir).select("gene", F.array_join(marks, ",").alias("flags"))


@PLANS.add(f"""WITH {SCORES} SELECT gene, round(coalesce(CASE WHEN cov > 0 AND entropy > 0 THEN cov * (CASE WHEN entropy > 1 THEN entropy / 100 ELSE entropy END) END, CASE status WHEN 'complete' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END), 6) AS homology_score,
 round(CASE WHEN introns > 0 THEN 0.6::DOUBLE * (introns // 2) / introns + 0.4::DOUBLE * (introns // 3) / introns END, 6) AS splice_score FROM k""")
def evidence_scores(spark, sf_dir):
    c = F.col
    half, third = F.floor(c("introns") / 2), F.floor(c("introns") / 3)
    return score_columns(spark, sf_dir).select("gene", F.round(qc.homology_score(c("cov"), c("entropy"), c("status")), 6).alias("homology_score"), F.round(qc.splice_score(half, c("introns"), third), 6).alias("splice_score"))


@PLANS.add(f"""WITH {EXONS}, r AS (SELECT DISTINCT o_orderkey % 5 AS seqid, o_orderkey AS region_id, o_orderkey * 1000 AS rs, o_orderkey * 1000 + 450 AS re FROM orders)
SELECT region_id, count(gene) AS n_reads FROM r LEFT JOIN exons x ON x.seqid = r.seqid AND s < re AND rs < e GROUP BY region_id""")
def region_read_count(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 5 AS seqid", "o_orderkey AS region_id", "o_orderkey * 1000 AS start", "o_orderkey * 1000 + 450 AS end").distinct()
    return gene_tables.read_count(exons(spark, sf_dir), wanted)

"""Composite queries: gene confidence, splice decisions, validation, coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import runs
from ..functions import regions
from ..operators import confidence, homology, planning, predictions, report, splice
from .annotation import HITS, STATUS, hits, ordered_scaffolds, scaffolds, statuses
from .binding import JUNCTIONS, Plans, gene_introns, table
from .binding import junctions as bound_junctions
from .signals import PROBS, probabilities

PLANS = Plans()


@PLANS.add("""SELECT o_orderkey AS k, 'chr' || o_custkey % 9 AS seqid, o_orderkey * 10 AS start, o_orderkey * 10 + o_custkey AS "end", 'chr' || o_custkey % 9 || ':' || (o_orderkey * 10 + 1) || '-' || (o_orderkey * 10 + o_custkey) AS shown FROM orders WHERE o_custkey >= 1""")
def region_parse(spark, sf_dir):
    text = F.expr("concat('chr', o_custkey % 9, ':', o_orderkey * 10 + 1, if(o_orderkey % 2 = 0, '-', '..'), o_orderkey * 10 + o_custkey)")
    found = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), regions.parse(text).alias("r")).filter("r IS NOT NULL").select("k", "r.*")
    return found.withColumn("shown", regions.render(F.col("seqid"), F.col("start"), F.col("end")))


OFFSETS = 'ix AS (SELECT s_name AS seqid, 100000 + s_suppkey * 37 AS length, coalesce(sum(100000 + s_suppkey * 37) OVER (ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM supplier)'


@PLANS.add(f"WITH {OFFSETS}, p AS (SELECT event_id, event_id * 997 AS array_pos FROM events) SELECT event_id, seqid, CAST(array_pos - o AS BIGINT) AS pos FROM p JOIN ix ON array_pos >= o AND array_pos < o + length")
def array_to_genomic(spark, sf_dir):
    points = table(spark, sf_dir, "events").selectExpr("event_id", "event_id * 997 AS array_pos")
    return predictions.to_genomic(points, predictions.coordinate_index(scaffolds(spark, sf_dir))).select("event_id", "seqid", "pos")


CHUNKS = """c0 AS (SELECT s_name AS seqid, s_suppkey AS ord, 100000 + s_suppkey * 37 AS length, greatest(1, (100000 + s_suppkey * 37) // 30000 + CASE WHEN (100000 + s_suppkey * 37) % 30000 >= 10000 THEN 1 ELSE 0 END) AS n FROM supplier),
u0 AS (SELECT *, unnest(range(0, n)) AS k FROM c0),
chunks AS (SELECT seqid, printf('chunk_%04d', row_number() OVER (ORDER BY ord, k) - 1) AS chunk_id, k * 30000 AS low, CASE WHEN k = n - 1 THEN length ELSE (k + 1) * 30000 END AS high, CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand FROM u0)"""


@PLANS.add(f"""WITH {CHUNKS}, r AS (SELECT o_orderkey AS region_id, s_name AS seqid, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, o_orderkey % 90000 AS rs, o_orderkey % 90000 + 5000 AS re FROM orders JOIN supplier ON s_suppkey = o_custkey % 50 + 1)
SELECT region_id, chunk_id, CASE WHEN strand = '+' THEN greatest(rs, low) - low ELSE high - least(re, high) END AS slice_start, CASE WHEN strand = '+' THEN least(re, high) - low ELSE high - greatest(rs, low) END AS slice_end
FROM r JOIN chunks USING (seqid, strand) WHERE rs < high AND low < re""")
def chunk_slices(spark, sf_dir):
    chunks = planning.size_chunks(scaffolds(spark, sf_dir), 30000, 10000, ordered_scaffolds(spark, sf_dir))
    reverse = F.floor(F.col("start") / 30000) % 2 == 1
    chunks = predictions.chunk_index(chunks.select("seqid", "chunk_id", F.when(reverse, F.col("end")).otherwise(F.col("start")).alias("start"), F.when(reverse, F.col("start")).otherwise(F.col("end")).alias("end")))
    names = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k", "s_name AS seqid")
    wanted = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS region_id", "o_custkey % 50 + 1 AS k", "CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand", "o_orderkey % 90000 AS region_start", "o_orderkey % 90000 + 5000 AS region_end").join(names, "k")
    return predictions.chunk_slices(wanted, chunks).select("region_id", "chunk_id", "slice_start", "slice_end")


DECIDED = JUNCTIONS + """,
near AS (SELECT i.gene, i.intron_start, j.s, j.e, j.reads, abs(intron_start - j.s) + abs(intron_end - j.e) AS shift, row_number() OVER (PARTITION BY i.gene, intron_start ORDER BY j.reads DESC, abs(intron_start - j.s) + abs(intron_end - j.e), j.s, j.e) AS r
 FROM introns i JOIN junctions j ON i.seqid = j.seqid AND abs(intron_start - j.s) <= 15 AND abs(intron_end - j.e) <= 15 AND (j.strand = i.strand OR j.strand = '.') AND j.reads >= 3),
dec AS (SELECT i.seqid, i.gene, i.strand, i.intron_start, i.intron_end, CASE WHEN x.reads IS NOT NULL THEN 'exact' WHEN n.reads IS NOT NULL THEN 'nearby' ELSE 'keep' END AS decision,
 CASE WHEN x.reads IS NULL AND n.reads IS NOT NULL THEN n.s ELSE i.intron_start END AS new_start, CASE WHEN x.reads IS NULL AND n.reads IS NOT NULL THEN n.e ELSE i.intron_end END AS new_end, coalesce(x.reads, n.reads, 0) AS support,
 CASE WHEN x.reads IS NULL AND n.reads IS NOT NULL THEN 0.7::DOUBLE * least(1.0, ln(1 + n.reads) / ln(101)) + 0.3::DOUBLE * greatest(0.0, 1 - shift / 15) END AS confidence
 FROM introns i LEFT JOIN junctions x ON x.seqid = i.seqid AND x.s = i.intron_start AND x.e = i.intron_end LEFT JOIN near n ON n.r = 1 AND n.gene = i.gene AND n.intron_start = i.intron_start)"""


def decisions(spark, sf_dir):
    blank = F.lit(None).cast("string")
    introns = gene_introns(spark, sf_dir).withColumns({"donor": F.lit("GT"), "acceptor": F.lit("AG"), "donor_window": blank, "acceptor_window": blank})
    return splice.refine_introns(introns, bound_junctions(spark, sf_dir))


@PLANS.add(f"WITH {DECIDED} SELECT gene, intron_start, intron_end, decision, new_start, new_end, support, round(confidence, 6) AS confidence FROM dec")
def splice_decisions(spark, sf_dir):
    return decisions(spark, sf_dir).select("gene", "intron_start", "intron_end", "decision", "new_start", "new_end", "support", F.round("confidence", 6).alias("confidence"))


@PLANS.add(f"""WITH {DECIDED}, g AS (SELECT gene, count(*) AS n_introns, count(*) FILTER (support >= 3) AS n_supported, count(*) FILTER (new_start <> intron_start OR new_end <> intron_end) AS n_corrected FROM dec GROUP BY gene)
SELECT gene, n_introns, n_supported, n_corrected, round(n_supported / n_introns, 6) AS support_ratio, concat_ws(';', CASE WHEN n_supported < n_introns THEN 'unsupported_introns:' || (n_introns - n_supported) END, CASE WHEN n_corrected > 0 THEN 'corrected_introns:' || n_corrected END) AS flags FROM g""")
def splice_report(spark, sf_dir):
    found = splice.report(decisions(spark, sf_dir))
    return found.select("gene", "n_introns", "n_supported", "n_corrected", F.round("support_ratio", 6).alias("support_ratio"), F.array_join("flags", ";").alias("flags"))


@PLANS.add(f"""WITH {DECIDED} SELECT count(DISTINCT gene) AS n_genes, count(*) AS n_introns, round(count(*) FILTER (support >= 3) / count(*), 6) AS supported_rate, round(count(*) FILTER (new_start <> intron_start OR new_end <> intron_end) / count(*), 6) AS corrected_rate FROM dec""")
def splice_summary(spark, sf_dir):
    found = report.splice_summary(splice.report(decisions(spark, sf_dir)))
    return found.select("n_genes", "n_introns", F.round("supported_rate", 6).alias("supported_rate"), F.round("corrected_rate", 6).alias("corrected_rate"))


@PLANS.add(f"""WITH {STATUS}, s2 AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM h), u AS (SELECT * FROM s2 WHERE i = 1),
p AS (SELECT query_id, lead(query_start) OVER w - query_end AS gap FROM u WINDOW w AS (PARTITION BY query_id ORDER BY query_start, fo)), ch AS (SELECT DISTINCT query_id FROM p WHERE gap IS NOT NULL AND greatest(0, -gap) <= 10)
SELECT st.query_id, CASE WHEN st.query_id % 11 = 0 THEN 'te_overlap' WHEN ch.query_id IS NOT NULL THEN 'chimeric' ELSE status END AS status FROM st LEFT JOIN ch USING (query_id)""")
def validation_precedence(spark, sf_dir):
    chimeric = homology.chimeras(hits(spark, sf_dir)).select("query_id", F.lit(True).alias("chimeric"))
    found = statuses(spark, sf_dir).join(chimeric, "query_id", "left")
    final = homology.precedence(F.col("status"), F.coalesce("chimeric", F.lit(False)), F.col("query_id") % 11 == 0, F.lit(False))
    return found.select("query_id", final.alias("status"))


@PLANS.add(f"""WITH {PROBS}, b AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id, pos) - 1 AS pos, count(*) OVER (PARTITION BY label) AS n, list_max(probs) AS top, probs[3] AS q, CASE WHEN list_position(probs, list_max(probs)) = 3 THEN 1.0 ELSE 0.0 END AS cds,
 -list_sum(list_transform(probs, lambda x: greatest(x, 1e-10) * log2(greatest(x, 1e-10)))) AS bits FROM p),
xs AS (SELECT label, CASE WHEN pos < n // 2 THEN 0 ELSE 1 END AS exon, avg(top) AS score, (avg(cds) + avg(q) + 1 - least(1.0, 4 * var_pop(q))) / 3 AS cons FROM b WHERE pos < n // 2 OR pos >= n // 2 + 5 GROUP BY ALL),
ex AS (SELECT label, min(score) AS worst, avg(cons) AS cons FROM xs GROUP BY label), d AS (SELECT label, pos, n, abs(top - lag(top) OVER (PARTITION BY label ORDER BY pos)) AS step FROM b),
bd AS (SELECT DISTINCT label, n, unnest([0, n // 2, n // 2 + 5, n]) AS edge FROM b), sh AS (SELECT bd.label, edge, least(1.0, 2 * max(step)) AS v FROM bd JOIN d ON d.label = bd.label AND d.pos BETWEEN edge - 9 AND edge + 9 WHERE bd.n >= 40 AND edge >= 20 AND edge < bd.n - 20 GROUP BY ALL),
sm AS (SELECT label, avg(v) AS v FROM sh GROUP BY label), g AS (SELECT label, avg(top) AS m, min(top) AS mn, avg(bits) AS ent FROM b GROUP BY label)
SELECT g.label AS gene_id, round(m, 6) AS mean_prob, round(mn, 6) AS min_prob, round(ent, 6) AS mean_entropy, round(coalesce(v, 0.5), 6) AS boundary_sharpness, round(cons, 6) AS coding_consistency, round(worst, 6) AS worst_exon_score,
 round(0.30::DOUBLE * m + 0.20::DOUBLE * mn + 0.20::DOUBLE * coalesce(v, 0.5) + 0.15::DOUBLE * cons + 0.15::DOUBLE * worst, 6) AS overall_score FROM g JOIN ex USING (label) LEFT JOIN sm USING (label)""")
def gene_confidence(spark, sf_dir):
    """Each label is a gene with as many bases as its vectors give, and two exons."""
    genes = label_genes(spark, sf_dir)
    names = ["mean_prob", "min_prob", "mean_entropy", "boundary_sharpness", "coding_consistency", "worst_exon_score", "overall_score"]
    return confidence.score_genes(genes).select("gene_id", *(F.round(n, 6).alias(n) for n in names))


def label_genes(spark, sf_dir):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "pos", "probs"))), lambda x: x["probs"])
    genes = probabilities(spark, sf_dir).groupBy(F.col("label").alias("gene_id")).agg(listed.alias("probs"), F.count("*").alias("length"))
    half = F.floor(F.col("length") / 2)
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    return genes.withColumn("exons", F.array(span(F.lit(0), half), span(half + 5, F.col("length")))).withColumn("cds", F.col("exons"))


@PLANS.add(f"""WITH {HITS}, sg AS (SELECT * FROM h WHERE evalue <= 0.05 AND identity >= 30), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY evalue, ord) AS i, count(*) OVER (PARTITION BY query_id) AS n_hits FROM sg),
st AS (SELECT query_id, n_hits, CASE WHEN (query_end - query_start + 1) / query_length >= 0.2 AND (subject_end - subject_start + 1) / subject_length >= 0.1 THEN 'complete' ELSE 'partial' END AS status FROM r WHERE i = 1),
s2 AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY evalue, ord) AS i, min(ord) OVER (PARTITION BY query_id, subject_id) AS fo FROM sg), u AS (SELECT * FROM s2 WHERE i = 1),
p AS (SELECT query_id, lead(query_start) OVER (PARTITION BY query_id ORDER BY query_start, fo) - query_end AS gap FROM u), ch AS (SELECT DISTINCT query_id FROM p WHERE gap IS NOT NULL AND greatest(0, -gap) <= 10),
l AS (SELECT *, lead(subject_start) OVER (PARTITION BY subject_id ORDER BY subject_start, fo, query_id) AS nxt FROM u), f AS (SELECT * FROM l WHERE nxt IS NULL OR subject_end - nxt <= 50),
q AS (SELECT DISTINCT subject_id, unnest(range(subject_start, subject_end + 1)) AS pos FROM f), cv AS (SELECT subject_id FROM q GROUP BY 1 HAVING count(*) / 400 >= 0.8), n AS (SELECT subject_id FROM f GROUP BY 1 HAVING count(*) > 1), fr AS (SELECT DISTINCT query_id FROM f JOIN cv USING (subject_id) JOIN n USING (subject_id)),
a AS (SELECT o_orderkey AS query_id FROM orders UNION SELECT query_id FROM h)
SELECT query_id AS gene_id, coalesce(n_hits, 0) AS n_hits, CASE WHEN fr.query_id IS NOT NULL THEN 'fragmented' WHEN ch.query_id IS NOT NULL THEN 'chimeric' ELSE coalesce(status, 'no_hit') END AS status FROM a LEFT JOIN st USING (query_id) LEFT JOIN ch USING (query_id) LEFT JOIN fr USING (query_id)""")
def homology_run(spark, sf_dir):
    genes = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene_id")
    found = runs.validate(genes, hits(spark, sf_dir), limits=homology.Thresholds(evalue=0.05, complete_query=0.2, complete_subject=0.1))
    return found.select("gene_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "status")

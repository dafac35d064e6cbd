"""Queries on per-base signals and class probabilities."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import confidence, intervals
from .binding import Plans, table

PLANS = Plans()


def signal(spark, sf_dir):
    """user_id, pos (from 0) and value of every event in time order."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "value")


SIGNAL = "s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, value FROM events)"


@PLANS.add(f"""WITH {SIGNAL}, low AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS run FROM s WHERE value < 40)
SELECT user_id, min(pos) AS start, max(pos) + 1 AS "end", round(avg(value), 6) AS score FROM low GROUP BY user_id, run HAVING count(*) >= 4""")
def low_conf_runs(spark, sf_dir):
    return intervals.islands(signal(spark, sf_dir), ["user_id"], "pos", "value", 40, 4).withColumn("score", F.round("score", 6))


@PLANS.add(f"WITH {SIGNAL} SELECT user_id, pos, round(CASE WHEN count(*) OVER (PARTITION BY user_id) < 20 THEN value ELSE sum(value) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) / 20 END, 6) AS smoothed FROM s")
def rolling_smooth(spark, sf_dir):
    return intervals.smooth(signal(spark, sf_dir), ["user_id"], "pos", "value").select("user_id", "pos", F.round("smoothed", 6).alias("smoothed"))


def probabilities(spark, sf_dir):
    """vec_id, pos, label and a distribution over four classes: every four numbers of a vector are a base."""
    quads = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 4).cast("int") - 1), lambda k: F.transform(F.slice("embedding", 4 * k + 1, 4), lambda x: F.exp(x.cast("double"))))
    found = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode(quads).alias("pos", "e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return found.select("vec_id", F.col("pos").cast("long").alias("pos"), "label", F.transform("e", lambda x: x / total).alias("probs"))


PROBS = """e0 AS (SELECT vec_id, label, embedding, unnest(range(0, len(embedding) // 4)) AS pos FROM embeddings),
e AS (SELECT vec_id, pos, label, list_transform(embedding[4 * pos + 1:4 * pos + 4], lambda x: exp(CAST(x AS DOUBLE))) AS e FROM e0),
p AS (SELECT vec_id, pos, label, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM e)"""


@PLANS.add(f"WITH {PROBS} SELECT vec_id, pos, round(-list_sum(list_transform(probs, lambda x: greatest(x, 1e-10) * log2(greatest(x, 1e-10)))), 6) AS entropy, round(list_max(probs), 6) AS max_prob FROM p")
def entropy_maxprob(spark, sf_dir):
    return probabilities(spark, sf_dir).select("vec_id", "pos", F.round(confidence.entropy(F.col("probs")), 6).alias("entropy"), F.round(F.array_max("probs"), 6).alias("max_prob"))


@PLANS.add(f"WITH {PROBS} SELECT vec_id, pos, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS class FROM p")
def argmax_class(spark, sf_dir):
    return probabilities(spark, sf_dir).select("vec_id", "pos", confidence.call(F.col("probs")).alias("class"))


@PLANS.add(f"""WITH {SIGNAL}, n AS (SELECT user_id, count(*) AS n FROM s GROUP BY 1), d AS (SELECT user_id, pos, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY pos)) / 1000 AS step FROM s),
b AS (SELECT user_id, n, unnest(range(0, n, 7)) AS b FROM n), used AS (SELECT * FROM b WHERE b >= 20 AND b < n - 20),
m AS (SELECT u.user_id, b, least(1.0, 2 * max(step)) AS v FROM used u JOIN d ON d.user_id = u.user_id AND pos BETWEEN b - 9 AND b + 9 WHERE n >= 40 GROUP BY ALL),
r AS (SELECT user_id, avg(v) AS v FROM m GROUP BY 1)
SELECT n.user_id, round(coalesce(v, 0.5), 6) AS sharpness FROM n LEFT JOIN r USING (user_id)""")
def boundary_sharpness(spark, sf_dir):
    values = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"] / 1000)
    rows = signal(spark, sf_dir).groupBy("user_id").agg(values.alias("v"))
    boundaries = F.sequence(F.lit(0), F.size("v") - 1, F.lit(7))
    return rows.select("user_id", F.round(confidence.sharpness(F.col("v"), boundaries), 6).alias("sharpness"))


@PLANS.add(f"WITH {PROBS}, c AS (SELECT label, CASE WHEN list_position(probs, list_max(probs)) = 3 THEN 1.0 ELSE 0.0 END AS cds, probs[3] AS q FROM p) SELECT label, round((avg(cds) + avg(q) + 1 - least(1.0, 4 * var_pop(q))) / 3, 6) AS consistency FROM c GROUP BY label")
def coding_consistency(spark, sf_dir):
    found = probabilities(spark, sf_dir).select("label", (confidence.call(F.col("probs")) == 2).alias("cds"), F.col("probs")[2].alias("q"))
    return found.groupBy("label").agg(F.round(confidence.consistency(F.col("cds"), F.col("q")), 6).alias("consistency"))


METRICS = {
    "mean_prob": "0.5 + (o_orderkey % 51) / 100.0",
    "min_prob": "0.2 + (o_orderkey % 67) / 100.0",
    "boundary_sharpness": "0.4 + (o_orderkey % 61) / 100.0",
    "coding_consistency": "0.5 + (o_orderkey % 47) / 100.0",
    "worst_exon_score": "0.45 + (o_orderkey % 53) / 100.0",
    "mean_entropy": "(o_orderkey % 170) / 100.0",
}


def as_double(expression: str) -> str:
    """The same rule in double precision in both engines."""
    low, high = (expression.split(" + ") if " + " in expression else ("0", expression))
    return f"(CAST({low} AS DOUBLE) + CAST({high.removesuffix(' / 100.0')} AS DOUBLE) / CAST(100 AS DOUBLE))"


METRIC_SQL = ", ".join(f"{as_double(e)} AS {k}" for k, e in METRICS.items())


@PLANS.add(f"""WITH m AS (SELECT o_orderkey AS gene, 100 + o_orderkey % 500 AS length, o_orderkey % 6 AS n_low, {METRIC_SQL} FROM orders),
o AS (SELECT *, 0.30::DOUBLE * mean_prob + 0.20::DOUBLE * min_prob + 0.20::DOUBLE * boundary_sharpness + 0.15::DOUBLE * coding_consistency + 0.15::DOUBLE * worst_exon_score AS score FROM m),
f AS (SELECT *, list_filter([CASE WHEN worst_exon_score < 0.6::DOUBLE THEN 'weak_exon' END, CASE WHEN boundary_sharpness < 0.7::DOUBLE THEN 'uncertain_boundary' END, CASE WHEN mean_entropy > 1 THEN 'high_entropy' END,
 CASE WHEN min_prob < 0.3::DOUBLE THEN 'very_low_min_prob' WHEN min_prob < 0.5::DOUBLE THEN 'low_min_prob' END, CASE WHEN length < 300 AND mean_prob < 0.7::DOUBLE THEN 'short_low_conf' END,
 CASE WHEN n_low > 3 THEN 'many_low_conf_regions' WHEN n_low > 0 THEN 'has_low_conf_regions' END], lambda x: x IS NOT NULL) AS flags FROM o)
SELECT gene, round(score, 6) AS score, array_to_string(flags, ',') AS flags, CASE WHEN list_has_any(flags, ['weak_exon', 'very_low_min_prob', 'many_low_conf_regions']) OR boundary_sharpness < 0.5::DOUBLE OR mean_entropy > 1.5::DOUBLE OR score < 0.7::DOUBLE THEN 'low'
 WHEN score >= 0.85::DOUBLE AND len(flags) = 0 THEN 'high' ELSE 'medium' END AS class FROM f""")
def overall_confidence_class(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS gene", "100 + o_orderkey % 500 AS length", "o_orderkey % 6 AS n_low", *(f"{as_double(e)} AS {k}" for k, e in METRICS.items()))
    rows = rows.withColumn("score", confidence.overall())
    marks = confidence.flags(*(F.col(c) for c in ("length", "mean_prob", "min_prob", "mean_entropy", "boundary_sharpness", "worst_exon_score", "n_low")))
    rows = rows.withColumn("marks", marks)
    return rows.select("gene", F.round("score", 6).alias("score"), F.array_join("marks", ",").alias("flags"), confidence.confidence_class(F.col("score"), F.col("marks"), F.col("mean_entropy"), F.col("boundary_sharpness")).alias("class"))

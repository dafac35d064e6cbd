import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from genespark.functions import dna
from genespark.operators import confidence, evidence, homology, intervals, planning, qc


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("r")).first().r


def random_spans(rng, n, top=3000, longest=400):
    rows = []
    for k in range(n):
        s = rng.randint(0, top)
        rows.append((rng.randint(0, 2), s, s + rng.randint(1, longest), k))
    return rows


def test_overlap_join_gives_each_pair_once(spark):
    rng = random.Random(1)
    a, b = random_spans(rng, 120), random_spans(rng, 90)
    left = spark.createDataFrame(a, "seqid int, s1 int, e1 int, i int")
    right = spark.createDataFrame(b, "seqid int, s2 int, e2 int, j int")
    got = sorted((r.i, r.j) for r in intervals.overlap_join(left, right, ["seqid"], ("s1", "e1"), ("s2", "e2"), 128).collect())
    assert got == sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])


def test_band_join(spark):
    rng = random.Random(2)
    a, b = [(rng.randint(0, 2), rng.randint(0, 900), k) for k in range(100)], [(rng.randint(0, 2), rng.randint(0, 900), k) for k in range(100)]
    left, right = spark.createDataFrame(a, "seqid int, x int, i int"), spark.createDataFrame(b, "seqid int, y int, j int")
    want = sorted((p[2], q[2]) for p in a for q in b if p[0] == q[0] and abs(p[1] - q[1]) <= 15)
    assert sorted((r.i, r.j) for r in intervals.band_join(left, right, ["seqid"], "x", "y", 15).collect()) == want
    outer = intervals.band_join(left, right, ["seqid"], "x", "y", 15, "left").collect()
    assert len(outer) == len(want) + len({p[2] for p in a} - {i for i, _ in want})


@pytest.mark.parametrize("size", [64, 1 << 14])
def test_merge_and_coverage(spark, size):
    rows = random_spans(random.Random(3), 80)
    df = spark.createDataFrame(rows, "seqid int, start int, end int, k int")
    depth = {}
    for key, s, e, _ in rows:
        for p in range(s, e):
            depth[key, p] = depth.get((key, p), 0) + 1
    merged = intervals.merge(df, ["seqid"], size=size)
    spans = sorted((r.seqid, r.start, r.end) for r in merged.collect())
    assert {(k, p) for k, s, e in spans for p in range(s, e)} == set(depth)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:]))
    runs = intervals.coverage_runs(df, ["seqid"], size=size).collect()
    assert {(r.seqid, p): r.depth for r in runs for p in range(r.start, r.end)} == depth
    assert sorted((r.seqid, r.start, r.end) for r in intervals.merge(merged, ["seqid"], size=size).collect()) == spans


def test_sequences(spark):
    s = F.col("s")
    assert one(spark, dna.reverse_complement(s), s="ACGTNacgtRY") == "RYacgtNACGT"
    assert one(spark, dna.reverse_complement_strict(s), s="ACX") == "NGT"
    assert one(spark, dna.gc_content(s), s="GGNNCA") == 0.75 and one(spark, dna.gc_content(s), s="NN") == 0.0
    assert one(spark, dna.translate(s), s="ATGgcuNNNTAATG") == "MAX*"
    assert one(spark, dna.translate(s, True), s="ATGTAAGCC") == "M"
    assert one(spark, dna.splice_type(F.lit("gt"), F.lit("ag"))) == "GT-AG"
    assert one(spark, dna.kozak_score(s), s="ACCATGG") == pytest.approx((0.5 + 0.4 + 0.5 + 0.5) / 4)
    assert one(spark, dna.pwm_score(s, dna.DONOR), s="CAGGTAAGT") > 5 and one(spark, dna.pwm_score(s, dna.DONOR), s="CAG") is None
    assert one(spark, dna.inframe(s, dna.STOPS), s="TAAATAGTGA") == [0]
    with pytest.raises(Exception, match="multiple of 3"):
        one(spark, dna.translate_strict(s), s="ACGT")


def test_evidence_rules(spark):
    aed = lambda j, c, b: one(spark, evidence.edit_distance(F.lit(j), F.lit(c), F.lit(b)))
    assert aed(1.0, 1.0, 1.0) == 0 and aed(0.0, 0.0, 0.0) == 1 and aed(0.5, 1.0, 1.0) == 0.25
    level = lambda n, j, c: one(spark, evidence.level(F.lit(n), F.lit(j), F.lit(c)))
    assert [level(0, 1.0, c) for c in (0.8, 0.5, 0.1, 0.0)] == ["full", "partial", "minimal", "none"]
    assert [level(3, 1.0, 0.8), level(3, 1.0, 0.0), level(3, 0.5, 0.5), level(3, 0.4, 0.0), level(3, 0.0, 0.0)] == ["full", "partial", "partial", "minimal", "none"]


def test_confidence_of_genes(spark):
    p = lambda c, k: [c if i == k else (1 - c) / 3 for i in range(4)]
    good, weak = [p(0.97, 2)] * 60 + [p(0.97, 3)] * 60 + [p(0.97, 2)] * 60, [p(0.4, 2)] * 120 + [p(0.9, 0)] * 60
    span = [(0, 60), (120, 500)]
    rows = [("a", 1000, good, span, span), ("b", 200, weak, span, span), ("c", 10, [], span, [])]
    kind = "array<struct<start:long,end:long>>"
    got = {r.gene_id: r for r in confidence.score_genes(spark.createDataFrame(rows, f"gene_id string, length long, probs array<array<double>>, exons {kind}, cds {kind}")).collect()}
    assert got["a"].mean_prob == pytest.approx(0.97) and got["a"].coding_consistency == pytest.approx((1 + 0.97 + 1) / 3)
    assert got["b"].confidence_class == "low" and got["b"].n_low_regions == 1 and "very_low_min_prob" not in got["b"].flags and "low_min_prob" in got["b"].flags
    assert (got["c"].overall_score, got["c"].mean_entropy, got["c"].confidence_class, got["c"].flags) == (0.0, 2.0, "low", ["scoring_error"])


def test_quality_control(spark):
    tier = lambda c, *f: one(spark, qc.tier(F.lit(c).cast("double"), F.array(*map(F.lit, f)).cast("array<string>")))
    assert [tier(0.9), tier(0.75), tier(0.55), tier(0.4), tier(None)] == ["high", "medium", "low", "reject", "high"]
    assert [tier(0.9, "INTERNAL_STOP"), tier(0.9, "CHIMERIC"), tier(0.9, "UNSUP_JUNCTION"), tier(0.9, "NO_HOMOLOGY")] == ["reject", "low", "medium", "high"]
    aed = lambda *x: one(spark, qc.combined_aed(*(F.lit(v).cast("double") for v in x)))
    assert aed(0.0, 1.0, 1.0) == 0 and aed(None, None, None) is None and aed(0.5, None, None) == pytest.approx(0.5) and aed(0.5, 0.0, None) == pytest.approx(0.75)
    assert len(qc.REGISTRY) == 25
    rows = spark.createDataFrame([("a", 0.9, None, ["NO_HOMOLOGY"], "high"), ("b", 0.9, 0.5, ["CHIMERIC"], "high")], "gene_id string, confidence_score double, homology_score double, flags array<string>, tier string")
    reasons = lambda name: [r.fail_reason for r in qc.apply_filter(rows, qc.PRESETS[name]).orderBy("gene_id").collect()]
    assert reasons("has_homology") == ["min_homology_score", None] and reasons("high_confidence") == [None, "max_severity"]
    custom = qc.Criteria(custom=lambda: F.col("homology_score").isNotNull(), max_flags=0)
    assert [r.fail_reason for r in qc.apply_filter(rows, custom).collect()] == ["max_flag_count"] * 2
    assert one(spark, qc.homology_score(F.lit(0.5), F.lit(80.0), F.lit("partial"))) == pytest.approx(0.4)


def test_homology(spark):
    rows = [("q", "s1", 90.0, 1, 100, 1, 100, 1e-30, 220, 200, 1), ("q", "s2", 80.0, 105, 220, 1, 100, 1e-20, 220, 200, 2), ("r", "s1", 70.0, 1, 50, 90, 200, 1e-9, 60, 200, 3)]
    hits = spark.createDataFrame(rows, "query_id string, subject_id string, identity double, query_start int, query_end int, subject_start int, subject_end int, evalue double, query_length int, subject_length int, ord int")
    (pair,) = homology.chimeras(hits).collect()
    assert (pair.query_id, pair.subject_a, pair.subject_b, pair.gap, pair.confidence) == ("q", "s1", "s2", 5, 0.85)
    (group,) = homology.fragment_groups(hits).collect()
    assert (group.subject_id, group.n_queries, group.coverage) == ("s1", 2, 1.0)
    best = {r.query_id: r for r in homology.best_hits(hits, ["query_id"]).collect()}
    assert (best["q"].subject_id, best["q"].n_hits, best["q"].n_subjects) == ("s1", 2, 2)


def test_plans(spark):
    scaffolds = spark.createDataFrame([("a", 0, 95), ("b", 1, 5), ("c", 2, 60)], "seqid string, ord int, length long")
    got = [(r.seqid, r.start, r.end, r.chunk_id) for r in planning.size_chunks(scaffolds, 30, 10).orderBy("chunk_id").collect()]
    assert got == [("a", 0, 30, "chunk_0000"), ("a", 30, 60, "chunk_0001"), ("a", 60, 95, "chunk_0002"), ("b", 0, 5, "chunk_0003"), ("c", 0, 30, "chunk_0004"), ("c", 30, 60, "chunk_0005")]
    assert planning.advice(50_000_000, 10, 8, 4) == {"strategy": "scaffold"}


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    names = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(names) and len(names) > 50

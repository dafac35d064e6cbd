"""Depth of exons against a count of every base, and what its plan deals out."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genespark import runs
from genespark.operators import depth, junctions
from genespark.plans import evidence, tables


def counted(exons, blocks):
    found = {}
    for key, seqid, strand, start, end in exons:
        bases = [sum(b[0] == seqid and b[1] == strand and b[2] <= p < b[3] for b in blocks if None not in b) for p in range(start, end)]
        if bases:
            found[key] = (pytest.approx(np.mean(bases)), float(np.median(bases)), min(bases), max(bases))
    return found


@pytest.mark.parametrize("size", [8, 64, 4096])
def test_exon_depth_equals_a_count_of_bases(spark, monkeypatch, size):
    monkeypatch.setattr(depth, "PAIRS", 50)
    rng = random.Random(size)
    place = lambda: (rng.choice("ab"), rng.choice("+-"))
    exons = [(k, *place(), s := rng.randrange(-20, 200), s + rng.randrange(0, 60)) for k in range(120)] + [(200, None, "+", 5, 9)]
    blocks = [(*place(), s := rng.randrange(-40, 230), s + rng.randrange(-5, 50)) for _ in range(150)]  # some end before they start
    blocks += [("a", "+", 30, 31)] * 40 + [(None, "+", 0, 50), ("a", None, 0, 50), ("a", "+", None, 50), ("a", "+", 10, None), ("b", "-", -100, 300)]
    found = runs.exon_depth(
        spark.createDataFrame(exons, "id long, seqid string, strand string, start long, end long"),
        spark.createDataFrame(blocks, "seqid string, strand string, start long, end long").repartition(3),
        ["id"],
        size=size,
    )
    assert {r.id: (r.mean_depth, r.median_depth, r.min_depth, r.max_depth) for r in found.collect()} == counted(exons, blocks)


def test_blocks_of_a_bin_are_one_row(spark):
    blocks = spark.range(50000).selectExpr("'a' AS seqid", "id % 300 AS start", "id % 300 + 20 AS end").repartition(2)
    found = depth.packed_steps(blocks, ["seqid"], 64)
    assert found.count() <= 2 * 5
    assert found.selectExpr("max(size(__step)) AS n").first().n <= 65


def test_exon_details_deals_lines_out_once(spark):
    found = tables.exon_details(spark, "/root/testdata/sf0.001")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [line for line in plan.split("\n") if "- Exchange " in line]
    assert len(exchanges) <= 3, plan  # lines by gene, exons and steps by bin, runs of exons in several bins


def test_evidence_run_deals_lines_out_once(spark):
    found = evidence.evidence_run(spark, "/root/testdata/sf0.001")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line for line in plan.split("\n") if "FileScan" in line and "lineitem" in line]
    assert len(lines) == 1, plan


def test_support_equals_nearest_of_the_last_junctions(spark):
    rng = random.Random(5)
    introns = [(k % 30, rng.choice("ab"), s := rng.randrange(-100, 1200), s + 60 + k % 7) for k in range(200)] + [(99, None, 5, 70)]
    found = [(rng.choice("ab"), s := rng.randrange(-100, 1200), s + 60 + k % 9, "+", rng.randrange(6), k) for k in range(400)]
    found += [(a, s, e, t, 9 - n, n + 1000) for a, s, e, t, n, _ in found[:100]]  # later ones at the same places
    introns = spark.createDataFrame(sorted(set(introns), key=str), "gene long, seqid string, intron_start long, intron_end long")
    found = spark.createDataFrame(found, "seqid string, start long, end long, strand string, reads long, ord long").repartition(3)
    key = ["gene", "seqid", "intron_start", "intron_end"]
    near = junctions.nearest(introns, junctions.last_wins(found, "ord"), 10, key)
    reads = F.coalesce("junction_reads", F.lit(0))
    wanted = near.groupBy("gene").agg(F.count("*"), F.count_if(reads >= 3), F.count_if(F.col("shift") == 0))
    got = junctions.support(introns, found, 10, ["gene"], 3, "ord", 64)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    assert sum(r[3] for r in got.collect()) > 0

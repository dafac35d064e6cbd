import json

from pyspark.sql import functions as F

from genespark.functions import regions
from genespark.operators import predictions, refine, report


def test_coordinates(spark):
    index = predictions.coordinate_index(spark.createDataFrame([("a", 0, 10), ("b", 1, 5)], "seqid string, ord int, length long"))
    points = spark.createDataFrame([("a", 3), ("b", 0), ("b", 5), ("c", 1)], "seqid string, pos long")
    got = {(r.seqid, r.pos): r.array_pos for r in predictions.to_array(points, index).collect()}
    assert got == {("a", 3): 3, ("b", 0): 10}
    back = predictions.to_genomic(spark.createDataFrame([(3,), (10,), (14,), (15,)], "array_pos long"), index, 4)
    assert {(r.array_pos, r.seqid, r.pos) for r in back.collect()} == {(3, "a", 3), (10, "b", 0), (14, "b", 4)}


def test_stranded_regions(spark):
    chunks = predictions.chunk_index(spark.createDataFrame([("p0", "a", 0, 4), ("p1", "a", 4, 8), ("m0", "a", 4, 0), ("m1", "a", 8, 4)], "chunk_id string, seqid string, start long, end long"))
    data = spark.createDataFrame([(c, [[float(10 * n + k)] for k in range(4)]) for n, c in enumerate(["p0", "p1", "m0", "m1"])], "chunk_id string, probs array<array<double>>")
    wanted = spark.createDataFrame([(1, "a", "+", 2, 6), (2, "a", "-", 2, 6)], "region_id int, seqid string, strand string, region_start long, region_end long")
    got = {r.region_id: [p[0] for p in r.probs] for r in predictions.region_probabilities(predictions.chunk_slices(wanted, chunks), data).collect()}
    # Reverse chunks hold their bases from the high end down; regions come in genomic order.
    assert got == {1: [2, 3, 10, 11], 2: [21, 20, 33, 32]}
    assert predictions.has_both_strands(chunks) and predictions.scaffold_lengths(chunks).first().length == 8
    looked = predictions.at_positions(spark.createDataFrame([(5,)], "array_pos long"), data.selectExpr("CASE chunk_id WHEN 'p0' THEN 0 WHEN 'p1' THEN 1 ELSE 9 END AS sample", "probs"), 4)
    assert looked.first().probs == [11.0]


def test_region_strings(spark):
    rows = spark.createDataFrame([("chr1:1-10",), ("x:5..9",), ("c:1,000-2,000",), ("c:0-5",), ("c:9-5",), ("c",), ("c:a-b",)], "t string")
    assert [r.r and tuple(r.r) for r in rows.select(regions.parse(F.col("t")).alias("r")).collect()] == [("chr1", 0, 10), ("x", 4, 9), ("c", 999, 2000), None, None, None, None]
    bad = regions.invalid(spark.createDataFrame([("a", 0, 11), ("z", 0, 1), ("a", 0, 10)], "seqid string, start long, end long"), spark.createDataFrame([("a", 10)], "seqid string, length long"))
    assert sorted(r.reason for r in bad.collect()) == ["beyond the end", "unknown scaffold"]


def test_reports(spark):
    genes = spark.createDataFrame([("a", "high", 0.95, []), ("b", "low", 0.6, ["LOW_CONF", "CHIMERIC"]), ("c", "low", None, ["CHIMERIC"])], "gene_id string, tier string, confidence_score double, flags array<string>")
    found = json.loads(report.as_json(genes))
    assert found["tiers"] == [{"tier": "high", "n": 1}, {"tier": "low", "n": 2}]
    assert found["top_flags"][0]["code"] == "CHIMERIC" and [b["n"] for b in found["confidence"]] == [0, 0, 0, 0, 0, 0, 1, 0, 0, 1]
    assert "CHIMERIC" in report.as_html(genes) and "genes: 3" in report.as_text(genes)


def test_refine_flags_and_attributes(spark):
    row = spark.createDataFrame([("g", {"ID": "g", "aed": "old"}, 0.6, None)], "gene_id string, attributes map<string,string>, aed double, score double")
    assert refine.with_attributes(row, {"aed": "aed", "score": "score"}).first().attributes == {"ID": "g", "aed": "0.6000"}
    lit = F.lit
    marks = refine.flags(lit(0.6), lit(0.5), F.array(lit("uncertain_boundary"), lit("weak_exon")), F.array(lit("START_UNSUPPORTED")), lit(1), lit(0), lit(2), lit(0), lit(True))
    assert spark.range(1).select(marks.alias("m")).first().m == ["LOW_CONF", "WEAK_EXON", "weak_exon", "START_UNSUPPORTED", "SPLICE_CORRECTED", "NO_JUNCTION_SUPPORT", "BOUNDARY_ADJUSTED"]

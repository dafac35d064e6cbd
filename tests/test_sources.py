from pyspark.sql import functions as F

from genespark.operators import boundaries, intervals, refine, splice
from genespark.sources import readers, writers

GFF = """##gff-version 3
chr1\tx\tgene\t101\t500\t.\t+\t.\tID=g1;Note=a%3Bb%20c=d
chr1\tx\tmRNA\t101\t500\t.\t+\t.\tID=t1;Parent=g1
chr1\tx\texon\t301\t500\t.\t+\t.\tParent=t1,t2
chr1\tx\texon\t101\t200\t.\t+\t.\tParent=t1
chr1\tx\tCDS\t101\t200\t.\t+\t0\tParent=t1
chr1\tx\tCDS\t301\t500\t0.5\t?\t2\tParent=t1
short line
chr2\tx\tgene\t51\t250\t.\t-\t.\t.
chr1\tx\tmRNA\t301\t500\t.\t+\t.\tID=t2;Parent=g1
"""


def test_gff3_round_trip(spark, tmp_path):
    (tmp_path / "a.gff").write_text(GFF)
    genes, tx = readers.gene_models(readers.gff3(spark, str(tmp_path / "a.gff")))
    found = {g.seqid: g for g in genes.collect()}
    assert found["chr1"].attributes["Note"] == "a;b%20c=d" and (found["chr1"].start, found["chr1"].end) == (100, 500)
    (t1,) = [t for t in tx.collect() if t.transcript_id == "t1"]
    assert [tuple(e) for e in t1.exons] == [(100, 200), (300, 500)] and [tuple(c) for c in t1.cds] == [(100, 200, 0), (300, 500, 2)]
    assert {r.transcript_id for r in readers.primary_transcript(tx).collect()} == {"t1"}
    writers.write_gff3(genes, tx, str(tmp_path / "out"))
    again, tx2 = readers.gene_models(readers.gff3(spark, str(tmp_path / "out")))
    assert sorted((g.gene_id, g.start, g.end, g.strand) for g in again.collect()) == sorted((g.gene_id, g.start, g.end, g.strand) for g in genes.collect())
    assert sorted((t.transcript_id, t.exons, t.cds) for t in tx2.collect()) == sorted((t.transcript_id, t.exons, t.cds) for t in tx.collect())


def test_fasta_blocks_and_subsequences(spark, tmp_path):
    seq = "ACGTNacgtn" * 7
    (tmp_path / "g.fa").write_text(f">c1 first\n{seq[:60]}\n{seq[60:]}\n>c2\nGGG\n")
    records = readers.fasta(spark, str(tmp_path / "g.fa"))
    assert {(r.seqid, r.seq) for r in records.collect()} == {("c1", seq), ("c2", "GGG")}
    regions = spark.createDataFrame([(1, "c1", 3, 9), (2, "c1", 0, 70), (3, "c2", 1, 3)], "k int, seqid string, start long, end long")
    got = {r.k: r.seq for r in readers.subsequences(regions, readers.genome_blocks(records, 8), ["k"], 8).collect()}
    assert got == {1: seq[3:9], 2: seq, 3: "GG"}
    assert f">c1\n{seq[:60]}\n{seq[60:]}" in [r.record for r in writers.fasta(records).collect()]


def test_junction_files(spark, tmp_path):
    (tmp_path / "j.bed").write_text("track x\nchr1\t200\t300\tj\t100\t+\nchr1\t600\t700\tj\t50\t-\t9\t4\nshort\n")
    assert sorted((r.start, r.reads, r.unique_reads) for r in readers.junctions(spark, str(tmp_path / "j.bed")).collect()) == [(200, 1, 1), (600, 9, 4)]
    (tmp_path / "SJ.out.tab").write_text("chr1\t201\t300\t1\t1\t0\t5\t2\t30\nchr1\t401\t500\t0\t0\t0\t1\t0\t30\n")
    assert sorted((r.start, r.end, r.strand, r.reads) for r in readers.junctions(spark, str(tmp_path / "SJ.out.tab")).collect()) == [(200, 300, "+", 7), (400, 500, ".", 1)]


def test_sam_introns_and_coverage(spark, tmp_path):
    read = "r{}\t{}\tchr1\t{}\t{}\t{}\t*\t0\t0\tA\tI\t{}\n"
    (tmp_path / "a.sam").write_text("@HD\n" + read.format(1, 0, 101, 60, "50M100N50M", "XS:A:+\tNH:i:1") + read.format(2, 0, 111, 60, "40M100N60M", "XS:A:+\tNH:i:2") + read.format(3, 0, 101, 5, "50M100N50M", "") + read.format(4, 256, 101, 60, "50M100N50M", "") + read.format(5, 16, 101, 60, "100M", ""))
    reads = readers.sam(spark, str(tmp_path / "a.sam"))
    assert [tuple(r) for r in readers.read_introns(reads).collect()] == [("chr1", 150, 250, "+", 2, 1)]
    runs = intervals.coverage_runs(readers.aligned_blocks(reads), ["seqid"])
    depth = {p: r.depth for r in runs.collect() for p in range(r.start, r.end)}
    assert [depth.get(p, 0) for p in range(90, 320)] == [(100 <= p < 150) + (110 <= p < 150) + (100 <= p < 200) + (250 <= p < 300) + (250 <= p < 310) for p in range(90, 320)]


def test_hits_and_metrics(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("# c\nq1\ts1\t90.5\t100\t1\t0\t1\t100\t5\t104\t1e-30\t200\nq1\ts2\tbad\t1\t1\t1\t1\t1\t1\t1\t1\t1\nq2\ts1\t50\t10\t1\t0\t1\t10\t5\t14\t1e-3\t20\t300\t400\n")
    lengths = spark.createDataFrame([("q1", 120), ("q2", 1)], "query_id string, length int")
    assert sorted((r.query_id, r.identity, r.query_length) for r in readers.hits(spark, str(tmp_path / "h.tsv"), lengths).collect()) == [("q1", 90.5, 120), ("q2", 50.0, 300)]
    (tmp_path / "m.tsv").write_text("gene\tscore\tname\na\t0.5\tx\nb\t\ty\na\t1e-05\tz\n")
    assert sorted((r.gene_id, r.score, r.name) for r in readers.metrics_tsv(spark, str(tmp_path / "m.tsv"), ["score"]).collect()) == [("a", 1e-05, "z"), ("b", None, "y")]


def test_corrections_fold(spark):
    rows = [(1, [(0, 100), (200, 300), (400, 500)], [(50, 100, 0), (200, 300, 1), (400, 450, 2)])]
    tx = spark.createDataFrame(rows, "gene long, exons array<struct<start:long,end:long>>, cds array<struct<start:long,end:long,phase:int>>").withColumn("start", F.lit(0).cast("long")).withColumn("end", F.lit(500).cast("long"))
    decisions = spark.createDataFrame([(1, 100, 200, 95, 206), (1, 300, 400, 310, 400)], "gene long, intron_start long, intron_end long, new_start long, new_end long")
    (r,) = refine.refine_transcripts(tx, decisions).collect()
    assert [tuple(e) for e in r.exons] == [(0, 95), (206, 310), (400, 500)]
    assert [tuple(c) for c in r.cds] == [(50, 95, 0), (206, 300, 1), (400, 450, 2)]  # trimmed, never extended


def test_refine_decisions(spark):
    window = "A" * 4 + "CAGGTAAGT" + "A" * 6  # the canonical donor lies a base before the current one
    tail = "T" * 5 + "TTTTTTTTTTTTTTAG" + "A" * 5
    plain = "A" * 19
    introns = spark.createDataFrame([("c", k, "+", 1000 * k, 1000 * k + 100, "GT" if k < 3 else "AA", "AG", window if k < 4 else plain, tail) for k in range(1, 5)], "seqid string, gene long, strand string, intron_start long, intron_end long, donor string, acceptor string, donor_window string, acceptor_window string")
    found = spark.createDataFrame([("c", 1000, 1100, "-", 1), ("c", 2004, 2098, "+", 9), ("c", 2001, 2100, "+", 4), ("c", 2000, 2099, "-", 99)], "seqid string, start long, end long, strand string, reads int")
    got = {r.gene: r for r in splice.refine_introns(introns, found).collect()}
    assert [got[k].decision for k in range(1, 5)] == ["exact", "nearby", "rescue", "keep"]
    assert (got[3].new_start, got[3].new_end) == (2999, 3100)  # only GT, GC and AG are sites
    assert (got[2].new_start, got[2].new_end, got[2].support) == (2004, 2098, 9)
    report = {r.gene: r for r in splice.report(splice.refine_introns(introns, found)).collect()}
    assert report[1].n_supported == 0 and report[2].n_supported == 1 and report[2].n_corrected == 1


def test_boundary_shifts(spark):
    row = spark.createDataFrame([([(10, 50, 1), (80, 120, 2)], [(5, 50), (80, 125)])], "cds array<struct<start:long,end:long,phase:int>>, exons array<struct<start:long,end:long>>")
    at = lambda column: [[tuple(x) for x in part] for part in row.select(column.alias("r")).first().r]
    c, e = F.col("cds"), F.col("exons")
    assert at(boundaries.shift_start(c, e, F.lit("+"), F.lit(-8))) == [[(2, 50, 0), (80, 120, 2)], [(2, 50), (80, 125)]]
    assert at(boundaries.shift_start(c, e, F.lit("-"), F.lit(-8))) == [[(10, 50, 1), (80, 128, 0)], [(5, 50), (80, 128)]]
    assert at(boundaries.shift_stop(c, e, F.lit("+"), F.lit(3))) == [[(10, 50, 1), (80, 123, 2)], [(5, 50), (80, 125)]]
    assert at(boundaries.shift_start(c, e, F.lit("+"), F.lit(60)))[0] == [(10, 50, 1), (80, 120, 2)]
    seq = spark.createDataFrame([("CCCACCATGGCCCTAACCCTGACC",)], "s string")
    best = seq.select(boundaries.best_start(F.col("s"), F.lit(9), 10).alias("b")).first().b
    assert best.position == 6 and best.context == "ACCATGG"
    assert [seq.select(boundaries.closest_stop(F.col("s"), F.lit(k), 30)).first()[0] for k in (6, 7, 13)] == [None, 16, 13]  # the coding end goes after the stop

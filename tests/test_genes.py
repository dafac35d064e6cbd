from pyspark.sql import functions as F

from genespark.operators import genes
from genespark.sources import readers

SPANS = "seqid string, start long, end long"


def test_regions_and_counts(spark):
    rows = spark.createDataFrame([("a", 0, 10), ("a", 5, 20), ("a", 20, 30), ("b", 0, 10)], SPANS)
    assert genes.overlapping(rows, "a", 8, 20).count() == 2 and genes.inside(rows, "a", 0, 20).count() == 2
    wanted = spark.createDataFrame([(1, "a", 9, 21), (2, "b", 10, 12)], "region_id int, " + SPANS)
    assert {r.region_id: r.n_reads for r in genes.read_count(rows, wanted).collect()} == {1: 3, 2: 0}
    chunks = spark.createDataFrame([("a", 0, 15, "x"), ("a", 15, 40, "y")], SPANS + ", chunk_id string")
    inner = wanted.withColumnsRenamed({"start": "region_start", "end": "region_end"}).filter("region_id = 1")
    assert genes.chunk_of(inner, chunks).count() == 0


def test_coding_sequences_and_proteins(spark):
    records = readers.genome_blocks(spark.createDataFrame([("a", "CCATGAAACCTTTTAGG")], "seqid string, seq string"), 5)
    kind = "transcript_id string, gene_id string, seqid string, strand string, cds array<struct<start:long,end:long,phase:int>>"
    tx = spark.createDataFrame([("t", "g", "a", "+", [(10, 16, 0), (2, 8, 0)]), ("u", "h", "a", "-", [(0, 3, 0), (5, 8, 0)])], kind)
    got = {r.transcript_id: r.seq for r in genes.coding_sequences(tx, records, 5).collect()}
    assert got == {"t": "ATGAAA" + "TTTTAG", "u": "TTT" + "TGG"}
    assert {r.transcript_id: r.protein for r in genes.proteins(genes.coding_sequences(tx, records, 5)).collect()} == {"t": "MKF", "u": "FW"}


def test_subsets_and_lines(spark):
    text = ["##gff-version 3", "a\tx\tgene\t1\t9\t.\t+\t.\tID=g1", "a\tx\tmRNA\t1\t9\t.\t+\t.\tID=t1;Parent=g1", "a\tx\tgene\t20\t30\t.\t+\t.\tName=n;ID=g2", "a\tx\texon\t20\t30\t.\t+\t.\tParent=t2"]
    lines = spark.createDataFrame(list(enumerate(text)), "line_no long, value string")
    keep = spark.createDataFrame([("g2",)], "gene_id string")
    assert [r.line_no for r in genes.filtered_lines(lines, keep).orderBy("line_no").collect()] == [0, 3, 4]
    hits = spark.createDataFrame([("q", 1e-5, 1), ("q", 1e-9, 2), ("q", 1e-9, 3)], "query_id string, evalue double, ord int")
    assert sorted(r.ord for r in genes.top_hits(hits, 2).collect()) == [2, 3]
    assert spark.range(1).select(genes.taxon(F.lit("sp|x OS=y OX=3702 z")).alias("t")).first().t == "3702"


def test_adaptive_chunks_cover_scaffolds_and_cut_no_gene(spark):
    scaffolds = spark.createDataFrame([("a", 1000), ("b", 90), ("c", 500)], "seqid string, length long")
    placed = [("a", 90 * k, 90 * k + 80) for k in range(10)] + [("c", 100, 400)]
    got = genes.adaptive_chunks(scaffolds, spark.createDataFrame(placed, SPANS), 8, 100).collect()
    for seqid, length in (("a", 1000), ("b", 90), ("c", 500)):
        own = sorted((r.start, r.end) for r in got if r.seqid == seqid)
        assert own[0][0] == 0 and own[-1][1] == length and all(x[1] == y[0] for x, y in zip(own, own[1:]))
        assert not any(s < e < t for _, e in own for k, s, t in placed if k == seqid)


def test_carry_forward_over_blocks(spark):
    import random

    from genespark.operators import planning

    rng = random.Random(1)
    rows = [(f, k, rng.choice([None, None, None, k])) for f in (1, 2, None) for k in range(60)]
    want, last = {}, {}
    for f, k, v in rows:
        last[f] = v if v is not None else last.get(f)
        want[f, k] = last[f]
    lines = spark.createDataFrame(rows, "file int, line_no long, v long").repartition(4)
    for size in (7, 1 << 20):
        got = planning.carry_forward(lines, "line_no", "v", ["file"], size)
        assert {(r.file, r.line_no): r.v for r in got.collect()} == want


def test_filtered_lines_of_a_file_in_parts(spark, tmp_path):
    line = lambda kind, gene, n: f"a\tx\t{kind}\t{n}\t{n + 5}\t.\t+\t.\t" + (f"ID={gene}" if kind == "gene" else f"Parent={gene}.t1")
    parts = [[line("gene", "g1", 1), line("exon", "g1", 2)], [line("exon", "g1", 3), line("gene", "g2", 4)] + [line("exon", "g2", k) for k in range(5, 50)], [line("exon", "g2", 50), line("gene", "g3", 51)]]
    for k, rows in enumerate(parts):
        (tmp_path / f"part-0000{k}.txt").write_text("\n".join(rows) + "\n")
    lines = readers.raw_lines(spark, f"file://{tmp_path}")  # the largest part is read first
    for gene, n in (("g1", 3), ("g2", 47), ("g3", 1)):
        found = genes.filtered_lines(lines, spark.createDataFrame([(gene,)], "gene_id string")).orderBy("file", "line_no").collect()
        assert len(found) == n and all(gene in r.value for r in found)

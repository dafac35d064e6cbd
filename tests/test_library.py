import json

import pytest
from pyspark.sql import functions as F

from genespark import commands, parallel
from genespark.functions import dna
from genespark.operators import boundaries, intervals, planning, qc
from genespark.sources import interchange, readers, writers


def test_fasta_headers_and_bounds(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">a one -> two\nACGT\nAC\n>b\r\nGG\r\n>c empty\n")
    records = readers.fasta(spark, f"file://{tmp_path}/g.fa")
    assert {(r.seqid, r.description, r.seq) for r in records.collect()} == {("a", "a one -> two", "ACGTAC"), ("b", "b", "GG"), ("c", "c empty", "")}
    blocks, lengths = readers.genome_blocks(records, 4), readers.fasta_lengths(records)
    good = spark.createDataFrame([("a", 1, 6), ("b", 0, 2)], "seqid string, start long, end long")
    assert {r.seqid: r.seq for r in readers.subsequences(good, blocks, ["seqid"], 4, lengths).collect()} == {"a": "CGTAC", "b": "GG"}
    for wrong in (("a", 1, 7), ("a", -1, 2), ("x", 0, 1), ("a", 3, 2)):
        with pytest.raises(Exception, match="out of bounds"):
            readers.subsequences(spark.createDataFrame([wrong], good.schema), blocks, ["seqid"], 4, lengths).collect()


def test_last_wins_over_files(spark, tmp_path):
    line = "c\tx\tgene\t{}\t{}\t.\t+\t.\tID=g"
    (tmp_path / "a.gff3").write_text("# long comment " + "x" * 500 + "\n" + line.format(1, 9) + "\n")
    (tmp_path / "b.gff3").write_text(line.format(11, 19) + "\n")
    genes, _ = readers.gene_models(readers.gff3(spark, f"file://{tmp_path}"))
    assert [(r.start, r.end) for r in genes.collect()] == [(10, 19)]


def test_runs_and_means_over_bin_ends(spark):
    values = [1.0 if k % 11 == 0 or k > 90 else 0.1 * (k % 3) for k in range(100)]
    rows = spark.createDataFrame([("a", k, v) for k, v in enumerate(values)], "seqid string, pos long, v double")
    for size in (7, 16, 1 << 14):
        got = {(r.start, r.end, round(r.score, 9)) for r in intervals.islands(rows, ["seqid"], "pos", "v", 0.5, 4, size).collect()}
        want, k = set(), 0
        while k < 100:
            end = k
            while end < 100 and values[end] < 0.5:
                end += 1
            if end - k >= 4:
                want.add((k, end, round(sum(values[k:end]) / (end - k), 9)))
            k = end + 1
        assert got == want
        smooth = {r.pos: r.smoothed for r in intervals.smooth(rows, ["seqid"], "pos", "v", 6, size).collect()}
        assert all(abs(smooth[k] - sum(values[max(0, k - 3) : k + 3]) / 6) < 1e-9 for k in range(100))
    assert intervals.smooth(rows.filter("pos < 3"), ["seqid"], "pos", "v", 6).filter("smoothed <> v").isEmpty()


def test_numbers_in_range_partitions(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("k"))
    got = writers.numbered(rows.repartition(5), ["k"], "n").collect()
    assert len(got) == 500 and all(r.k == r.n for r in got)


def test_user_functions(spark):
    chunks = spark.createDataFrame([("c0", "a", 0, 10), ("c1", "a", 10, 20)], "chunk_id string, seqid string, start long, end long")
    rows = spark.createDataFrame([("a", k) for k in range(15)], "seqid string, start long")
    found = parallel.map_chunks(chunks, rows, lambda i, g: g.groupby("seqid").size().reset_index(name="n")[["n"]].assign(chunk_id=i)[["chunk_id", "n"]], "chunk_id string, n long")
    assert {r.chunk_id: r.n for r in found.collect()} == {"c0": 10, "c1": 5}
    items = parallel.map_items(spark.range(4), lambda r: {"x": 6 // r["id"]}, "x long").collect()
    assert sorted(r.x for r in items if r.ok) == [2, 3, 6] and [r.error for r in items if not r.ok] == ["ZeroDivisionError: integer division or modulo by zero"]
    with pytest.raises(Exception, match="ZeroDivisionError"):
        parallel.map_items(spark.range(2), lambda r: {"x": 6 // r["id"]}, "x long", go_on=False).collect()
    with parallel.progress(spark, lambda done, total: None, 0.05), parallel.timed("x") as took:
        spark.range(1000).count()
    assert took["seconds"] > 0 and parallel.memory()["available_mb"] > 0 and parallel.advised_workers(2) <= 2
    assert [parallel.memory_state(x) for x in (10, 85, 99)] == ["ok", "warning", "critical"]
    assert parallel.surroundings({"SLURM_JOB_ID": "7", "SLURM_ARRAY_TASK_ID": "3", "SLURM_CPUS_PER_TASK": "4", "SLURM_MEM_PER_NODE": "2G"}) == {"job": "7", "task": 3, "cpus": 4, "memory_mb": 2048}


def test_plans_and_settings(spark):
    assert [planning.parallelism(n, 8) for n in (3, 8, 17, 33)] == [3, 8, 4, 8]
    assert planning.workers(8, 2500) == 2 and planning.workers(8, most=3) == 3
    chunk = spark.createDataFrame([("c0", "a", 0, 10)], "chunk_id string, seqid string, start long, end long")
    assert planning.commands(chunk, "{seqid} {start} {end_0} {x}", {"x": "y"}).first().command == "a 1 10 y"
    with pytest.raises(KeyError):
        planning.commands(chunk, "{nothing}")
    assert qc.Settings().checked().high == 0.85
    for wrong in ({"aed_rnaseq": 0.5}, {"low": 0.9}, {"splice_weight": 0.5}):
        with pytest.raises(ValueError):
            qc.Settings(**wrong).checked()


def test_merged_tables(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.tsv").write_text(f"h1\th2\n{name}\t1\n{name}\t2\n")
    rows = planning.merge_tables(readers.raw_lines(spark, f"file://{tmp_path}")).orderBy("ord").collect()
    assert [r.value for r in rows] == ["h1\th2", "a\t1", "a\t2", "b\t1", "b\t2"]


def test_interchange(spark, tmp_path):
    assert interchange.companions("x/y_predictions.h5") == ["x/y_input.h5", "x/y_predictions_input.h5"]
    (tmp_path / "y_input.parquet").write_text("")
    assert interchange.find_companion(spark, f"file://{tmp_path}/y_predictions.parquet").endswith("/y_input.parquet")
    assert interchange.find_companion(spark, f"file://{tmp_path}/z.parquet") is None
    assert interchange.prediction_columns(spark.createDataFrame([([[0.1]],)], "y_pred array<array<float>>")) == {"column": "y_pred", "batched": True, "seqids": False}
    with pytest.raises(ValueError):
        interchange.prediction_columns(spark.range(1))
    (tmp_path / "uniprot_sprot.fasta").write_text(">p OX=3\nMK\n")
    known = {r.name: r.cached for r in interchange.databases(spark, f"file://{tmp_path}").collect()}
    assert known["swissprot"] and not known["uniref50"]
    assert interchange.database_records(spark, f"file://{tmp_path}/uniprot_sprot.fasta", ["3"]).count() == 1
    assert interchange.checksums(spark, f"file://{tmp_path}/*.fasta").first().md5 == __import__("hashlib").md5(b">p OX=3\nMK\n").hexdigest()


def test_matrices(spark):
    assert dna.pwm_from_json(None, "donor") == dna.DONOR
    assert dna.pwm_from_json(json.dumps({"matrix": [[1, 0, 0, 0]]}), "donor") == [[1.0, 0.0, 0.0, 0.0]]
    with pytest.raises(ValueError):
        dna.pwm_from_json('{"matrix": [[1]]}', "donor")
    rows = spark.createDataFrame([("x", "AC" * 10)], "k string, seq string")
    assert [r.at for r in dna.sliding(rows, ["k"], dna.DONOR, step=5).collect()] == [0, 5, 10]


def test_changes(spark):
    part = "array<struct<start:long,end:long,phase:int>>"
    rows = spark.createDataFrame([([(5, 9, 0)], [(2, 9, 0)]), ([(5, 9, 0)], [(5, 9, 0)]), ([(5, 9, 0)], [(6, 12, 0)])], f"a {part}, b {part}")
    got = [list(r.c) for r in rows.select(boundaries.changes(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == [["start_shifted:-3"], [], ["start_shifted:1", "end_shifted:3"]]


def test_commands(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    out = commands.merge(spark, f"file://{tmp_path}/a.txt", f"file://{tmp_path}/out")
    assert out.count() == 1 and commands.qc_flags(spark, "homology", "error").count() == 1
    assert commands.suggest(10, 1, 8, 2) == {"strategy": "scaffold"}

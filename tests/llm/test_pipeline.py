import corpus_pipeline
from genespark.llm import dartminhash, decontam, quality, queries, storage

DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, DIR).cache()
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
        if name == "quality_rules":
            assert all(not any(rule.rejects(quality.Text(r.text)) for rule in quality.RULES) for r in docs.collect())
        if name == "near_duplicates":
            sets = [dartminhash.weighted(r.text) for r in docs.collect()]
            assert not any(dartminhash.similarity(a, b) >= 0.8 for k, a in enumerate(sets) for b in sets[:k])
        if name == "benchmark_decontamination":
            assert decontam.matches(docs, spark.read.parquet(f"{DIR}/benchmark.parquet")).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_run_and_registry(spark):
    assert corpus_pipeline.run(spark, DIR).count() > 0
    assert [n.split("_")[0] for n in queries.QUERIES][:10] == [f"op{k}" for k in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages_of_odd_and_empty_tables(spark, tmp_path, odd, empty):
    spark.createDataFrame([(0, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, "no such passage anywhere in these texts")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("odd", odd), ("empty", empty)):
        folder = tmp_path / name
        folder.mkdir()
        for table in ("labels", "benchmark"):
            (folder / f"{table}.parquet").symlink_to(tmp_path / f"{table}.parquet")
        rows.write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, str(folder))
            assert found.columns == docs.columns and found.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(folder)).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
        corpus_pipeline.run(spark, str(folder)).count()


def test_near_duplicates_keep_columns_of_any_name(spark):
    rows = [(k, "a b c d e f g h " * 9 + ("x" if k == 1 else ""), k, -k, "t") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __0 long, __1 long, __2 string")
    assert [tuple(r) for r in dartminhash.keep(docs).collect()] == [rows[0]]


def test_a_worker_keeps_nothing_of_earlier_operators():
    words = {"word": (1,)}
    storage.hold("first", words.clear)
    assert list(storage.worker("first", iter)([1, 2])) == [1, 2] and words  # its own operator goes on with it
    assert list(storage.worker("second", iter)([3])) == [3] and not words and "first" not in storage.held

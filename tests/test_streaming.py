from datetime import datetime

from genespark.streaming import junctions


def test_support_over_arriving_files(spark, tmp_path):
    rows = lambda sample, n: spark.createDataFrame([("c", 1, 9, "+", sample, n, datetime(2024, 1, 1, 0, 5)), ("c", 20, 40, "-", sample, 1, datetime(2024, 1, 1, 2))], junctions.SCHEMA)
    rows("a", 3).write.parquet(str(tmp_path / "in"))
    stream = junctions.support(junctions.read(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("support").option("checkpointLocation", str(tmp_path / "state")).start()
    stream.processAllAvailable()
    rows("b", 4).write.mode("append").parquet(str(tmp_path / "in"))
    stream.processAllAvailable()
    got = {r.start: (r.total_reads, r.n_samples) for r in spark.table("support").collect()}
    stream.stop()
    assert got == {1: (7, 2), 20: (2, 2)}


def test_windows(spark, tmp_path):
    test = spark.createDataFrame([("c", 1, 9, "+", "a", 3, datetime(2024, 1, 1, 0, 5)), ("c", 1, 9, "+", "a", 2, datetime(2024, 1, 1, 0, 50)), ("c", 1, 9, "+", "a", 2, datetime(2024, 1, 1, 1, 5))], junctions.SCHEMA)
    assert sorted(r.reads for r in junctions.windowed(test).collect()) == [2, 5]

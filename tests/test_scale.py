"""Plans that have to hold on tables much larger than the tests'."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from genespark.operators import planning
from genespark.plans import pipeline, tables


def broadcasts(df):
    """The parts of a plan that are sent to all executors."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.split("\n") if "BroadcastExchange" in line]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("scale")
    spark.range(60).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name").write.parquet(f"{path}/supplier.parquet")
    spark.range(500).selectExpr("id AS o_orderkey", "id % 90 AS o_custkey").write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_chunk_of_region_sends_no_chunks_to_the_driver(spark, folder):
    found = tables.chunk_of_region(spark, folder)
    assert len(broadcasts(found)) <= 1  # the names of the scaffolds
    assert found.count() > 0


def test_chunk_slices_sends_no_chunks_to_the_driver(spark, folder):
    found = pipeline.chunk_slices(spark, folder)
    assert len(broadcasts(found)) <= 1
    assert found.count() > 0


def test_process_chunks_sends_no_chunks_to_the_driver(spark, folder):
    found = tables.process_chunks(spark, folder)
    assert len(broadcasts(found)) <= 1
    assert found.first().n_rows > 0


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Scaffolds given three times, of one name under two keys, without a key and without a name."""
    path = tmp_path_factory.mktemp("repeated")
    suppliers = [(k, f"S{k % 20}") for k in range(40)] + [(k, f"S{k % 20}") for k in (3, 3, 7)] + [(None, "S4"), (99, None)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").coalesce(1).write.parquet(f"{path}/supplier.parquet")
    orders = [(k * 613, k % 90) for k in range(300)] + [(5, None), (None, 3), (-4000, 2)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


def of_sql(sql, folder):
    with duckdb.connect() as con:
        for name in ("supplier", "orders"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
        return Counter(con.execute(sql).fetchall())


def test_chunk_slices_of_repeated_scaffolds(spark, repeated):
    want = of_sql(pipeline.PLANS.sql["chunk_slices"], repeated)
    assert len(want) > 300 and Counter(map(tuple, pipeline.chunk_slices(spark, repeated).collect())) == want


def test_chunks_of_some_scaffolds_keep_their_numbers(spark):
    scaffolds = spark.range(200).selectExpr("concat('S', id % 90) AS seqid", "id % 150 AS ord", "1000 + id % 150 * 31 AS length")
    only = spark.createDataFrame([("S3",), ("S3",), ("S77",), ("T",)], "seqid string")
    every, some = planning.size_chunks(scaffolds, 300, 100), planning.size_chunks(scaffolds, 300, 100, only)
    assert sorted(some.collect()) == sorted(every.filter("seqid IN ('S3', 'S77')").collect())
    assert every.count() == every.select("chunk_id").distinct().count()


def test_chunks_are_made_by_several_tasks(spark):
    scaffolds = spark.range(100).selectExpr("concat('S', id) AS seqid", "id AS ord", "1000 AS length")
    assert planning.size_chunks(scaffolds, 300, 100).select(F.spark_partition_id()).distinct().count() > 1


def test_process_chunks_of_repeated_scaffolds_and_of_no_orders(spark, repeated, tmp_path):
    sql = tables.PLANS.sql["process_chunks"]
    assert Counter(map(tuple, tables.process_chunks(spark, repeated).collect())) == of_sql(sql, repeated)
    spark.read.parquet(f"{repeated}/supplier.parquet").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.read.parquet(f"{repeated}/orders.parquet").limit(0).write.parquet(f"{tmp_path}/orders.parquet")
    assert Counter(map(tuple, tables.process_chunks(spark, str(tmp_path)).collect())) == of_sql(sql, tmp_path) == {(0, 0, None): 1}

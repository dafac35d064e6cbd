"""Driver tables in the shape of annotation tables, in DataFrames and in SQL.

The rules use integers only, so both engines agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import intervals


class Plans:
    """Queries of a module and their SQL."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str, name: str | None = None):
        """Register a query with its SQL, under its own name or another."""

        def register(function):
            self.queries[name or function.__name__] = function
            self.sql[name or function.__name__] = sql
            return function

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seqid, gene, strand, rn, start, end: an exon a row, also beyond the gene's slot of 1000 bases."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")  # the last one settles ties, and all readers shuffle the same columns
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.row_number().over(order).cast("long").alias("rn"))
    return items.selectExpr(
        "CASE WHEN rn > 0 THEN l_orderkey % 5 END AS seqid",  # always; by rn, so that a condition on it stays above the window and the shuffle below is the same for all who read it
        "l_orderkey AS gene",
        "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand",
        "rn",
        "l_orderkey * 1000 + rn * 100 AS start",
        "l_orderkey * 1000 + rn * 100 + 20 + floor(l_quantity) AS end",
    )


EXONS = """
x AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn FROM lineitem),
exons AS (SELECT l_orderkey % 5 AS seqid, l_orderkey AS gene, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, rn,
  l_orderkey * 1000 + rn * 100 AS s, l_orderkey * 1000 + rn * 100 + 20 + CAST(floor(l_quantity) AS BIGINT) AS e FROM x)"""


def gene_introns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.introns(exons(spark, sf_dir), ["seqid", "gene", "strand"]).select("seqid", "gene", "strand", "intron_start", "intron_end")


INTRONS = EXONS + """,
introns AS (SELECT seqid, gene, strand, e AS intron_start, n AS intron_end FROM (SELECT *, lead(s) OVER (PARTITION BY gene ORDER BY s, e) AS n FROM exons) WHERE n > e)"""


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted introns of all genes: seqid, start, end, strand, reads (0 in a gene of eleven)."""
    return gene_introns(spark, sf_dir).filter("gene IS NOT NULL").selectExpr("seqid", "intron_start + gene % 7 - 3 AS start", "intron_end + gene % 5 - 2 AS end", "CASE WHEN gene % 4 = 1 THEN '.' ELSE strand END AS strand", "gene % 11 AS reads")


JUNCTIONS = INTRONS + """,
junctions AS (SELECT seqid, intron_start + gene % 7 - 3 AS s, intron_end + gene % 5 - 2 AS e, CASE WHEN gene % 4 = 1 THEN '.' ELSE strand END AS strand, gene % 11 AS reads FROM introns)"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned blocks: seqid, start, end."""
    return table(spark, sf_dir, "orders").selectExpr("o_custkey % 50 AS seqid", "3 * o_orderkey AS start", "3 * o_orderkey + 1 + floor(o_totalprice / 10000) AS end")


BLOCKS = """
blocks AS (SELECT o_custkey % 50 AS seqid, 3 * o_orderkey AS s, 3 * o_orderkey + 1 + CAST(floor(o_totalprice / 10000) AS BIGINT) AS e FROM orders)"""

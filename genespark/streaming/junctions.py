"""Junction support over a stream of per-sample files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "seqid string, start long, end long, strand string, sample string, reads long, arrived timestamp"


def read(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Parquet files of junction counts as they arrive."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(path)


def support(counts: DataFrame) -> DataFrame:
    """Running reads and samples of each junction; for update or complete mode.

    The state is a row a junction with its sum and its samples, whatever the number of reads; thresholds need the exact number.
    """
    return counts.groupBy("seqid", "start", "end").agg(F.sum("reads").alias("total_reads"), F.size(F.collect_set("sample")).cast("long").alias("n_samples"))


def windowed(counts: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Reads of each junction by arrival window; late rows within the watermark count."""
    return counts.withWatermark("arrived", late).groupBy(F.window("arrived", width), "seqid", "start", "end").agg(F.sum("reads").alias("reads"))

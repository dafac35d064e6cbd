"""Registry of the queries over the driver's tables and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import annotation, evidence, files, genome, pipeline, signals, tables
from .plans import sequences as sequence_plans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for module in (evidence, signals, sequence_plans, annotation, pipeline, genome, files, tables):
    QUERIES |= module.PLANS.queries
    ORACLE_SQL |= module.PLANS.sql

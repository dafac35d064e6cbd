"""User functions over chunks and items, their statistics, and what a run sees of its surroundings.

Spark schedules the tasks; backends, workers and retries are its own.  The functions
here give results as tables, failures as rows.
"""

from __future__ import annotations

import contextlib
import logging
import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import planning

OUTCOME = "ok boolean, seconds double, error string"


def map_items(items: DataFrame, function: Callable[[dict], dict], schema: str, go_on: bool = True) -> DataFrame:
    """``function`` on every row: its columns (``schema``), then ok, seconds and error.

    A failed row has nulls and the error's text; without ``go_on`` it stops the run.
    Rows come in Arrow batches; a batch is all that a task holds.
    """
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item in batch.to_dict("records"):
                began = time.perf_counter()
                try:
                    found, error = function(item), None
                except Exception as e:
                    if not go_on:
                        raise
                    found, error = {}, f"{type(e).__name__}: {e}"
                rows.append([found.get(n) for n in names] + [error is None, time.perf_counter() - began, error])
            yield pd.DataFrame(rows, columns=[*names, "ok", "seconds", "error"])

    return items.mapInPandas(run, f"{schema}, {OUTCOME}")


def map_chunks(chunks: DataFrame, rows: DataFrame, function: Callable[[str, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``function`` on the rows (seqid, start) that begin in each chunk (chunk_id, seqid, start, end).

    A chunk is a bounded stretch of a scaffold, so a group is bounded by the plan.
    """
    from .operators import intervals

    spans = chunks.select("seqid", "chunk_id", F.col("start").alias("__low"), F.col("end").alias("__high"))
    points = rows.withColumn("__at", F.col("start")).withColumn("__next", F.col("start") + 1)
    met = intervals.overlap_join(points, spans, ["seqid"], ("__at", "__next"), ("__low", "__high")).drop("__at", "__next", "__low", "__high")

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        return function(key[0], group)

    return met.groupBy("chunk_id").applyInPandas(run, schema)


def process(chunks: DataFrame, rows: DataFrame, function: Callable[[str, pd.DataFrame], pd.DataFrame], schema: str, gather: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``map_chunks`` and, if given, ``gather`` over all results."""
    found = map_chunks(chunks, rows, function, schema)
    return found if gather is None else gather(found)


@contextlib.contextmanager
def progress(spark: SparkSession, callback: Callable[[int, int], None], every: float = 0.5):
    """Call ``callback(done, total)`` with the tasks of the stages that run inside the block."""
    import threading

    tracker, over = spark.sparkContext.statusTracker(), threading.Event()

    def watch():
        while not over.wait(every):
            infos = [tracker.getStageInfo(s) for s in tracker.getActiveStageIds()]
            infos = [i for i in infos if i]
            if infos:
                callback(sum(i.numCompletedTasks for i in infos), sum(i.numTasks for i in infos))

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


@contextlib.contextmanager
def timed(name: str, logger: logging.Logger | None = None):
    """Log how long a block took; the dict it yields gets ``seconds``."""
    out, began = {}, time.perf_counter()
    try:
        yield out
    finally:
        out["seconds"] = time.perf_counter() - began
        (logger or logging.getLogger("genespark")).info("%s took %.1f s", name, out["seconds"])


def memory() -> dict[str, float]:
    """MB of memory of this machine: total, available, and the used share in percent."""
    with open("/proc/meminfo") as file:
        known = {k: int(v.split()[0]) / 1024 for k, v in (line.split(":") for line in file)}
    return {"total_mb": known["MemTotal"], "available_mb": known["MemAvailable"], "percent": 100 * (1 - known["MemAvailable"] / known["MemTotal"])}


def memory_state(percent: float, warning: float = 80, critical: float = 95) -> str:
    return "critical" if percent >= critical else "warning" if percent >= warning else "ok"


def surroundings(environment: dict[str, str] | None = None) -> dict:
    """What a batch scheduler tells a job: whether it is one, its task number, CPUs and memory in MB."""
    known = dict(os.environ) if environment is None else environment
    number = lambda k: int(known[k]) if known.get(k, "").isdigit() else None
    text = known.get("SLURM_MEM_PER_NODE", "").strip().upper()
    scale = {"G": 1024, "K": 1 / 1024}.get(text[-1:], 1)
    with contextlib.suppress(ValueError):
        return {"job": known.get("SLURM_JOB_ID"), "task": number("SLURM_ARRAY_TASK_ID"), "cpus": number("SLURM_CPUS_PER_TASK"), "memory_mb": int(float(text.rstrip("GMK")) * scale) if text else None}
    return {"job": known.get("SLURM_JOB_ID"), "task": number("SLURM_ARRAY_TASK_ID"), "cpus": number("SLURM_CPUS_PER_TASK"), "memory_mb": None}


def advised_workers(most: int | None = None, per_worker_mb: int = 1000) -> int:
    """Workers for this machine's cores and free memory."""
    return planning.workers(os.cpu_count() or 1, memory()["available_mb"], per_worker_mb, most)

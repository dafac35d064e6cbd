"""Work plans over scaffolds: chunks, batches and the merge of chunk results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes that a base of a chunk takes in the memory model.
BYTES_PER_BASE = 20


def _numbered(scaffolds: DataFrame, n: Column, only: DataFrame | None = None) -> DataFrame:
    """A row for each of the ``n`` chunks of a scaffold: its place k on the scaffold and chunk_id, numbered by ord (nulls last), then place.

    Numbers come from a row a scaffold.  Scaffolds of the same ord and number of chunks take turns, place by place.
    With ``only`` (seqid) no other scaffold's chunks are made; the numbers stay those among all.  The scaffolds
    are dealt out over all tasks before their chunks are made, which Spark would else leave to one task.
    """
    last, peers = F.col("ord").asc_nulls_last(), Window.partitionBy("ord", "n")
    counted = scaffolds.withColumn("n", n.cast("long")).withColumn("__upto", F.sum("n").over(Window.orderBy(last, "n")))  # with all peers
    counted = counted.withColumn("__peers", F.count("*").over(peers)).withColumn("__turn", F.row_number().over(peers.orderBy("seqid")) - 1)
    if only is not None:
        counted = counted.join(only.select("seqid").distinct().hint("merge"), "seqid", "left_semi")
    tasks = int(scaffolds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counted.repartition(tasks, "seqid", "ord").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    number = F.col("__upto") + (F.col("k") - F.col("n")) * F.col("__peers") + F.col("__turn")
    return rows.withColumn("chunk_id", F.format_string("chunk_%04d", number)).drop("__upto", "__peers", "__turn")


def size_chunks(scaffolds: DataFrame, size: int, least: int, only: DataFrame | None = None) -> DataFrame:
    """Chunks of ``size``; a tail under ``least`` goes to the chunk before it.

    Needs seqid, ord, length; returns seqid, ord, start, end and chunk_id in scaffold order.
    ``only`` (seqid) leaves out the chunks of other scaffolds, not their numbers.
    """
    n = F.greatest(F.lit(1), F.floor(F.col("length") / size) + F.when(F.col("length") % size >= least, 1).otherwise(0))
    end = F.when(F.col("k") == F.col("n") - 1, F.col("length")).otherwise((F.col("k") + 1) * size)
    return _numbered(scaffolds, n, only).select("seqid", "ord", (F.col("k") * size).alias("start"), end.alias("end"), "chunk_id")


def scaffold_chunks(scaffolds: DataFrame, most: int | None = None) -> DataFrame:
    """A chunk for each scaffold; one longer than ``most`` is cut into pieces of that size."""
    size = F.col("length") if most is None else F.lit(most)
    n = F.lit(1) if most is None else F.greatest(F.lit(1), F.ceil(F.col("length") / most))
    end = F.least(F.col("length"), (F.col("k") + 1) * size)
    return _numbered(scaffolds, n).select("seqid", "ord", (F.col("k") * size).alias("start"), end.alias("end"), "chunk_id")


def chunk(chunks: DataFrame, chunk_id: str) -> DataFrame:
    """The chunk with an id, or no row."""
    return chunks.filter(F.col("chunk_id") == chunk_id)


def chunk_at(chunks: DataFrame, place: int) -> DataFrame:
    """The chunk at a place of the plan (from 0), the one that an array task of this number works on."""
    return chunks.orderBy("chunk_id").offset(place).limit(1)


def commands(chunks: DataFrame, template: str, extra: dict[str, str] | None = None, log_dir: str | None = None) -> DataFrame:
    """chunk_id and the command of each chunk.

    Known names in braces: chunk_id, seqid, start and end (1-based, inclusive), start_0
    and end_0 (half-open), size, and those of ``extra``; any other is an error.
    """
    text = lambda c: c.cast("string")
    start, end = F.col("start"), F.col("end")
    values = {"chunk_id": F.col("chunk_id"), "seqid": text(F.col("seqid")), "start": text(start + 1), "end": text(end), "start_0": text(start), "end_0": text(end), "size": text(end - start)}
    values |= {k: F.lit(v) for k, v in (extra or {}).items()}
    parts = re.split(r"\{(\w+)\}", template)
    unknown = set(parts[1::2]) - values.keys()
    if unknown:
        raise KeyError(f"unknown names in the template: {sorted(unknown)}")
    command = F.concat(*(F.lit(p) if k % 2 == 0 else values[p] for k, p in enumerate(parts)))
    if log_dir is not None:
        command = F.concat(command, F.lit(f" > {log_dir}/"), F.col("chunk_id"), F.lit(".log 2>&1"))
    return chunks.select("chunk_id", command.alias("command"))


def wrapped_commands(chunks: DataFrame, script: str) -> DataFrame:
    """Commands that hand a chunk's id to a script."""
    return chunks.select("chunk_id", F.concat(F.lit(f"bash {script} "), F.col("chunk_id")).alias("command"))


def memory_bytes(start: Column, end: Column) -> Column:
    """Memory of a chunk by the usual model."""
    return (end - start) * BYTES_PER_BASE


def memory_mb(text: Column) -> Column:
    """MB of a memory string: 16G, 16000M, 1024K or a plain number of MB; null if it is none of these."""
    value = F.upper(F.trim(text))
    number = F.regexp_replace(value, "[GMK]$", "")
    whole = number.try_cast("long")
    return F.when(value.endswith("G"), (number.try_cast("double") * 1024).cast("long")).when(value.endswith("K"), (number.try_cast("double") / 1024).cast("long")).otherwise(whole)


def merge_gff(lines: DataFrame) -> DataFrame:
    """Lines (file, line_no, value) of several files as one: a single version line first, no separators.

    Returns ord and value; ``write_merged`` writes them.
    """
    version, mark = F.col("value").startswith("##gff-version"), F.col("value").startswith("###")
    first = lines.filter(version).groupBy().agg(F.min_by("value", F.struct("file", "line_no")).alias("value")).filter("value IS NOT NULL")
    place = F.struct("file", "line_no").alias("ord")
    rest = lines.filter(~version & ~mark).select(place, "value")
    head = first.select(F.struct(F.lit("").alias("file"), F.lit(-1).cast("long").alias("line_no")).alias("ord"), "value")
    return head.unionByName(rest)


def merge_tables(lines: DataFrame) -> DataFrame:
    """Lines of several tables as one: the header of the first file, the other rows of all, as ord and value."""
    place = F.struct("file", "line_no")
    heads = lines.groupBy("file").agg(F.min("line_no").alias("__head"))  # a row a file
    first = heads.agg(F.min("file").alias("__first"))
    met = lines.join(heads, "file").join(F.broadcast(first), F.lit(True))  # one row
    return met.filter((F.col("line_no") != F.col("__head")) | (F.col("file") == F.col("__first"))).select(place.alias("ord"), "value")


def gene_batches(genes: DataFrame, size: int) -> DataFrame:
    """Batches of ``size`` genes in order on each scaffold: seqid, batch, n_genes, start, end."""
    place = F.row_number().over(Window.partitionBy("seqid").orderBy("start", "end", "gene")) - 1
    return genes.withColumn("batch", F.floor(place / size)).groupBy("seqid", "batch").agg(F.count("*").alias("n_genes"), F.min("start").alias("start"), F.max("end").alias("end"))


def advice(genome_size: int, n_genes: int, memory_gb: float, workers: int) -> dict:
    """Strategy and size of chunks for a genome."""
    if genome_size < 100_000_000:
        return {"strategy": "scaffold"}
    if n_genes and genome_size / n_genes < 50_000:
        return {"strategy": "genes", "chunk_size": max(50, n_genes // (4 * workers))}
    if genome_size > 1_000_000_000:
        return {"strategy": "size", "chunk_size": min(int(memory_gb * 1e9 / 20 / max(1, workers)), 50_000_000)}
    return {"strategy": "adaptive", "target_chunks": 4 * workers}


def first_by_priority(results: DataFrame, key: str, order: list) -> DataFrame:
    """One row a key: the first in the given order (an aggregation, not a sort)."""
    rest = [c for c in results.columns if c != key]
    return results.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__b")).select(key, "__b.*")


def carry_forward(lines: DataFrame, order: str, value: str, part: list[str] | None = None, size: int = 1 << 20, files: str | None = None) -> DataFrame:
    """Fill nulls with the last value before them in file order.

    With ``files`` that column comes first in the order, and values go on from one file to the next.

    Inside blocks of ``size`` places first; what a block inherits comes from a table
    of one row a block, so one long file doesn't go through one task.
    """
    part = part or []
    blocks = lines.withColumn("__block", F.floor(F.col(order) / size))
    lead = [files] if files else []
    last = blocks.groupBy(*part, *lead, "__block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("__last"))
    earlier = Window.partitionBy(*part).orderBy(*lead, "__block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("__before", F.last("__last", ignorenulls=True).over(earlier)).drop("__last")
    inside = Window.partitionBy(*part, *lead, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = blocks.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    on = F.lit(True)
    renamed = last.select(*(F.col(c).alias(f"__{c}") for c in part + lead), F.col("__block").alias("__other"), "__before")
    for c in part + lead:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    met = filled.join(renamed, on & (F.col("__block") == F.col("__other")))
    return met.withColumn(value, F.coalesce(value, "__before")).select(*lines.columns)


def execution_statistics(tasks: DataFrame) -> DataFrame:
    """One row over tasks (ok, seconds): their number, those that succeeded and failed, total and mean time, rate."""
    ok = F.col("ok")
    n = F.count("*")
    return tasks.agg(n.alias("n_tasks"), F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"), F.avg("seconds").alias("mean_seconds"), F.when(n > 0, F.count_if(ok) / n).otherwise(0.0).alias("success_rate"))


def parallelism(n_chunks: int, cores: int) -> int:
    """Tasks at once: no more than chunks or cores, half the cores for two to four chunks a core."""
    if n_chunks > 4 * cores:
        return cores
    if n_chunks > 2 * cores:
        return max(1, cores // 2)
    return min(n_chunks, cores)


def workers(cores: int, available_mb: float | None = None, per_worker_mb: int = 1000, most: int | None = None) -> int:
    """Workers that cores and memory allow, one at least."""
    found = cores if most is None else min(most, cores)
    return found if available_mb is None else min(found, max(1, int(available_mb / per_worker_mb)))


def plan_summary(chunks: DataFrame) -> DataFrame:
    """Number, mean, upper median, least and largest size of chunks."""
    size = F.col("end") - F.col("start")
    return chunks.agg(F.count("*").alias("n_chunks"), F.avg(size).alias("mean_size"), F.element_at(F.array_sort(F.collect_list(size)), (F.floor(F.count("*") / 2) + 1).cast("int")).alias("median_size"), F.min(size).alias("min_size"), F.max(size).alias("max_size"))

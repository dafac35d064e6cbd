"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that stays together.  Groups go, largest
first, to the shard with the fewest bytes so far, kept in a heap.

The heap needs a global order, so only a bounded list reaches the driver: every
group of at least ``1 / ITEMS`` of all bytes is an item of its own (there can be
``ITEMS`` of them at most), and all smaller groups are bundled by the hash of
their text into ``ITEMS`` bundles, each an item as well.  One rule holds at every
size, and groups are never split.  So any shard holds at most the mean plus the largest
item: the largest group, or for small groups a bundle, on average ``1 / ITEMS`` of them.

Rows and cases: a null text counts as an empty one (the same group, size 1), null
``doc_id`` is kept, repeated rows are rows of one group, an empty table gives an
empty result.  A group larger than the mean shard can't be balanced without
splitting it; its shard then holds little else.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage

ITEMS = 1 << 16


def schedule(items: list[tuple[int, object]], shards: int) -> dict:
    """Shard of each (size, key): largest first, ties by key, to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, key in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def group_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def bundle_of(key: Column) -> Column:
    return F.conv(F.substring(F.hex(key), 1, 4), 16, 10).cast("int") % ITEMS


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Columns of ``docs`` that matter here plus shard and slot.

    Returns doc_id, size, text_crc32, shard, slot; slots are gapless from 0 in a
    shard.  Only sizes and hashes are shuffled, never texts.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), group_key(text).alias("key"))
    groups = storage.stage(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * ITEMS >= total
    own = groups.filter(large).collect()  # ITEMS rows at most
    bundles = groups.filter(~large).groupBy(bundle_of(F.col("key")).alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()
    placed = schedule([(r.bytes, bytes(r.key).hex()) for r in own] + [(r.bytes, r.bundle) for r in bundles], shards)
    by_key = spark.createDataFrame([(r.key, placed[bytes(r.key).hex()]) for r in own], "key binary, own_shard int")
    by_bundle = spark.createDataFrame([(r.bundle, placed[r.bundle]) for r in bundles], "bundle int, bundle_shard int")
    placed_rows = (
        rows.join(F.broadcast(by_key), "key", "left")  # both sides of a proven size: ITEMS rows
        .withColumn("bundle", bundle_of(F.col("key")))
        .join(F.broadcast(by_bundle), "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "bundle_shard").alias("shard"))
    )
    return number(placed_rows, shards)


def number(rows: DataFrame, shards: int) -> DataFrame:
    """Add gapless slots in each shard: a count in each partition, then an offset for each.

    The counted rows are staged, so both passes see the same partitions.
    """

    def count(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * shards
        for batch in batches:
            slots = []
            for shard in batch.column(batch.schema.get_field_index("shard")).to_pylist():
                slots.append(seen[shard])
                seen[shard] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(slots), pa.int64()), pa.array(slots, pa.int64())], [*batch.schema.names, "part", "local"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    counted = storage.stage(rows.mapInArrow(count, f"{fields}, part long, local long"), "slots")
    per_part = counted.groupBy("part", "shard").agg(F.count("*").alias("n"))
    offsets = prefix(per_part, "shard", "part", "n").withColumnRenamed("before", "base")
    if offsets.count() <= storage.BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return counted.join(offsets, ["part", "shard"]).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("local")).alias("slot"))


def prefix(sums: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Sums of all earlier rows in a group; ``sums`` has a row for each input partition and group."""
    from pyspark.sql import Window

    window = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return storage.stage(sums.select(group, order, F.coalesce(F.sum(value).over(window), F.lit(0)).alias("before")), "offsets")

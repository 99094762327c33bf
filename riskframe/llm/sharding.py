"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key's shard depends on the key and the number of shards alone; no ring table is kept. Growing
from n to n + 1 shards moves about 1/(n + 1) of the keys, all of them into the new shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.tables import map_arrow, text_or_empty, written

JUMP_FACTOR = np.uint64(2862933555777941757)  # the LCG of the published algorithm


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of every 64-bit key, vectorised; a key leaves the loop when its jump passes n."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    at = np.zeros(len(state), np.int64)
    while len(live):
        shard[live] = at
        s = state[live] * JUMP_FACTOR + np.uint64(1)
        state[live] = s
        nxt = ((at + 1) * (float(1 << 31) / ((s >> np.uint64(33)).astype(np.float64) + 1.0)))
        nxt = np.minimum(nxt, float(1 << 62)).astype(np.int64)
        go = nxt < n_shards
        live, at = live[go], nxt[go]
    return shard


def assign_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                  overhead_bytes: int = 8) -> DataFrame:
    """One row per input row: id, size, crc32, shard, slot in the shard, shard if one is added.

    The key is Spark's ``xxhash64`` of the id written as text, so an id keeps its shard when
    its column changes from int to bigint or string; null ids share one key, repeated ids share a
    shard. A null text has no bytes (size ``overhead_bytes``, crc32 0). Slots number each
    shard's rows from 0 without gaps in the order (id, size, crc32), null ids first; the order
    among wholly equal rows is arbitrary. Extra columns are not carried.

    Rows are range-partitioned on (id, size, crc32, input position), so an id that holds a third
    of the rows spreads over many tasks; each task numbers its own rows, and per-task counts
    (shards x tasks, small) give the offsets.
    """
    raw = F.encode(text_or_empty(text_col), "UTF-8")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_or_empty(text_col)).cast("long") + overhead_bytes).alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(
            F.col(id_col).cast("string")).alias("__key"))
    # Narrow and written once: the range partitioner samples it without rereading the texts.
    rows = written(rows.withColumn("__pos", F.monotonically_increasing_id()), "shard-rows")
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "size", "text_crc32", "__pos")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbered = written(map_arrow(
        ranged.withColumn("__task", F.spark_partition_id()), _number_rows(n_shards),
        f"doc_id {kind}, size bigint, text_crc32 bigint, shard int, grown_shard int, "
        "__task int, __rank bigint"), "shard-numbered")
    counts = numbered.groupBy("shard", "__task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__task").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__task",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return numbered.join(offsets, ["shard", "__task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("__before") + F.col("__rank")).alias("slot"), "grown_shard")


def _number_rows(n_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_shards, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("__key").to_numpy(zero_copy_only=False).view(np.uint64)
            shard, grown = jump_hash(keys, n_shards), jump_hash(keys, n_shards + 1)
            order = np.argsort(shard, kind="stable")
            size = np.bincount(shard, minlength=n_shards)
            first = np.cumsum(size) - size
            rank = np.empty(len(shard), np.int64)
            rank[order] = np.arange(len(shard)) - np.repeat(first, size)
            rank += seen[shard]
            seen += size
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("size"), b.column("text_crc32"),
                 pa.array(shard, pa.int32()), pa.array(grown, pa.int32()), b.column("__task"),
                 pa.array(rank)],
                ["doc_id", "size", "text_crc32", "shard", "grown_shard", "__task", "__rank"])

    return run

"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Row numbers follow (doc_id, text's crc32, size).  The permutation of [0, rows) is a
balanced Feistel network over the least even number of bits that holds all rows; an image
outside is sent through again until it falls inside.  The permuted number p gives the shard
p % shards and the slot p // shards, so both can be computed for any row number without
the others, counts differ by one at most and slots have no gaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewake.llm.common import positioned

ROUNDS = 6
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 on x + key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key & int(_MASK))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The images of ``rows`` (each in [0, n)) under the permutation of [0, n)."""
    half = max(1, -(-max(1, int(n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    x = np.asarray(rows, np.uint64).copy()
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for k in range(ROUNDS):
            left, right = right, left ^ (_mixed(right, (seed * ROUNDS + k + 1) * 0x9E3779B97F4A7C15) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def assign_shards(docs: DataFrame, shards: int = 24, seed: int = 20240) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``.

    ``law`` is ``rows``: counts at most one apart.  A null text has no bytes, so size 8 and
    crc32 0.  Rows that are equal in all of (doc_id, crc32, size) take their numbers in any
    order, which is the same result.  An empty table gives an empty result.  Only
    the three numbers of a row are moved, never its text.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    laid, _ = positioned(rows, ["doc_id", "text_crc32", "size"], "shards")
    total = laid.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = permuted(batch.column("position").to_numpy(), total, seed)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("doc_id", "size", "text_crc32")), pa.array(["rows"] * len(p)), pa.array((p % shards).astype(np.int32)), pa.array(p // shards), pa.nulls(len(p), pa.int32())],
                names=["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
            )

    return laid.mapInArrow(run, "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 20240) -> None:
    """Write the rows of ``docs`` under ``path/shard=k``, each shard in slot order.

    A shard is range-partitioned by slot, so it may be many files; their names ascend with
    the slots.  Rows are matched to their shard by (doc_id, crc32, size); of rows equal in these the
    i-th is matched with the i-th.
    """
    key = ["doc_id", "_size", "_crc"]
    own = docs.select("*", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("_size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_crc"))
    laid, _ = positioned(own, ["doc_id", "_crc", "_size"], "shard-rows")
    total = laid.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = permuted(batch.column("position").to_numpy(), total, seed)
            yield batch.append_column("shard", pa.array((p % shards).astype(np.int32))).append_column("slot", pa.array(p // shards))

    schema = StructType([*laid.schema, StructField("shard", IntegerType()), StructField("slot", LongType())])
    out = laid.mapInArrow(run, schema).drop("position", *key[1:])
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)

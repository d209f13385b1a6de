"""Shared plumbing: the cluster's scratch folder, staged tables and global row positions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_SCRATCH: dict[str, str] = {}
_STAGED: list[str] = []

#: Most bytes of texts that a Python worker handles at once (a longer text is one block).
BLOCK_BYTES = 1_000_000

#: Most bytes of a batch between the JVM and a Python worker while a staged table is written (one row at least).
BATCH_BYTES = "8m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where it is unset (tests on a local master) a temporary folder is made; on a
    cluster that would be machine-local, so there it is an error.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        there = held.get() if held.isDefined() else None
    if not there:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = _OWN_SCRATCH.setdefault(app, tempfile.mkdtemp(prefix="tidewake-"))
    return there.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidewake-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: files survive lost executors, and nothing is computed twice.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    _STAGED.append(path)
    own = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, own)
    return spark.read.schema(df.schema).parquet(path), path


def staged_paths() -> set[str]:
    """The staged tables of this driver that have not been deleted."""
    return set(_STAGED)


def release(spark: SparkSession, paths: set[str]) -> None:
    """Delete staged tables, when the results that read them are written."""
    for path in paths:
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table through Hadoop's file system, wherever it lies."""
    if path in _STAGED:
        _STAGED.remove(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def slices_of(sizes: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive rows whose ``sizes`` are at most ``limit`` together (a larger row is alone)."""
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last - first
        first = last


def slices(columns: list[pa.Array], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """``slices_of`` the bytes of the texts in ``columns``."""
    return slices_of(sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in columns), limit)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows with at most ``limit`` bytes together; null is empty.

    Only one block's rows are Python strings at a time.
    """
    own = batch.column(column)
    for first, n in slices([own], limit):
        yield first, [t or "" for t in own.slice(first, n).to_pylist()]


#: A key with more rows is dealt over several tasks, and at most so many keys are.
HOT_ROWS, HOT_KEYS = 64, 20_000


def spread_join(rows: DataFrame, keyed: DataFrame, on: str, deal: Column, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row for each value of ``on`` and in ``n`` the number of its rows.

    The rows of a key that has many are dealt by ``deal`` (an integer, the same at every evaluation) over several tasks, and the
    key's row of ``keyed`` goes to each of them.  ``total`` is the number of rows, or more: so fewer than ``HOT_KEYS`` keys have more than a
    ``HOT_KEYS``-th of them, and only these keys are broadcast.
    """
    most = max(HOT_ROWS, total // HOT_KEYS)
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = keyed.filter(F.col("n") > most).select(on, parts.alias("_parts"))
    left = rows.join(F.broadcast(hot), on, "left").withColumn("_deal", F.coalesce(F.pmod(deal, F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    right = keyed.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))).drop("n")
    return left.join(right, [on, "_deal"], how).drop("_deal")


def positioned(df: DataFrame, order: list, name: str, part: str | None = None) -> tuple[DataFrame, str]:
    """``df`` staged with ``position``: the row's 0-based place in the global order of ``order``.

    Rows are range-partitioned, so a long run of equal leading keys is split by the
    later ones, and rows equal in all of them by their place in the input; the driver sees one count per partition.  The staged table is
    returned with its path.  Pass narrow frames that read a table: texts need not be moved for a row number.
    ``part`` names a column for the row's partition, an interval of positions.
    """
    spark = df.sparkSession
    laid = (
        df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    held, path = stage(laid, name)
    counts = sorted((r["_part"], r["n"]) for r in held.groupBy("_part").agg(F.count("*").alias("n")).collect())
    base, rows = 0, []
    for k, n in counts:
        rows.append((k, base))
        base += n
    bases = spark.createDataFrame(rows, "_part int, _base long")  # one row per partition, of which the session's setting has so many
    out = held.join(F.broadcast(bases), "_part").withColumn("position", F.col("_base") + F.col("_seq"))
    return (out.withColumnRenamed("_part", part) if part else out.drop("_part")).drop("_seq", "_base"), path

"""Tables under a warehouse root, with keyed replacement by buckets, and the incremental transforms.

A table is a folder of data directories and numbered manifests; the highest manifest lists the directories that are current, the schema, and
the labels of the batches that went in.  A writer that is lost leaves the old manifest in place, readers never see half
of a new one, and a labelled batch that is written again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewake import schemas
from tidewake.config import DEFAULT, Config
from tidewake.operators import sequence, silver
from tidewake.sources.files import raw_reports

#: Tables that are replaced by ship, each in so many buckets: a batch rewrites only those of its ships.
BUCKETS = {"periods": 64, "port_calls": 64, "progress": 16}
_SLOT = "at_bucket"


@dataclass
class Manifest:
    """What is current: (bucket or None, directory) pairs, the schema as JSON, labels of batches, and the version."""

    entries: list[tuple[int | None, str]] = field(default_factory=list)
    schema: dict | None = None
    labels: list[str] = field(default_factory=list)
    version: int = 0

    def fields(self) -> StructType:
        return StructType.fromJson(self.schema) if self.schema else StructType([])


class Warehouse:
    """``root`` is any path that Spark can write; versions kept back: ``keep``."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2, buckets: dict[str, int] | None = None) -> None:
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.buckets = BUCKETS if buckets is None else buckets
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def _fs(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self, name: str) -> list[int]:
        return sorted(int(v[1:-5]) for v in self._names(f"{self.root}/{name}") if v[0] == "v" and v.endswith(".json"))

    def tables(self) -> list[str]:
        return self._names(self.root)

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def columns(self, name: str) -> dict[str, str]:
        """Name and type of each column; none for a missing table."""
        return {f.name: f.dataType.simpleString() for f in self.manifest(name).fields()}

    def manifest(self, name: str, version: int | None = None) -> Manifest:
        held = self.versions(name)
        if not held:
            return Manifest()
        version = held[-1] if version is None else version
        fs, p = self._fs(f"{self.root}/{name}/v{version}.json")
        stream = fs.open(p)
        text = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return Manifest([tuple(e) for e in text["entries"]], text["schema"], text["labels"], version)

    def _commit(self, name: str, new: Manifest) -> None:
        """Write the next manifest in one rename; a writer that was faster is an error.  Then forget what no kept manifest lists."""
        text = json.dumps({"entries": new.entries, "schema": new.schema, "labels": new.labels})
        target = f"{self.root}/{name}/v{new.version + 1}.json"
        fs, p = self._fs(f"{target}.{uuid.uuid4().hex}.tmp")
        out = fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(self._path(target)) or not fs.rename(p, self._path(target)):
            fs.delete(p, False)
            raise RuntimeError(f"{name}: another writer was faster")
        held = self.versions(name)
        kept = {e[1].split("/")[0] for v in held[-self.keep :] for e in self.manifest(name, v).entries}
        for v in held[: -self.keep]:
            fs.delete(self._path(f"{self.root}/{name}/v{v}.json"), False)
        for d in self._names(f"{self.root}/{name}/data"):
            if d not in kept:
                fs.delete(self._path(f"{self.root}/{name}/data/{d}"), True)

    def _write(self, name: str, df: DataFrame) -> list[tuple[int | None, str]]:
        """The data directories of the rows."""
        at = uuid.uuid4().hex
        path, n = f"{self.root}/{name}/data/{at}", self.buckets.get(name)
        if not n:
            df.write.parquet(path)
            return [(None, at)]
        own = df.withColumn(_SLOT, self._bucket(name))
        own.repartition(_SLOT).write.partitionBy(_SLOT).parquet(path)
        return [(int(d.split("=")[1]), f"{at}/{d}") for d in self._names(path) if d.startswith(f"{_SLOT}=")]

    def _bucket(self, name: str):
        return F.pmod(F.xxhash64(F.col("mmsi").cast("long")), F.lit(self.buckets[name])).cast("int")

    def _load(self, name: str, held: Manifest, buckets: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/{name}/data/{d}" for k, d in held.entries if buckets is None or k in buckets]
        return self.spark.read.schema(held.fields()).parquet(*paths) if paths else self.spark.createDataFrame([], held.fields())

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """The current rows; columns that were added later read as null in old rows; a missing table is empty."""
        held = self.manifest(name)
        if not held.version:
            if schema is None:
                raise LookupError(f"no table {name}")
            return self.spark.createDataFrame([], schema)
        df = self._load(name, held)
        return schemas.conform(df, schema) if schema else df

    def replace(self, name: str, df: DataFrame, label: str | None = None) -> int:
        """Write a new version; returns its rows."""
        held = self.manifest(name)
        self._commit(name, Manifest(self._write(name, df), df.schema.jsonValue(), [label] if label else [], held.version))
        return self.read(name).count()

    def append(self, name: str, df: DataFrame, label: str | None = None) -> None:
        """Add rows; new columns are allowed.  A batch whose label is there already adds nothing."""
        held = self.manifest(name)
        if label and label in held.labels:
            return
        known = {f.name for f in held.fields()}
        wider = StructType([*held.fields(), *[f for f in df.schema if f.name not in known]])
        self._commit(name, Manifest(held.entries + self._write(name, df), wider.jsonValue(), held.labels + [label] * bool(label), held.version))

    def _renew(self, name: str, new: DataFrame, keys: DataFrame, kept: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite the buckets that hold the keys: of their rows those ``kept``, and the new ones."""
        held = self.manifest(name)
        if not held.version:
            self.replace(name, new)
            return
        schemas.assert_same_schema(new, self.read(name))
        touched = None
        if self.buckets.get(name):
            touched = {r[0] for r in keys.select(self._bucket(name)).distinct().collect()}  # at most the table's buckets
        rows = kept(self._load(name, held, touched)).unionByName(new)
        others = [] if touched is None else [e for e in held.entries if e[0] not in touched]
        self._commit(name, Manifest(others + self._write(name, rows), held.schema, held.labels, held.version))

    def replace_keys(self, name: str, new: DataFrame, keys: DataFrame, on: list[str]) -> None:
        """Rows of the keys go, the new ones come: also for keys that have no new row.  New rows are of these keys."""
        own = keys.distinct()
        self._renew(name, new, own, lambda old: old.join(own.select(*on).distinct(), on, "left_anti"))

    def replace_since(self, name: str, new: DataFrame, since: DataFrame, key: str, at: str) -> None:
        """Rows at or after ``since`` of their key go (all of them where it is null), the new ones come."""

        def kept(old: DataFrame) -> DataFrame:
            marked = old.join(since.select(key, "since").withColumn("_in", F.lit(True)), key, "left")
            return marked.filter(F.col("_in").isNull() | (F.col(at) < F.col("since"))).select(*old.columns)

        self._renew(name, new, since, kept)

    def upload(self, name: str, df: DataFrame, casts: dict[str, str] | None = None, temporary: bool = False) -> int:
        """Replace the table by the rows, columns cast as said; returns how many.  A temporary one is a view of the session."""
        own = df.select(*[F.col(c).cast(k).alias(c) for c, k in casts.items()]) if casts else df
        if temporary:
            own.createOrReplaceTempView(name)
            return own.count()
        return self.replace(name, own)

    def copy(self, name: str, to: Warehouse) -> int:
        """Copy a table and compare the counts."""
        source = self.read(name)
        n = to.replace(name, source)
        if n != source.count():
            raise RuntimeError(f"{name}: {n} rows arrived")
        return n


def append_batch(house: Warehouse, rows: DataFrame, received_at: datetime | None = None, label: str | None = None) -> None:
    """Append raw reports; all of them get ``received_at`` where it is given.  Missing columns are null."""
    df = rows.withColumn("received_at", F.lit(received_at).cast("timestamp_ntz")) if received_at else rows
    house.append("bronze", schemas.conform(df, schemas.RAW), label)


def ingest(house: Warehouse, fetch: Callable[[], list[dict]], received_at: datetime) -> int:
    """Fetch reports, store them, and say how many came; none is no batch.  One report is a list of one."""
    rows = fetch()
    if rows:
        append_batch(house, raw_reports(house.spark, rows, received_at))
    return len(rows)


def finish_routing(house: Warehouse) -> None:
    """Append the outcomes of the staged batch where they are missing: after a writer was lost between the two appends."""
    pending = house.manifest("staged_batch")
    for label in pending.labels:
        marked = house.read("staged_batch")
        house.append("silver", schemas.conform(silver.accepted(marked), schemas.SILVER), label)
        house.append("quarantine", schemas.conform(silver.rejected(marked), schemas.QUARANTINE), label)


def routed(house: Warehouse, label: str) -> bool:
    return label in house.manifest("quarantine").labels


def route(house: Warehouse, staged: DataFrame, label: str | None = None) -> None:
    """Append the accepted and the rejected rows of one batch, once.

    The batch is written first, with its label: it was compared with the accepted rows, which the first append changes.  A batch
    that was not routed to its end is finished before the next one is staged.
    """
    house.replace("staged_batch", staged, label or uuid.uuid4().hex)
    finish_routing(house)


def run_silver(house: Warehouse, as_of: datetime, rejected_too: bool = False) -> None:
    """Validate what arrived after the last run, then check that no row was lost.

    A report is a repeat of those accepted before; with ``rejected_too`` also of those rejected before, so that any split into
    batches gives what one batch gives.  Without it a report that was rejected may be sent again, mended.
    """
    finish_routing(house)
    bronze = house.read("bronze", schemas.RAW)
    done, out = house.read("silver", schemas.SILVER), house.read("quarantine", schemas.QUARANTINE)
    batch = silver.newer_than(bronze, silver.watermark(done, out))
    known = done.select("mmsi", "message_time")
    if rejected_too:
        known = known.unionByName(out.select("mmsi", F.col("msgtime").alias("message_time")))
    route(house, silver.staged(batch, as_of, known))
    silver.assert_conserved(bronze.count(), house.read("silver").count(), house.read("quarantine").count())


def record_progress(house: Warehouse, layer: str, seen: DataFrame) -> None:
    """Upsert (layer, mmsi) -> built_from_received_at."""
    new = seen.select(F.lit(layer).alias("layer"), "mmsi", "built_from_received_at")
    house.replace_keys("progress", schemas.conform(new, schemas.PROGRESS), new.select("layer", "mmsi"), ["layer", "mmsi"])


def rules_version(house: Warehouse, layer: str) -> int | None:
    row = house.read("rules", schemas.RULES).filter(F.col("layer") == layer).first()
    return row["version"] if row else None


def set_rules_version(house: Warehouse, layer: str, version: int) -> None:
    new = house.spark.createDataFrame([(layer, version)], schemas.RULES)
    house.replace_keys("rules", new, new, ["layer"])


def new_readings(house: Warehouse) -> DataFrame:
    """Accepted readings that the state periods do not know yet."""
    progress = house.read("progress", schemas.PROGRESS).filter("layer = 'periods'").select("mmsi", "built_from_received_at")
    held = house.read("silver", schemas.SILVER).join(progress, "mmsi", "left")
    return held.filter(F.col("built_from_received_at").isNull() | (F.col("received_at") > F.col("built_from_received_at"))).drop("built_from_received_at")


def run_periods(house: Warehouse, c: Config = DEFAULT) -> None:
    """Derive the tail of every ship with new readings again, then check that each reading is in one period."""
    fresh = new_readings(house)
    if fresh.isEmpty():
        return
    periods = house.read("periods", schemas.PERIODS)
    starts = sequence.restart_points(periods, fresh, c).persist()
    readings = house.read("silver", schemas.SILVER)
    tail = readings.join(starts, "mmsi").filter(F.col("message_time") >= F.col("since")).select(*readings.columns)
    new = schemas.conform(sequence.state_periods(tail, c, starts), schemas.PERIODS)
    seen = fresh.groupBy("mmsi").agg(F.max("received_at").alias("built_from_received_at"))
    house.replace_since("periods", new, starts, "mmsi", "start_time")
    record_progress(house, "periods", seen)
    starts.unpersist()
    covered = house.read("periods", schemas.PERIODS).agg(F.coalesce(F.sum("n_readings"), F.lit(0))).first()[0]
    if covered != readings.count():
        raise RuntimeError(f"{covered} readings in periods, {readings.count()} accepted")


def run_port_calls(house: Warehouse, rebuild_all: bool = False, c: Config = DEFAULT) -> bool:
    """Derive the visits of ships whose periods changed, or of all after a change of rules; whether it was all."""
    everything = rebuild_all or rules_version(house, "port_calls") != c.rules_version
    progress = house.read("progress", schemas.PROGRESS)
    periods_at = progress.filter("layer = 'periods'").select("mmsi", "built_from_received_at")
    calls_at = progress.filter("layer = 'port_calls'").select("mmsi", F.col("built_from_received_at").alias("done_at"))
    todo = periods_at.join(calls_at, "mmsi", "left")
    if not everything:
        todo = todo.filter(F.col("done_at").isNull() | (F.col("done_at") < F.col("built_from_received_at")))
    todo = todo.persist()
    if not todo.isEmpty():
        periods = house.read("periods", schemas.PERIODS).join(todo.select("mmsi"), "mmsi", "left_semi")
        new = schemas.conform(sequence.port_calls(periods, c), schemas.PORT_CALLS)
        house.replace_keys("port_calls", new, todo, ["mmsi"])
        record_progress(house, "port_calls", todo)
    set_rules_version(house, "port_calls", c.rules_version)
    todo.unpersist()
    return everything


def refresh_layer(house: Warehouse, name: str, fetch: Callable[[], list[dict]], now: datetime, days: int = 30, required: bool = False) -> DataFrame:
    """A map layer that is fetched again after ``days``; an old copy is kept where fetching fails."""
    held = house.read(name, schemas.BOXES)
    age = held.agg(F.max("fetched_at")).first()[0]
    if age is None or (now - age).days >= days:
        try:
            rows = fetch()
            if not rows:
                raise LookupError(f"{name}: nothing came back")
            new = house.spark.createDataFrame([r | {"fetched_at": now} for r in rows], schemas.BOXES)
            house.replace(name, new)
            return house.read(name, schemas.BOXES)
        except Exception:
            if age is None and required:
                raise
    return held

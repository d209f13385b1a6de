"""Token-id binary output: frequency-ranked ids, byte-aligned codes, separate control bytes.

File format.  A Parquet table (so that any store and any lost task is handled by Spark's
committer) of blocks in ascending document order::

    part int          range of documents, ascending
    block int         number of the block in its part
    start long        ids before the block in its part
    doc_ids, n_tokens the documents of the block and their numbers of ids
    control binary    two bits per id: its code's bytes less one, four ids to a byte, low bits first;
                      every document begins a new byte
    data binary       the codes' bytes, little-endian, without gaps

A code is the id's rank by falling frequency (ties: lower id first) over the whole corpus;
``ranks`` next to the blocks gives the id of each rank, one row per id, at most the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import drop_path, scratch_path, shuffle_partitions, slices, stage
from tidewake.llm.tokens import BLOCK, encoder, model_of

#: Ids that make a block full; a block has whole documents, one at least.
BLOCK_IDS = 1 << 16
#: Sampled rows for each part, from which the parts' borders are taken.
SAMPLED = 200

#: For each control byte the lengths of its four codes.
LENGTHS = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.uint8)


def encode_ids(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data of documents with ``counts`` ranks each (under 2**32), and where each document's end in both."""
    r = ranks.astype("<u4")
    extra = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    held = -(-counts // 4)
    padded = np.zeros(4 * int(held.sum()), np.uint8)
    spare = 4 * held - counts
    padded[np.arange(len(r)) + np.repeat(np.cumsum(spare) - spare, counts)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    kept = np.arange(4, dtype=np.uint8)[None, :] <= extra[:, None]
    ends = np.r_[0, np.cumsum(extra, dtype=np.int64) + np.arange(1, len(r) + 1)]
    return control, r.view(np.uint8).reshape(-1, 4)[kept], np.cumsum(held), ends[np.cumsum(counts)]


def decode_block(control: bytes, data: bytes, n: np.ndarray) -> np.ndarray:
    """The ranks of documents with ``n`` ids each: code lengths come from a table lookup by control byte."""
    held = -(-n // 4)
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    spare = 4 * held - n
    if spare.any():  # a document's last control byte may have places without a code
        ends = 4 * np.cumsum(held)
        used = np.ones(len(lengths), np.bool_)
        for k in (1, 2, 3):
            used[ends[spare >= k] - k] = False
        lengths = lengths[used]
    ends = np.cumsum(lengths, dtype=np.int64)
    at = ends - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype("<u4")
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if len(longer):
            out[longer] |= raw[at[longer] + k].astype("<u4") << np.uint32(8 * k)
    return out


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array whose values lie in ``flat`` (bytes) one after another."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value begins; the last one is the end."""
    own = column.cast(pa.large_binary())
    at = np.frombuffer(own.buffers()[1], np.int64, len(own) + 1, own.offset * 8)
    held = own.buffers()[2]
    return (np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)), at


def _kind(tokenizer: str, end_id: int) -> str:
    """The narrowest type that holds all ids of the tokenizer."""
    model = model_of(tokenizer)
    most = max(end_id, *model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"]))
    return "<u2" if most < 1 << 16 else "<u4"


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, words=False)
        for batch in batches:
            doc_ids, own = batch.column("doc_id").cast(pa.int64()), batch.column("text")
            for first, n in slices([own], BLOCK):
                ids, counts = enc.encode(own.slice(first, n))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                ends = np.cumsum(counts + 1)
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([doc_ids.slice(first, n), pa.array(counts + 1, pa.int64()), pa.array(crc, pa.int64()), _binary(ids.astype(kind).view(np.uint8), width * ends)], names=["doc_id", "n_tokens", "crc", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, crc long, ids binary")


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    """All ids of a column, document by document."""
    flat, at = _bytes(column)
    return flat[at[0] : at[-1]].view(kind)


def _frequencies(tokens: DataFrame, kind: str) -> list[tuple[int, int]]:
    """(id, count) over the corpus: summed in each task first; one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for first, k in slices([batch.column("ids")]):
                n = np.bincount(_flat(batch.column("ids").slice(first, k), kind))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return [(r["id"], r["n"]) for r in counts.collect()]


def _place(doc_id: np.ndarray, none: np.ndarray, crc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Keys that sort as (doc_id, null first; crc; tie) do."""
    out = np.zeros(len(doc_id), [("id", "u8"), ("crc", "u8")])
    out["id"] = np.where(none, np.uint64(0), doc_id.astype(np.uint64) ^ np.uint64(1 << 63))
    out["crc"] = ((~none).astype(np.uint64) << np.uint64(63)) | (crc.astype(np.uint64) << np.uint64(24)) | tie.astype(np.uint64)
    return out


def _keys(batch: pa.RecordBatch, tie: np.ndarray) -> np.ndarray:
    own = batch.column("doc_id")
    return _place(pc.fill_null(own, 0).to_numpy(), own.is_null().to_numpy(zero_copy_only=False), batch.column("crc").to_numpy(), tie)


def _ties(seed: int, at: int, n: int) -> np.ndarray:
    """24 bits for the rows ``at`` to ``at + n`` of a task: rows alike in all else are dealt out by them."""
    x = (np.arange(at, at + n, dtype=np.uint64) + np.uint64(seed << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(40)


def _borders(tokens: DataFrame, parts: int) -> np.ndarray:
    """At most ``parts`` - 1 keys that divide the rows about evenly, from a sample of about ``SAMPLED`` rows for each part.

    They decide how much a task has, not the result.
    """
    rows = tokens.count()
    share = min(1.0, SAMPLED * parts / max(1, rows))
    some = tokens.select("doc_id", "crc").sample(share, seed=7).toArrow()
    batch = some.combine_chunks().to_batches()
    if not batch:
        return np.zeros(0, [("id", "u8"), ("crc", "u8")])
    keys = np.sort(_keys(batch[0], _ties(1 << 20, 0, batch[0].num_rows)), order=("id", "crc"))
    return np.unique(keys[np.arange(1, parts) * len(keys) // parts])


def write_tokens(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> None:
    """Encode ``text`` of ``docs`` (doc_id, text, ...) and write the binary table at ``path``.

    Null texts are empty and have the end id only.  Rows are written by ascending doc_id (null
    first), rows of one doc_id by the crc32 of their ids; repeated rows are all kept; other columns are not
    read.  An empty table makes an empty file set.  Rows that share a doc_id, or have none, may lie in several parts.
    """
    spark = docs.sparkSession
    kind = _kind(tokenizer, end_id)
    tokens, held_at = stage(_tokenised(docs, tokenizer, end_id, kind), "tokens")
    counts = _frequencies(tokens, kind)
    by_rank = sorted(counts, key=lambda x: (-x[1], x[0]))
    id_of = [i for i, _ in by_rank]
    spark.createDataFrame(list(enumerate(id_of)), "rank long, id long").coalesce(1).write.mode("overwrite").parquet(f"{path}/ranks")
    rank_of = np.zeros(max(id_of, default=0) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    parts = shuffle_partitions(spark)
    borders = _borders(tokens, parts)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            part = np.searchsorted(borders, _keys(batch, _ties(task, at, batch.num_rows)), "right").astype(np.int32)
            at += batch.num_rows
            for first, k in slices([batch.column("ids")]):
                own = batch.slice(first, k)
                n = own.column("n_tokens").to_numpy()
                control, data, control_ends, data_ends = encode_ids(rank_of[_flat(own.column("ids"), kind)], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[first : first + k]), *(own.column(c) for c in ("doc_id", "crc", "n_tokens")), _binary(control, control_ends), _binary(data, data_ends)],
                    names=["part", "doc_id", "crc", "n_tokens", "control", "data"],
                )

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive rows of a part until they have ``BLOCK_IDS`` ids; a batch's last rows wait for the next."""
        held: list[pa.RecordBatch] = []
        part, number, start, waiting = None, 0, 0, 0

        def made(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            own = [[r.column(c) for r in rows] for c in ("doc_id", "n_tokens", "control", "data")]
            flat = [pa.concat_arrays(x) for x in own[:2]]
            joined = [b"".join(f[a[0] : a[-1]].tobytes() for f, a in map(_bytes, x)) for x in own[2:]]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in flat), *(pa.array([x], pa.binary()) for x in joined)],
                names=["part", "block", "start", "doc_ids", "n_tokens", "control", "data"],
            )

        for batch in batches:
            parts_, ends = batch.column("part").to_numpy(), np.cumsum(batch.column("n_tokens").to_numpy())
            first = 0
            while first < batch.num_rows:
                own = int(parts_[first])
                if held and own != part:
                    yield made(held)
                    held, waiting = [], 0
                if own != part:
                    part, number, start = own, 0, 0
                before = int(ends[first - 1]) if first else 0
                until = int(np.searchsorted(parts_, own, "right"))
                last = min(until, 1 + int(np.searchsorted(ends, before + BLOCK_IDS - waiting)))
                held.append(batch.slice(first, last - first))
                waiting += int(ends[last - 1]) - before
                if waiting >= BLOCK_IDS:
                    yield made(held)
                    number, start, held, waiting = number + 1, start + waiting, [], 0
                first = last
        if held:
            yield made(held)

    laid = tokens.mapInArrow(coded, "part int, doc_id long, crc long, n_tokens long, control binary, data binary")
    laid = laid.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "crc", "n_tokens", "control", "data")
    made = laid.mapInArrow(blocked, "part int, block int, start long, doc_ids array<long>, n_tokens array<long>, control binary, data binary")
    made.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/blocks")
    drop_path(spark, held_at)


def read_tokens(spark: SparkSession, path: str, digest: bool = True) -> DataFrame:
    """Documents of the binary table: doc_id, start, n_tokens, then ids_crc32 or, without ``digest``, ids."""
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    held = spark.read.parquet(f"{path}/blocks")
    sizes = held.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    base, before = 0, {}
    for r in sorted(sizes, key=lambda r: r["part"]):
        before[r["part"]] = base
        base += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                n = np.asarray(row["n_tokens"], np.int64)
                ids = id_of[decode_block(row["control"], row["data"], n)]
                ends = np.cumsum(n)
                each = [ids[e - k : e] for e, k in zip(ends, n)]
                last = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()) if digest else pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(before[row["part"]] + row["start"] + ends - n, pa.int64()), pa.array(n, pa.int64()), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return held.mapInArrow(run, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>"))


def token_digest(docs: DataFrame) -> DataFrame:
    """Write ``docs`` in the binary format in the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens-out")
    write_tokens(docs, path)
    return read_tokens(spark, path)

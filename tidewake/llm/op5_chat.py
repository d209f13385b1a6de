"""Preference formatting: common turns once as prompt, paired masked completions.

The operator takes pairs of conversations; :func:`paired` makes such pairs from a table of
turns.  The longest common prefix of turns (same role and text) is rendered once; what
follows it in either conversation is its completion, whose mask spans the
assistant's text and end mark, in code points of the completion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import positioned, slices_of, stage

#: Fixed marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>"


def rendered(turns: list[dict], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns, and the spans in it that are trained on."""
    out, at, spans = [], 0, []
    for t in turns:
        head, body = f"{START}{t['role']}\n", f"{t['text']}{END}"
        if t["role"] == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "\n"]
        at += len(head) + len(body) + 1
    return "".join(out), spans


def common_turns(a: list[dict], b: list[dict]) -> int:
    """Turns at the start of both with the same role and text."""
    n = 0
    for x, y in zip(a, b):
        if (x["role"], x["text"]) != (y["role"], y["text"]):
            break
        n += 1
    return n


def _said_bytes(turns: pa.ListArray) -> np.ndarray:
    """Bytes of the texts of each list of turns."""
    sums = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(turns.values.field("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
    ends = turns.offsets.to_numpy()
    return sums[ends[1:]] - sums[ends[:-1]]


def formatted(pairs: DataFrame) -> DataFrame:
    """One row per row of ``pairs`` (pair_id, chosen_id, chosen_turns, rejected_id, rejected_turns).

    The two lists of turns are structs of role and text in order.  A row whose rejected list is null has
    no counterpart: no prompt, the whole conversation as chosen completion, the rejected one null.
    Where one conversation is the start of the other its completion is the empty string; ``identical`` marks
    pairs where both are.  An empty table gives no rows; other columns are not read.  No shuffle.
    """
    name = ["pair_id", "chosen_id", "rejected_id", "n_common_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask", "identical"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
    spans = lambda x: ",".join(f"{a}:{b}" for a, b in x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(*at) for b in batches for at in slices_of(_said_bytes(b.column("chosen_turns")) + _said_bytes(b.column("rejected_turns"))))
        for part in parts:
            rows = []
            for r in part.to_pylist():
                a, b = r["chosen_turns"] or [], r["rejected_turns"]
                k = 0 if b is None else common_turns(a, b)
                chosen, mask = rendered(a[k:])
                other, other_mask = (None, []) if b is None else rendered(b[k:])
                rows.append((r["pair_id"], r["chosen_id"], r["rejected_id"], k, rendered(a[:k])[0], chosen, other, spans(mask), None if b is None else spans(other_mask), b is not None and k == len(a) == len(b)))
            yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], t) for i, t in enumerate(kinds)], names=name)

    return pairs.select("pair_id", "chosen_id", "chosen_turns", "rejected_id", "rejected_turns").mapInArrow(
        run, "pair_id string, chosen_id long, rejected_id long, n_common_turns int, prompt string, chosen string, rejected string, chosen_mask string, rejected_mask string, identical boolean"
    )


def paired(turns: DataFrame) -> DataFrame:
    """Pairs of conversations with the same opening turn, for :func:`formatted`.

    ``turns`` has conv_id, turn, role, text; other columns are not read, an empty table has no pairs.  Repeated rows are repeated turns; turns are
    ordered by (turn, role, text), null first; a null role or text is the empty string; rows without
    a conv_id belong to no conversation.  Conversations with the same opening are ordered by conv_id, and the first
    and second, third and fourth, ... are paired.  Of a pair the one with more characters in the
    assistant's turns is chosen (tie: the lower conv_id).  One that is left over is chosen against itself with
    its last reply replaced by the last reply of the next conversation in the order of (opening, conv_id), whose
    id is then the rejected one; where either has no reply it stays without a counterpart.

    A hot opening is split: places within an opening come from a range partitioning by
    (opening, conv_id), and a group that is gathered has two conversations at most.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    said = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), blank("role").alias("role"), blank("text").alias("text")).alias("t"))
    convs = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    convs = convs.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    convs = convs.withColumn("opening", F.md5(F.concat_ws("\x1f", F.col("turns")[0]["role"], F.col("turns")[0]["text"])))
    convs, _ = stage(convs, "conversations")
    places, _ = positioned(convs.select("opening", "conv_id"), ["opening", "conv_id"], "openings", "part")
    # An opening's first position, for each part that it reaches into: a common opening is one row a part, not one task.
    starts = places.groupBy("opening", "part").agg(F.min("position").alias("first"))
    starts = starts.select("opening", "part").join(starts.groupBy("opening").agg(F.min("first").alias("first")), "opening")
    slots = places.join(starts, ["opening", "part"]).select("conv_id", "position", (F.col("position") - F.col("first")).alias("rank"))
    rows, _ = stage(convs.join(slots, "conv_id"), "placed-conversations")
    total = max(1, rows.count())
    weight = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.when(t["role"] == "assistant", F.length(t["text"])).otherwise(0))
    mate = F.struct((-weight).alias("w"), F.col("conv_id"), F.col("turns"), F.col("position"))
    two = rows.groupBy("opening", F.floor(F.col("rank") / 2).alias("slot")).agg(F.sort_array(F.collect_list(mate)).alias("m"))
    two = two.select(
        F.concat_ws(":", "opening", "slot").alias("pair_id"),
        F.col("m")[0]["conv_id"].alias("chosen_id"),
        F.col("m")[0]["turns"].alias("chosen_turns"),
        F.get("m", F.lit(1))["conv_id"].alias("mate_id"),
        F.get("m", F.lit(1))["turns"].alias("mate_turns"),
        F.when(F.size("m") == 1, (F.col("m")[0]["position"] + 1) % total).alias("lender"),
    )
    reply = F.element_at(F.filter("turns", lambda t: t["role"] == "assistant"), -1)["text"]
    lent = rows.select(F.col("position").alias("lender"), F.col("conv_id").alias("lender_id"), F.when(F.exists("turns", lambda t: t["role"] == "assistant"), reply).alias("reply"))
    own = F.transform("chosen_turns", lambda t, i: F.when(t["role"] == "assistant", i + 1).otherwise(0))
    last = F.array_max(own)
    borrowed = F.concat(F.slice("chosen_turns", F.lit(1), F.greatest(last - 1, F.lit(0))), F.array(F.struct(F.lit("assistant").alias("role"), F.col("reply").alias("text"))))
    able = F.col("reply").isNotNull() & (last > 0) & (F.col("lender_id") != F.col("chosen_id"))
    return two.join(lent, "lender", "left").select(
        "pair_id",
        "chosen_id",
        "chosen_turns",
        F.coalesce("mate_id", F.when(able, F.col("lender_id"))).alias("rejected_id"),
        F.coalesce("mate_turns", F.when(able, borrowed)).alias("rejected_turns"),
    )

"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared in lower case with runs of white space as one blank.  An item of m
characters occurs in a document where some substring has an edit distance of at most
k = min(m * ratio, (m - q) / q) to it.  Such an occurrence keeps at least m + 1 - q - k * q of
the item's q-grams, on k + 1 neighbouring diagonals (place in text less place in item).  Shared
q-grams are counted in bands of 2 (k + 1) diagonals that overlap by half, so one band holds them all; bands
that meet the bound are verified.  The benchmark is the stated query set: it goes out in
blocks of bounded size, and every block is a map over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import blocks

Q = 8  # the hash is made by doubling: a power of two
_MULT = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
_CHUNK = 1 << 15
_CELLS, _FAR = 1 << 15, 1 << 29  # lanes aligned together; a cost beyond all
_POSTINGS = 1 << 21  # postings looked at together, if they are of several items

#: Characters of a benchmark block that goes out at once (its index takes about 40 bytes for each).
BLOCK = 1_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``Q`` code points."""
    h, step = codes.astype(np.uint64), 1
    for mult in _MULT:
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        h = h[:-step] * mult + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Index:
    """Items of one block and their q-grams."""

    ids: list
    texts: list[str]
    budgets: np.ndarray
    keys: np.ndarray
    item: np.ndarray  # of each posting, by key and item
    place: np.ndarray
    order: np.ndarray  # of each posting its key's number times the number of items, and its item: ascending
    least: np.ndarray  # shared q-grams that an occurrence of the item has at least
    seen: np.ndarray  # a table of hash bits, to pass over most grams cheaply

    @classmethod
    def of(cls, items: list[tuple], ratio: float) -> Index:
        ids, texts = [i for i, _ in items], [t for _, t in items]
        budgets = np.array([max(0, min(int(len(t) * ratio), (len(t) - Q) // Q)) for t in texts], np.int64)
        grams = [gram_hashes(codes_of(t)) for t in texts]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        keys, first = np.unique(h[order], return_index=True)
        bits = max(16, int(16 * max(1, len(keys)) - 1).bit_length())
        seen = np.zeros(1 << bits, np.bool_)
        seen[(keys & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        number = np.repeat(np.arange(len(keys)), np.diff(np.r_[first, len(h)])) * len(texts) + item[order]
        least = np.maximum(1, np.array([len(t) for t in texts], np.int64) + 1 - Q - budgets * Q)
        return cls(ids, texts, budgets, keys, item[order], place[order], number, least, seen)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key's number, place in the text) of every q-gram of the text that an item has too."""
        mask = np.uint64(len(self.seen) - 1)
        keys, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(codes), _CHUNK):
            h = gram_hashes(codes[at : at + _CHUNK + Q - 1])
            maybe = np.flatnonzero(self.seen[(h & mask).astype(np.int64)])
            if not len(maybe):
                continue
            key = np.searchsorted(self.keys, h[maybe])
            same = self.keys[np.minimum(key, len(self.keys) - 1)] == h[maybe]
            keys.append(key[same])
            places.append(maybe[same] + at)
        return np.concatenate(keys), np.concatenate(places)

    def bands(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, band) pairs that share enough q-grams with the text.  A band of number b has the diagonals from b (k + 1) to (b + 2) (k + 1) - 1.

        Postings are looked at for a range of items at a time, so that a phrase that many items and many places
        share does not have them all in memory at once.
        """
        key, place = self.hits(codes)
        ranges = [(0, len(self.texts))] if len(key) else []
        while ranges:
            low, high = ranges.pop()
            first = np.searchsorted(self.order, key * len(self.texts) + low)
            n = np.searchsorted(self.order, key * len(self.texts) + high) - first
            total = int(n.sum())
            if total > _POSTINGS and high - low > 1:
                ranges += [(low, (low + high) // 2), ((low + high) // 2, high)]
            elif total:
                post = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(total)
                item = self.item[post]
                band = (np.repeat(place, n) - self.place[post]) // (self.budgets[item] + 1)
                low_band = int(band.min()) - 1
                span = int(band.max()) - low_band + 1
                own, counts = np.unique(np.concatenate([item * span + band - low_band, item * span + band - 1 - low_band]), return_counts=True)
                items = own // span
                enough = counts >= self.least[items]
                yield items[enough], own[enough] % span + low_band


@dataclass
class Candidate:
    """An item against the diagonals [low, high] of a text, widened by its budget on both sides."""

    item: str
    text: str
    low: int
    high: int
    budget: int

    @property
    def width(self) -> int:
        return self.high - self.low + 1 + 2 * self.budget


def banded_distances(cases: list[Candidate]) -> list[tuple[int, int, int] | None]:
    """For each case (edits, start, end) of its item's best occurrence that starts on a diagonal in [low, high]
    and strays at most ``budget`` diagonals from it; None beyond the budget.

    Cases of similar length are aligned together, row by row, one line of lanes for each.
    """
    out: list[tuple[int, int, int] | None] = [None] * len(cases)
    order = sorted(range(len(cases)), key=lambda c: (cases[c].width, len(cases[c].item)))
    while order:
        n = max(1, min(len(order), _CELLS // cases[order[-1]].width))
        _align(cases, order[-n:], out)
        del order[-n:]
    return out


def _align(cases: list[Candidate], own: list[int], out: list) -> None:
    held = [cases[c] for c in own]
    rows, width = max(len(x.item) for x in held), max(x.width for x in held)
    lanes = np.arange(width, dtype=np.int32)
    wide = np.array([x.width for x in held], np.int32)[:, None]
    low = np.array([x.low - x.budget for x in held], np.int64)[:, None]
    size = np.array([len(x.text) for x in held], np.int64)[:, None]
    budget = np.array([x.budget for x in held], np.int32)
    length = np.array([len(x.item) for x in held], np.int64)
    items = np.zeros((len(held), rows), np.uint32)
    texts = np.full((len(held), rows + width), 0xFFFFFFFF, np.uint32)  # texts[c, j] is place low + j
    for c, x in enumerate(held):
        items[c, : len(x.item)] = codes_of(x.item)
        first = x.low - x.budget
        part = codes_of(x.text[max(0, first) : max(0, first + rows + width)])
        texts[c, max(0, -first) : max(0, -first) + len(part)] = part
    at = low + lanes  # text places before which a row's cells stand
    # A row's cell lies in the text while after <= row <= until.
    after, until = (-at).astype(np.int32), np.where(lanes < wide, size - at, -1).astype(np.int32)
    cost = np.where((after <= 0) & (until >= 0), 0, _FAR).astype(np.int32)
    start = at.copy()
    number = np.array(own)
    for i in range(rows):
        step = cost + (texts[:, i : i + width] != items[:, i : i + 1])
        step[until <= i] = _FAR
        gap = np.full_like(cost, _FAR)  # the item's character is missing in the text
        gap[:, :-1] = cost[:, 1:] + 1
        later = np.zeros_like(start)
        later[:, :-1] = start[:, 1:]
        origin = np.where(step <= gap, start, later)
        step = np.minimum(step, gap) - lanes
        run = np.minimum.accumulate(step, axis=1)  # characters that only the text has
        source = np.maximum.accumulate(np.where(step == run, lanes, 0), axis=1)
        cost, start = run + lanes, np.take_along_axis(origin, source, 1)
        cost[(after > i + 1) | (until < i + 1)] = _FAR
        least = cost.min(axis=1)
        done = length == i + 1
        for c in np.flatnonzero(done & (least <= budget)).tolist():
            best = int(np.argmin(cost[c]))
            out[number[c]] = (int(least[c]), int(start[c, best]), int(at[c, best] + length[c]))
        on = ~done & (least <= budget)
        if not on.any():
            return
        if not on.all():
            length = np.where(on, length, 0)
            if 8 * on.sum() <= 7 * len(on):
                cost, start, at, texts, items, after, until = (x[on] for x in (cost, start, at, texts, items, after, until))
                length, budget, number = length[on], budget[on], number[on]


def banded_distance(item: str, text: str, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """``banded_distances`` of one case."""
    return banded_distances([Candidate(item, text, low, high, budget)])[0]


def occurrences(texts: list[str], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text's number, item's number, edits, start, end), the best of each pair, of normalised texts."""
    for i, t in enumerate(index.texts):  # too short for a q-gram: the document must be the item
        if 0 < len(t) < Q:
            yield from ((k, i, 0, 0, len(t)) for k, x in enumerate(texts) if x == t)
    joined = "\n".join(texts)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    open_: list[tuple[int, int, Candidate]] = []
    for i, band_ in (pair for items, bands in index.bands(codes_of(joined)) for pair in zip(items.tolist(), bands.tolist())):
        k, own = int(index.budgets[i]), index.texts[i]
        low, high = band_ * (k + 1), (band_ + 2) * (k + 1) - 1
        first = max(0, int(np.searchsorted(starts, max(0, low - k), "right")) - 1)
        for d in range(first, len(texts)):
            if starts[d] > high + k + len(own):
                break
            if (d, i) in best:
                continue
            case = Candidate(own, texts[d], low - int(starts[d]), high - int(starts[d]), k)
            until = case.high + k + len(own)
            exact = texts[d].find(own, max(0, case.low - k), until) if until > 0 else -1
            if exact >= 0:
                best[d, i] = (0, exact, exact + len(own))
            else:
                open_.append((d, i, case))
    open_ = [x for x in open_ if x[:2] not in best]
    for (d, i, _), found in zip(open_, banded_distances([case for _, _, case in open_])):
        if found and found < best.get((d, i), (1 << 30,)):
            best[d, i] = found
    for (d, i), (edits, start, end) in best.items():
        yield d, i, edits, start, end


def _indexes(benchmark: DataFrame, ratio: float) -> Iterator[Index]:
    """Indexes of blocks of the benchmark, each of about ``BLOCK`` characters."""
    own = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    total = own.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = -(-total // BLOCK)
    for k in range(n):
        part = own if n == 1 else own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        items = [(r["item_id"], normal(r["text"])) for r in part.orderBy("item_id", "text").collect()]
        yield Index.of([x for x in items if x[1]], ratio)


def find_leaks(docs: DataFrame, benchmark: DataFrame, ratio: float = 0.1) -> DataFrame:
    """doc_id, item_id, edits, start, end of each item that occurs in a row of ``docs``: the best occurrence.

    Places are code points of the normalised text.  Null and empty texts hold nothing; null and blank items occur
    nowhere; an item shorter than a q-gram occurs where it is the whole document.  Repeated
    rows and repeated items are each reported; other columns are not read; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start long, end long"
    out = spark.createDataFrame([], schema)
    for index in _indexes(benchmark, ratio):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for first, texts in blocks(batch, "text"):
                    rows = [(ids[first + d], held.value.ids[i], *rest) for d, i, *rest in occurrences([normal(t) for t in texts], held.value)]
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "item_id", "edits", "start", "end"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, ratio: float = 0.1) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with all their columns; null and empty texts stay, and without items all."""
    spark = docs.sparkSession
    for index in _indexes(benchmark, ratio):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, np.bool_)
                for first, texts in blocks(batch, "text"):
                    for d, *_ in occurrences([normal(t) for t in texts], held.value):
                        keep[first + d] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

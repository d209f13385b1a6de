"""Best-fit packing with swap-based local search, planned on lengths instead of documents.

Pieces of one length are alike, so the driver packs the histogram of lengths (at most
``capacity`` rows whatever the corpus): best fit by falling length makes kinds of bins
with a number of copies each; the local search then exchanges pieces between underfull kinds,
for all copies at once, until no exchange helps.  Every piece takes its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import positioned, slices, stage
from tidewake.llm.tokens import BLOCK, encoder

Kind = tuple[tuple[int, int], ...]  # (length, times), falling


def best_fit(histogram: dict[int, int], capacity: int) -> Counter[Kind]:
    """Copies of each kind of bin, by best fit of falling lengths."""
    room: dict[int, list[list]] = defaultdict(list)  # free place: [pieces, copies]
    mask = 0  # bit k: a bin has k places free
    done: Counter[Kind] = Counter()

    def put(kind: Kind, free: int, copies: int) -> None:
        nonlocal mask
        if not copies:
            return
        if free:
            room[free].append([kind, copies])
            mask |= 1 << free
        else:
            done[kind] += copies

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            fits = mask >> length
            if not fits:
                per = capacity // length
                put(((length, per),), capacity - per * length, left // per)
                if left % per:
                    put(((length, left % per),), capacity - left % per * length, 1)
                break
            free = length + (fits & -fits).bit_length() - 1
            kind, copies = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
            per = min(free // length, left)
            used = min(copies, left // per)
            put(kind, free, copies - used)
            put((*kind, (length, per)), free - per * length, used)
            left -= used * per
    for free, held in room.items():
        for kind, copies in held:
            done[kind] += copies
    return done


def fill(kind: Kind) -> int:
    return sum(a * n for a, n in kind)


def _changed(kind: Kind, out: tuple[int, ...], into: tuple[int, ...]) -> Kind:
    c = Counter(dict(kind))
    c.subtract(out)
    c.update(into)
    return tuple(sorted(((a, n) for a, n in c.items() if n), reverse=True))


def _ones(kind: Kind) -> list[tuple[int, ...]]:
    return [(a,) for a, _ in kind]


def _twos(kind: Kind) -> list[tuple[int, ...]]:
    return [(x, y) for i, (x, n) in enumerate(kind) for y, _ in kind[i if n > 1 else i + 1 :]]


def _sums(options: list[tuple[int, ...]]) -> np.ndarray:
    return np.unique(np.array([sum(o) for o in options], np.int64))


def _exchange(a: Kind, b: Kind, capacity: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """What to give from ``a`` to ``b`` and to take back, so that the squared fill grows most.

    The gain 2 d (d + fill(b) - fill(a)) grows with d, the places that b gains, so the largest d that fits is the best.
    """
    free, best, most = capacity - fill(b), None, max(0, fill(a) - fill(b))
    for gives, takes in ((_ones(a), [(), *_ones(b), *_twos(b)]), (_twos(a), _ones(b))):
        of = {sum(t): t for t in reversed(takes)}
        back = np.array(sorted(of), np.int64)
        for give in gives if len(back) else ():
            g = sum(give)
            at = int(np.searchsorted(back, g - free))
            if at < len(back) and g - back[at] > most:
                best, most = (give, of[int(back[at])]), int(g - back[at])
    return best


class _Underfull:
    """The underfull kinds, a row each, with tables by place that answer for many pairs at once whether an exchange helps.

    ``after12`` and ``after1`` have the least sum that is not below a place, of no, one or two pieces and of one;
    ``upto1`` and ``upto2`` the greatest that is not above it, of one piece and of two.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.none = capacity, 4 * capacity + 4
        self.row: dict[Kind, int] = {}
        self.kind: list[Kind | None] = []
        self.unused: list[int] = []
        self.fills = np.zeros(0, np.int64)
        self.live, self.stuck = np.zeros(0, bool), np.zeros(0, bool)
        self.tables = [np.zeros((0, capacity + 1), np.int16 if self.none < 1 << 15 else np.int64) for _ in range(4)]

    def add(self, kind: Kind) -> int:
        if not self.unused:
            n = max(64, len(self.kind) // 2)
            self.unused = list(range(len(self.kind) + n - 1, len(self.kind) - 1, -1))
            self.kind += [None] * n
            self.fills, self.live, self.stuck = (np.concatenate([x, np.zeros(n, x.dtype)]) for x in (self.fills, self.live, self.stuck))
            self.tables = [np.concatenate([x, np.zeros((n, x.shape[1]), x.dtype)]) for x in self.tables]
        r = self.row[kind] = self.unused.pop()
        self.kind[r], self.fills[r], self.live[r], self.stuck[r] = kind, fill(kind), True, False
        one, two = _sums(_ones(kind)), _sums(_twos(kind))
        for table, sums in zip(self.tables, (np.concatenate([[0], one, two]), one, one, two)):
            after = table is self.tables[0] or table is self.tables[1]
            own = np.full(self.capacity + 1, self.none if after else -self.none)
            own[sums] = sums
            table[r] = np.minimum.accumulate(own[::-1])[::-1] if after else np.maximum.accumulate(own)
        return r

    def remove(self, kind: Kind) -> None:
        r = self.row.pop(kind)
        self.live[r] = False
        self.kind[r] = None
        self.unused.append(r)

    def emptiest(self) -> int | None:
        """The row of the emptiest kind that is not stuck."""
        rows = np.flatnonzero(self.live & ~self.stuck)
        return int(rows[self.fills[rows].argmin()]) if len(rows) else None

    def taker(self, giver: int, itself: bool) -> int | None:
        """The fullest row that an exchange with the giver helps."""
        rows = np.flatnonzero(self.live)
        rows = rows[np.argsort(-self.fills[rows], kind="stable")]
        rows = rows if itself else rows[rows != giver]
        one, two = (_sums(f(self.kind[giver]))[:, None] for f in (_ones, _twos))
        for k in range(0, len(rows), 256):
            some = rows[k : k + 256]
            free, most = self.capacity - self.fills[some], np.maximum(0, self.fills[giver] - self.fills[some])
            helps = (one - self.tables[0][some, np.maximum(0, one - free)]).max(axis=0, initial=0) > most
            helps |= (two - self.tables[1][some, np.maximum(0, two - free)]).max(axis=0, initial=0) > most
            if helps.any():
                return int(some[helps.argmax()])
        return None

    def wake(self, taker: int) -> None:
        """Stuck rows that an exchange with this new taker helps are stuck no more."""
        every, free = np.flatnonzero(self.live & self.stuck), self.capacity - self.fills[taker]
        one, two = (_sums(f(self.kind[taker]))[:, None] for f in (_ones, _twos))
        takes = np.concatenate([[[0]], one, two])
        for k in range(0, len(every), 256):
            some = every[k : k + 256]
            most = np.maximum(0, self.fills[some] - self.fills[taker])
            helps = (self.tables[2][some, np.minimum(self.capacity, takes + free)] - takes).max(axis=0, initial=0) > most
            helps |= (self.tables[3][some, np.minimum(self.capacity, one + free)] - one).max(axis=0, initial=0) > most
            self.stuck[some[helps]] = False


def local_search(bins: Counter[Kind], capacity: int) -> Counter[Kind]:
    """Exchange pieces between underfull bins while the squared fill grows; empty bins vanish.

    The emptiest kind gives to the others, fullest first: one piece for none, one or two, or two for one.  It ends when
    the number of bins is the least possible or no exchange helps; each exchange adds to the squared fill, so it does end.
    """
    bins = Counter(bins)
    total, least = sum(bins.values()), -(-sum(fill(k) * n for k, n in bins.items()) // capacity)
    if total <= least:
        return bins
    under = _Underfull(capacity)
    for kind in sorted(k for k in bins if fill(k) < capacity):
        under.add(kind)
    while total > least:
        a = under.emptiest()
        if a is None:
            break
        giver = under.kind[a]
        b = under.taker(a, bins[giver] > 1)
        if b is None:
            under.stuck[a] = True
            continue
        taker = under.kind[b]
        give, take = _exchange(giver, taker, capacity)
        n = bins[giver] // 2 if a == b else min(bins[giver], bins[taker])
        before = {}
        for kind, by in ((giver, -n), (taker, -n), (_changed(giver, give, take), n), (_changed(taker, take, give), n)):
            if kind:
                before.setdefault(kind, bins[kind])
                bins[kind] += by
            else:
                total -= n
        for kind, had in before.items():
            if not bins[kind]:
                del bins[kind]
                if kind in under.row:
                    under.remove(kind)
        for kind, had in before.items():
            if kind in under.row and had < bins[kind]:
                under.stuck[under.row[kind]] = False  # it may now exchange with a copy of itself
            elif kind in bins and kind not in under.row and fill(kind) < capacity:
                under.wake(under.add(kind))
    return bins


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, copies * times, times, first sequence, offset), by length and rank."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    bins = local_search(best_fit(histogram, capacity), capacity)
    for kind in sorted(bins, key=lambda k: (-fill(k), k)):
        offset = 0
        for length, times in kind:
            rows.append((length, used[length], bins[kind] * times, times, sequence, offset))
            used[length] += bins[kind] * times
            offset += length * times
        sequence += bins[kind]
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents over ``capacity`` ids are cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, words=True)
        for batch in batches:
            doc_ids, own = batch.column("doc_id").cast(pa.int64()), batch.column("text")
            for first, rows in slices([own], BLOCK):
                ids, counts = enc.encode(own.slice(first, rows))
                ids, sizes = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                each = -(-sizes // capacity)  # pieces of each document
                doc = np.repeat(np.arange(rows), each)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                ends = np.cumsum(length)
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())]
                cols = [doc_ids.slice(first, rows).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64)))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Places of all pieces of ``docs`` (doc_id, text, ...): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and still has its end id.  Repeated rows are packed each; other columns
    are not read; an empty table gives no rows.  Only the five numbers of a piece are shuffled.
    """
    cut, _ = stage(pieces(docs, tokenizer, capacity, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = plan(histogram, capacity)
    before, base = {}, 0
    for length in sorted(histogram):
        before[length] = base
        base += histogram[length]
    starts = np.zeros(capacity + 1, np.int64)
    starts[list(before)] = list(before.values())
    key = placed[:, 0] * (1 << 44) + placed[:, 1]
    laid, _ = positioned(cut, ["length", "doc_id", "piece", "ids_crc32", "start"], "packing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("position").to_numpy() - starts[length]
            row = placed[np.searchsorted(key, length * (1 << 44) + rank, "right") - 1]
            j = rank - row[:, 1]
            own = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(row[:, 4] + j // row[:, 3]), pa.array(row[:, 5] + j % row[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return laid.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids, offsets; a group has ``capacity`` ids at most."""
    key = ["doc_id", "piece", "ids_crc32"]
    placed = pack(docs, tokenizer, capacity, end_id)
    ids = pieces(docs, tokenizer, capacity, end_id, with_ids=True).select(*key, "ids").dropDuplicates(key)
    joined = placed.alias("p").join(ids.alias("i"), F.expr("p.doc_id <=> i.doc_id AND p.piece = i.piece AND p.ids_crc32 = i.ids_crc32"))
    rows = joined.groupBy("p.sequence_id").agg(F.sort_array(F.collect_list(F.struct("p.offset", "p.doc_id", "i.ids"))).alias("m"))
    return rows.select("sequence_id", F.flatten("m.ids").alias("ids"), F.col("m.doc_id").alias("doc_ids"), F.col("m.offset").alias("offsets"))

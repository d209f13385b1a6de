"""Token counts by rank-synchronous merging of ragged numpy arrays.

All pre-tokens of a block that the worker has not met are held in one flat array of symbols
with the number of their sequence.  In each round every sequence's lowest-ranked adjacent
pair is merged, in all sequences at once, until none is left; the symbols that survive are
counted.  A long sequence has as many rounds as it has different pairs, so there a round looks only at the pairs
of the lowest rank and their neighbours.  No tokenizer library is used for the merging.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidewake.llm.common import slices
from tidewake.llm.tokens import BLOCK, BYTE_LEVEL, MARKS, Pieces, byte_letters, is_odd, model_of, odd_pieces, sorted_out, stretches

_NONE = np.int64(1 << 40)
#: Bytes of words that are merged together, and of a word that is merged by itself.
TOGETHER, LONG = 1 << 18, 256


class PairRanks:
    """Rank and product of a pair of symbols, for arrays of pairs."""

    def __init__(self, name: str) -> None:
        model = model_of(name)["model"]
        vocab = model["vocab"]
        self.size = np.int64(max(vocab.values()) + 1)
        self.of_byte = np.array([vocab[c] for c in byte_letters()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], _NONE)


def _every_other(at: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of runs of places, each the one that ``follows`` the place before it, the first, third, ...: pairs that overlap (x x x) are merged so."""
    i, linked = np.arange(len(at)), np.zeros(len(at), np.bool_)
    linked[1:] = follows[:-1] == at[1:]
    run = np.maximum.accumulate(np.where(linked, 0, i))
    return at[(i - run) % 2 == 0]


def merged_counts(words: list[str], pairs: PairRanks) -> np.ndarray:
    """Symbols left of each word after all merges; an empty word has none."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    n = np.array([len(x) for x in raw], np.int64)
    out = np.zeros(len(raw), np.int64)
    short = np.flatnonzero(n <= LONG)
    for i in np.flatnonzero(n > LONG).tolist():
        out[i] = long_count(pairs.of_byte[np.frombuffer(raw[i], np.uint8)], pairs)
    ends = np.cumsum(n[short])
    first = 0
    while first < len(short):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, "right")))
        own = short[first:last]
        out[own] = _together([raw[i] for i in own.tolist()], pairs)
        first = last
    return out


def _together(raw: list[bytes], pairs: PairRanks) -> np.ndarray:
    out = np.array([len(x) for x in raw], np.int64)
    symbols = pairs.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
    seq = np.repeat(np.arange(len(raw)), out)
    while len(symbols):
        rank = np.full(len(symbols), _NONE)
        same = np.flatnonzero(seq[:-1] == seq[1:])
        rank[same] = pairs.ranks(symbols[same], symbols[same + 1])
        starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        lengths = np.diff(np.r_[starts, len(symbols)])
        low = np.minimum.reduceat(rank, starts)
        out[seq[starts]] = lengths
        at = np.flatnonzero((rank == np.repeat(low, lengths)) & (rank < _NONE))
        at = _every_other(at, at + 1)
        symbols[at] = pairs.made[rank[at]]
        keep = np.repeat(low < _NONE, lengths)  # finished sequences leave
        keep[at + 1] = False
        symbols, seq = symbols[keep], seq[keep]
    return out


def long_count(symbols: np.ndarray, pairs: PairRanks) -> int:
    """Symbols left of one long sequence: each round merges the pairs of the lowest rank and ranks their neighbours anew."""
    n = len(symbols)
    symbols, after, before = symbols.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, _NONE)  # of the pair that begins at a place; a place that was merged away has none
    waiting: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def found(places: np.ndarray) -> None:
        some = places[rank[places] < _NONE]
        some = some[np.argsort(rank[some], kind="stable")]
        own, first = np.unique(rank[some], return_index=True)
        for r, group in zip(own.tolist(), np.split(some, first[1:])):
            if r not in waiting:
                waiting[r] = []
                heappush(order, r)
            waiting[r].append(group)

    if n > 1:
        rank[:-1] = pairs.ranks(symbols[:-1], symbols[1:])
        found(np.arange(n - 1))
    heapify(order)
    left = n
    while order:
        r = heappop(order)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[rank[at] == r]
        if not len(at):
            continue
        at = _every_other(at, after[at])
        gone = after[at]
        symbols[at], rank[gone], left = pairs.made[r], _NONE, left - len(at)
        after[at] = after[gone]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        changed = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
        rank[changed] = _NONE
        paired = changed[after[changed] < n]
        rank[paired] = pairs.ranks(symbols[paired], symbols[after[paired]])
        found(paired)
    return left


class Counter:
    """Counts of tokens, each distinct piece once per worker."""

    def __init__(self, name: str, cache: int = 400_000) -> None:
        self.pairs, self.cache = PairRanks(name), cache
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = [t["content"] for t in model_of(name)["added_tokens"]]
        self.split = regex.compile("|".join(map(regex.escape, self.special)))
        self.known: dict = {}

    def _counted(self, pieces: list) -> np.ndarray:
        """Tokens of each of the pieces, which are learned where they are new."""
        if len(self.known) > self.cache:
            self.known.clear()
        self._learn([p for p in pieces if p not in self.known])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _plain(self, texts: pa.Array, begins: np.ndarray | None = None) -> np.ndarray:
        own = Pieces.of(texts, BYTE_LEVEL, begins)
        return own.sums(self._counted(own.distinct))

    def _other(self, text: str) -> int:
        parts = self.split.split(text)
        total = len(parts) - 1
        for part in parts:
            for stretch, begins in stretches(part):
                if is_odd(stretch):
                    pieces = list(odd_pieces(stretch if begins else " " + stretch))
                    total += int(self._counted(pieces).sum())
                else:
                    total += int(self._plain(pa.array([stretch], pa.string()), np.array([begins]))[0])
        return total

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a null text is empty."""
        texts, plain = sorted_out(texts, BYTE_LEVEL, self.special)
        out = np.zeros(len(texts), np.int64)
        out[plain] = self._plain(texts.filter(pa.array(plain)))
        out[~plain] = [self._other(t) for t in texts.filter(pa.array(~plain)).to_pylist()]
        return out

    def _words(self, piece: str | tuple[str]) -> list[str]:
        """The pre-tokens of a piece."""
        if type(piece) is str and piece:
            if BYTE_LEVEL.plain(piece) and piece[0] != "\n":
                return [" " + piece]
            if piece[-1] in MARKS and len(piece) > 1 and piece[0] != "\n" and BYTE_LEVEL.plain(piece[:-1]):
                return [" " + piece[:-1], piece[-1]]
        return self.pattern.findall(BYTE_LEVEL.text(piece))

    def _learn(self, pieces: list) -> None:
        words = list(map(self._words, pieces))
        distinct = list(set().union(*words))
        n = dict(zip(distinct, merged_counts(distinct, self.pairs).tolist()))
        for piece, own in zip(pieces, words):
            self.known[piece] = sum(map(n.__getitem__, own))


@functools.lru_cache(maxsize=2)
def counter(name: str) -> Counter:
    """This worker's counter: what it has learned serves its later tasks too."""
    return Counter(name)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text, ...).

    Null texts are empty: no bytes, no tokens.  Repeated rows give repeated rows; other
    columns are not read.  A map over the rows: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            ids, texts = batch.column("doc_id").cast(pa.int64()), batch.column("text")
            for first, rows in slices([texts], BLOCK):
                some = texts.slice(first, rows)
                n = own.counts(some)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, rows), pc.fill_null(pc.binary_length(some), 0).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

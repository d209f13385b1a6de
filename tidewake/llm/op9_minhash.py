"""Near-duplicates by BagMinHash signatures, banding and verified multiset overlap.

Documents are multisets of five-word shingles (lower case, split at white space); two are linked
when their weighted Jaccard similarity is 0.8 or more, and classes are the connected components.

Signature.  Each shingle has a Poisson process of points in time for each dyadic interval
[0,1), [1,2), [2,4), ... of its discretised weight; a point has a place in the interval (so a
count that covers part of it takes part of its points) and a register.  A register keeps the document's
earliest point.  Two documents agree in a register with the probability of their weighted Jaccard similarity.

Classes.  Texts with equal words are one node.  Nodes that share a band are in one bucket.  First all
members of a bucket are compared with one of them, and components are formed.  Then the members outside a bucket's
main component are compared with all of the bucket, in blocks: any two components of a bucket meet in
such a pair, so no link inside a bucket is lost, and copies that are linked already are not compared with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import blocks, drop_path, slices, spread_join, stage
from tidewake.llm.tokens import forget

WIDTH, SIMILAR = 5, 0.8
#: Four registers in twenty bands: a pair at similarity 0.8 misses all bands with probability 3e-5.
BANDS, ROWS = 20, 4
#: Texts on either side of a block that is compared in one task.
BLOCK = 64
_WORDS_HELD = 200_000

_A, _B, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > _WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def key_of(words: list[str]) -> bytes:
    """128 bits of the words in order: the node of a text."""
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def shingles(words: list[str], held: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts; a text of fewer words is one shingle."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
    n = min(WIDTH, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        s = _mix(s * _G + h[k : len(h) - n + 1 + k])
    return np.unique(s, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """For each bag its registers' earliest points, as 64-bit names; an empty bag's are 0."""
    n = len(bags)
    times = np.full(n * registers, np.inf)
    names = np.zeros(n * registers, np.uint64)
    doc = np.repeat(np.arange(n), [len(h) for h, _ in bags])
    if not len(doc):
        return names.reshape(n, registers)
    hashes, counts = np.concatenate([h for h, _ in bags]), np.concatenate([c for _, c in bags])
    parts = []
    low, level = 0, 0
    while True:
        here = np.flatnonzero(counts > low)
        if not len(here):
            break
        rate = max(1, low)
        parts.append((doc[here], _mix(hashes[here] + np.uint64(int(_G) * (level + 1) & 0xFFFFFFFFFFFFFFFF)), np.full(len(here), float(rate)), counts[here] - low))
        low, level = low + rate, level + 1
    doc, state, rate, covered = (np.concatenate(x) for x in zip(*parts))
    time = np.zeros(len(doc))
    while len(doc):
        state = state + _G
        point = _mix(state)
        time = time - np.log(((point >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        second = _mix(point ^ _A)
        place = (second >> np.uint64(40)).astype(np.float64) * 2.0**-24 * rate
        at = doc * registers + ((second & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
        taken = np.flatnonzero(place < covered)
        np.minimum.at(times, at[taken], time[taken])
        won = taken[times[at[taken]] == time[taken]]
        names[at[won]] = point[won]
        latest = times.reshape(n, registers).max(axis=1)
        on = np.flatnonzero(time < latest[doc])
        doc, state, rate, covered, time = doc[on], state[on], rate[on], covered[on], time[on]
    return names.reshape(n, registers)


def bands_of(names: np.ndarray) -> np.ndarray:
    """One 64-bit value for each band."""
    b = names.reshape(len(names), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _G, b.shape[:2]).copy()
    for k in range(ROWS):
        out = _mix(out * _G + b[:, :, k])
    return out.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sizes of the multisets' intersection and union."""
    at = np.searchsorted(b[0], a[0])
    at_ = np.minimum(at, len(b[0]) - 1) if len(b[0]) else at
    same = (b[0][at_] == a[0]) if len(b[0]) else np.zeros(len(a[0]), bool)
    inter = int(np.minimum(a[1][same], b[1][at_[same]]).sum())
    return inter, int(a[1].sum() + b[1].sum()) - inter


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    inter, union = overlap(a, b)
    return inter >= SIMILAR * union - 1e-9


def _id() -> Column:
    return F.col("doc_id").cast("long").alias("doc_id")


def _print() -> Column:
    """128 bits of the text itself, which tell rows of one doc_id apart without their texts."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("print")


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = Words()
        for batch in batches:
            for first, texts in blocks(batch, "text", 500_000):
                own = [words_of(t) for t in texts]
                bands = bands_of(signatures([shingles(w, held) for w in own]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(texts)) for c in ("doc_id", "print")), pa.array([key_of(w) for w in own], pa.binary()), pa.array([b if w else [] for b, w in zip(bands, own)], pa.list_(pa.int64()))],
                    names=["doc_id", "print", "key", "bands"],
                )

    return docs.select(_id(), "text", _print()).mapInArrow(run, "doc_id long, print binary, key binary, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """The pairs (a, b) of keys, at most ``total``, whose texts are similar.

    A pair's second key may be that of very many pairs: their texts are dealt over several tasks, and the one text goes to each.
    """
    rows = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("tb")).join(pairs.groupBy("b").agg(F.count("*").alias("n")), "b")
    held = spread_join(rows, second, "b", F.xxhash64("a"), total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words, before, bag = Words(), None, None
        for batch in batches:
            keep, ta, tb = [], batch.column("ta"), batch.column("tb")
            for first, n in slices([ta, tb]):
                for a, b in zip(ta.slice(first, n).to_pylist(), tb.slice(first, n).to_pylist()):
                    if b != before:
                        before, bag = b, shingles(words_of(b), words)
                    keep.append(similar(shingles(words_of(a), words), bag))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return held.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """key, root (the least key of its component) for every end of the links (a, b).

    Alternating large and small stars; the table of each round lies in the shared folder until the next
    is there.  A node with many links is only ever aggregated or joined from its links' side.
    """
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges, path = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), name)
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = spread_join(both.filter("v > u"), low, "u", F.xxhash64("u", "v"), 2 * before[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, least, "u", F.xxhash64("u", "v"), 2 * before[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges, new = stage(small, name)
        drop_path(links.sparkSession, path)
        path = new
        now = mark(edges)
        if now == before:
            break
        before = now
    out, _ = stage(edges.select(F.col("u").alias("key"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("key"), F.col("v").alias("root"))).distinct(), f"{name}-roots")
    drop_path(links.sparkSession, path)
    return out


def _links_to_outliers(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between members of different components of one bucket.

    ``open_`` has band, key, root, bands, n (members) and others (members outside the bucket's main component), and
    ``out`` for these.  Every pair of components meets in a pair with an outlier, so outliers are the query set, compared with all
    members in blocks of about ``BLOCK`` by ``BLOCK`` texts; a pair is compared in the first band that it shares.
    """
    spread = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    rows = open_.join(texts, "key").withColumn("parts", spread("n"))
    members = rows.withColumn("m", own).withColumn("o", F.explode(F.sequence(F.lit(0), spread("others") - 1))).withColumn("role", F.lit(0))
    out = rows.filter("out").withColumn("m", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("o", F.pmod(F.xxhash64("key"), spread("others")).cast("int")).withColumn("role", F.lit(1))
    columns = ["band", "m", "o", "role", "key", "root", "out", "bands", "text"]

    def compare(group: pa.Table) -> pa.Table:
        forget()
        held, found = Words(), []
        band = group.column("band")[0].as_py()
        sides = [[], []]
        for role, key, root, is_out, bands, text in zip(*(group.column(c) for c in ("role", "key", "root", "out", "bands", "text"))):
            bag = shingles(words_of(text.as_py()), held)
            sides[role.as_py()].append((key.as_py(), root.as_py(), is_out.as_py(), np.asarray(bands.as_py(), np.int64), bag, int(bag[1].sum())))
        if sides[0] and sides[1]:
            bands = np.array([x[3] for x in sides[0]])
            sizes = np.array([x[5] for x in sides[0]])
            at = int(np.flatnonzero(sides[1][0][3] == band)[0])
            for key, root, _, own_bands, bag, size in sides[1]:
                same = bands == own_bands
                fits = (same.argmax(axis=1) == at) & (np.minimum(sizes, size) >= SIMILAR * np.maximum(sizes, size) - 1e-9)
                for k in np.flatnonzero(fits):
                    other = sides[0][k]
                    if other[1] != root and not (other[2] and other[0] < key) and similar(other[4], bag):
                        found.append((max(key, other[0]), min(key, other[0])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    both = members.select(*columns).unionByName(out.select(*columns))
    return both.groupBy("band", "m", "o").applyInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the class's least doc_id) of every row of ``docs`` (doc_id, text, ...).

    Null and blank texts have no words and are copies of each other; texts of fewer than five words are similar
    only if their words are equal.  Rows without a doc_id get their class's id and never give it, unless
    all have none (class_id null).  Repeated rows are kept; other columns are not read; an empty table gives no rows.
    """
    return _classes(*_linked(docs))


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches (doc_id, print, key, bands), nodes (key, its first row as none, doc_id and print, n rows), and roots (key, root) of
    the nodes that have a link."""
    deal = F.xxhash64("key")
    sketch, _ = stage(_sketched(docs), "sketches")
    nodes = sketch.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("first"), F.count("*").alias("n"))
    firsts = sketch.groupBy("key").agg(F.first("bands").alias("bands"))
    rows = firsts.select("key", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("pivot")).filter("n > 1")
    buckets, buckets_at = stage(spread_join(rows, shared, "band", deal, BANDS * sketch.count()), "buckets")  # only bands that two texts share
    held = buckets.count()
    # Only texts in a bucket are fetched, once: the text of each node's first row.
    wanted = buckets.select("key").distinct().join(nodes, "key").select("key", "first.doc_id", "first.print")
    texts, texts_at = stage(_texts(docs, wanted), "bucket-texts")
    # Round 1: all members of a bucket against one of them.
    stars = buckets.filter("key != pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    links, links_at = stage(_verified(stars, texts, held), "star-links")
    roots = components(links, "star-components")
    # Round 2: buckets that still hold several components; the main one is that of most members.
    known = buckets.select("band", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    parts = known.groupBy("band", "root").agg(F.count("*").alias("c"))
    tops = parts.groupBy("band").agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("top")).filter("top.c < n")
    tops = tops.select("band", "n", F.col("n").alias("members"), F.col("top.root").alias("top"), (F.col("n") - F.col("top.c")).alias("others"))
    left = spread_join(known, tops, "band", deal, held).withColumn("out", F.col("root") != F.col("top")).join(firsts, "key")
    left, left_at = stage(left.select("band", "key", "root", F.col("members").alias("n"), "others", "out", "bands"), "open-buckets")
    more, more_at = stage(_links_to_outliers(left, texts).distinct(), "outlier-links")
    if not more.isEmpty():
        # The components found so far are one node each, so this graph is small.
        total = more.count()
        joined = _at_roots(_at_roots(more, "a", roots, total), "b", roots, total)
        merged = components(joined.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "merged-components")
        every, every_at = stage(roots.unionByName(merged.select("key", F.col("key").alias("root"))).distinct(), "all-roots")
        sizes = every.groupBy("root").agg(F.count("*").alias("n"))
        new = merged.select(F.col("key").alias("root"), F.col("root").alias("_r")).join(sizes, "root")
        roots, _ = stage(spread_join(every, new, "root", deal, every.count(), "left").select("key", F.coalesce("_r", "root").alias("root")).distinct(), "roots")
        drop_path(docs.sparkSession, every_at)
    for path in (buckets_at, texts_at, links_at, left_at, more_at):
        drop_path(docs.sparkSession, path)
    return sketch, nodes, roots


def _at_roots(links: DataFrame, end: str, roots: DataFrame, total: int) -> DataFrame:
    """``links`` (a, b) with root_a or root_b, the root of that end: itself where it has none.  An end may have very many links."""
    ends = links.groupBy(end).agg(F.count("*").alias("n"))
    known = ends.join(roots.select(F.col("key").alias(end), "root"), end, "left").select(end, "n", F.coalesce("root", end).alias(f"root_{end}"))
    return spread_join(links, known, end, F.xxhash64("a", "b"), total)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, text of the wanted rows (key, doc_id, print)."""
    own = docs.select(_id(), "text", _print()).alias("d")
    found = own.join(wanted.alias("w"), F.expr("d.doc_id <=> w.doc_id AND d.print = w.print"))
    return found.groupBy("key").agg(F.min("text").alias("text"))


def _classes(sketch: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    joined = nodes.select("key", F.col("first.doc_id").alias("least_id"), F.col("n").alias("rows")).join(roots, "key")
    least = joined.groupBy("root").agg(F.min("least_id").alias("class_id"), F.count("*").alias("n"))
    linked, _ = stage(spread_join(joined, least, "root", F.xxhash64("key"), roots.count()).select("key", "class_id"), "classes")
    each = nodes.join(linked, "key", "left").select("key", "n", F.coalesce("class_id", "first.doc_id").alias("class_id"))
    # Copies of one text may be many rows; the sketches are read from a table, where a row has the same number every time.
    return spread_join(sketch.select("doc_id", "key"), each, "key", F.monotonically_increasing_id(), sketch.count()).select("doc_id", "class_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, with its own columns, whatever the ids.

    It is a row of the class's least doc_id (a null is the last; tie: the least key, then the least digest of the text), so rows of
    different classes that share an id, or have none, all stay.  Of rows that share id and text (null as empty) one is kept.
    """
    sketch, nodes, roots = _linked(docs)
    linked = nodes.join(roots, "key")
    chosen = linked.groupBy("root").agg(F.min(F.struct("first.none", "first.doc_id", "key")).alias("m"))
    others = linked.join(chosen, "root").filter("key != m.key").select("key")
    kept, _ = stage(nodes.join(others, "key", "left_anti").select(F.coalesce("first.doc_id", F.lit(0)).alias("_id"), F.col("first.none").alias("_none"), F.col("first.print").alias("_print")), "representatives")
    same = ["_id", "_none", "_print"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.coalesce(_id(), F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), _print().alias("_print"), row.alias("_row"))
    if not sketch.groupBy("doc_id", "print").count().filter("count > 1").isEmpty():  # in each task first, as equal rows may be many
        rows = rows.groupBy(*same).agg(F.first("_row").alias("_row"))
    return rows.join(kept, same, "left_semi").select("_row.*")

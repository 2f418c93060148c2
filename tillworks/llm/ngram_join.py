"""Jaccard join of documents on word n-grams, with signature trees.

A document is its set of 64-bit hashes of n-word shingles; documents with equal
sets form one class, joined through one member.  Two classes can only reach the
threshold if they share a shingle among the first ones of either in a common
order, so each such shingle is a block.  The order puts shingles last that a
sketch of ``SKETCH`` counters over all documents shows to be frequent: passages
that many documents share then form no blocks.

Every block of several components is a signature tree: nodes hold the OR of
their members' bitmaps, the range of their sizes and of their components (trees
of a single leaf, which most blocks are, are compared many at a time).  A
dual traversal drops pairs of nodes whose sizes differ too much, whose largest
possible overlap is too small, or which lie within one component; pairs of
leaves that remain are compared by their members' bitmaps.  In the first
``FORESTS`` rounds a tree gives only a spanning forest of the pairs that remain,
the likeliest first, and what an exact intersection confirms becomes one
component.  Blocks that held pairs back and still hold several components come
again, in the last round with all their pairs.  No link between different
components is lost, and groups of thousands of near copies need no pair for
each two of them.

Cases: null or empty texts and texts without words have the empty set, size 0,
and are components of their own; texts with fewer than n words are one
shingle; repeated rows are copies; a null id counts in no minimum; an empty
table gives an empty result.  Hashes of 64 bits stand for shingles and sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.components import components
from tillworks.session import drop_folders, materialize, release, scratch

WORDS = 5
# Two documents link when SHARE[1] * intersection >= SHARE[0] * union.
SHARE = (4, 5)
SKETCH_BITS = 17
LEAST_BITS = 512
LEAF = 16
FAN = 4
KNOWN_WORDS = 300_000
FORESTS = 2
CHUNK = 200_000
# Bytes of bitmaps compared in one step, and pairs a small group gives whole.
AT_ONCE = 8_000_000
FEW = 3
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = _Hashes()


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the n-word shingles of a whole text."""
    if len(_known) > KNOWN_WORDS:
        _known.clear()
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    w = np.array([_known[x] for x in words], dtype=np.uint64)
    size = min(n, len(w))
    if not size:
        return np.zeros(0, np.uint64)
    h = np.full(len(w) - size + 1, np.uint64(size))
    for i in range(size):
        h = (h ^ (h >> np.uint64(31))) * _MUL + w[i : len(w) - size + 1 + i]
    h = (h ^ (h >> np.uint64(29))) * _MUL
    return np.unique(h ^ (h >> np.uint64(32)))


def _set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _bitmap(s: np.ndarray) -> bytes:
    """Hashes modulo a power of two of at least twice their number, so few bits collide."""
    size = LEAST_BITS
    while size < 2 * len(s):
        size *= 2
    bits = np.zeros(size, np.uint8)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _folded(bitmaps: list[bytes], size: int | None = None) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all folded to the least size among them or to ``size`` bytes."""
    sizes = np.array(list(map(len, bitmaps)), np.int64)
    size = size or int(sizes.min())
    rows = np.empty((len(bitmaps), size // 8), np.uint64)
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        words = np.frombuffer(b"".join([bitmaps[i] for i in at]), np.uint64)
        rows[at] = np.bitwise_or.reduce(words.reshape(len(at), length // size, size // 8), axis=1)
    return rows


def _likely(bitmaps: list[bytes], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the pairs ``i, j`` of sets can reach the threshold by their bitmaps, and their likeness."""
    num, den = SHARE
    sizes = np.array(list(map(len, bitmaps)), np.int64)
    size = np.minimum(sizes[i], sizes[j]) if len(i) else np.zeros(0, np.int64)
    keep, alike = np.zeros(len(i), bool), np.zeros(len(i))
    for least in np.unique(size).tolist():
        of_size = np.flatnonzero(size == least)
        for p in np.array_split(of_size, len(of_size) * least // AT_ONCE + 1):
            used, at = np.unique(np.r_[i[p], j[p]], return_inverse=True)
            bits = _folded([bitmaps[k] for k in used], least)
            ones = np.bitwise_count(bits).sum(1).astype(np.int64)
            a, b = at[: len(p)], at[len(p) :]
            both = np.bitwise_count(bits[a] & bits[b]).sum(1).astype(np.int64)
            most = both + np.minimum(n[i[p]] - ones[a], n[j[p]] - ones[b])
            keep[p] = (num + den) * most >= num * (n[i[p]] + n[j[p]])
            alike[p] = both / np.maximum(ones[a] + ones[b] - both, 1)
    return keep, alike


def describe(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows ``doc_id, n, id, bitmap`` of documents, and rows ``bucket, seen`` of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            places = [(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64) for x in sets]
            counts += np.bincount(np.concatenate([np.zeros(0, np.int64), *places]), minlength=len(counts))
            # Ids never pass through Python.
            yield rows(batch.column(0), [len(x) for x in sets], [_set_id(x) for x in sets], [_bitmap(x) for x in sets], None, None)
        used = np.flatnonzero(counts)
        yield rows(None, None, None, None, used, counts[used])

    def rows(*columns) -> pa.RecordBatch:
        size = max(len(c) for c in columns if c is not None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        arrays = [
            c if isinstance(c, pa.Array) else pa.nulls(size, kind) if c is None else pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "id", "bitmap", "bucket", "seen"])

    source = df.select(F.col(id_column).cast("long").alias("k"), F.col(text).alias("t"))
    return source.mapInArrow(run, "doc_id long, n long, id long, bitmap binary, bucket int, seen long")


def frequency_classes(described: DataFrame) -> np.ndarray:
    """By sketch bucket: 0 for what chance explains, else the logarithm of the excess.

    Any order gives exact results; this one keeps frequent shingles out of blocks.
    """
    rows = described.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("seen").alias("seen")).toPandas()
    counts = np.zeros(1 << SKETCH_BITS)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["seen"].to_numpy(float)
    usual = np.median(counts)
    excess = counts - usual - 6 * np.sqrt(usual + 1)
    return np.where(excess > 8, np.log2(np.maximum(excess, 1)) + 1, 0).astype(np.uint8)


def block_rows(df: DataFrame, text: str, classes: np.ndarray) -> DataFrame:
    """``h, id, n``: the blocks of each set, once per task and set."""
    shared = df.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for rows in batches:
            hs, ids, ns = [], [], []
            for t in rows["t"]:
                s = shingles(t)
                if not len(s) or (key := _set_id(s)) in seen:
                    continue
                if len(seen) > KNOWN_WORDS:
                    seen.clear()
                seen.add(key)
                first = len(s) - (SHARE[0] * len(s) + SHARE[1] - 1) // SHARE[1] + 1
                order = np.lexsort((s, shared.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))[:first]
                hs.append(s[order].astype(np.int64))
                ids.append(np.full(first, key))
                ns.append(np.full(first, len(s)))
            if hs:
                yield pd.DataFrame({"h": np.concatenate(hs), "id": np.concatenate(ids), "n": np.concatenate(ns).astype(np.int32)})

    return df.select(F.col(text).alias("t")).mapInPandas(run, "h long, id long, n int")


def shared_blocks(rows: DataFrame) -> DataFrame:
    """``h, id, n``: members of blocks of two sets or more.

    Blocks are streamed in order; a block is never gathered.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row seen, and whether it was given out
        for part in batches:
            h, key, n = (part[c].to_numpy() for c in ("h", "id", "n"))
            given = False
            if held is not None:
                h, key, n = np.r_[held[0], h], np.r_[held[1], key], np.r_[held[2], n]
                given = held[3]
            fresh = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
            h, key, n = h[fresh], key[fresh], n[fresh]
            joins = np.r_[False, h[1:] == h[:-1]]
            begins = np.r_[joins[1:], False] & ~joins
            if given:
                begins[0] = False
            out = joins | begins
            # The first row of a batch that goes on with a block is the held one.
            yield pd.DataFrame({"h": h[out], "id": key[out], "n": n[out]})
            held = (h[-1], key[-1], n[-1], bool(joins[-1] or (given and len(h) == 1)))

    return rows.repartition("h").sortWithinPartitions("h", "n", "id").mapInPandas(run, "h long, id long, n int")


class Tree:
    """Signature tree over members in order: arrays per node, children in runs of ``FAN``.  Without ``own`` all members are."""

    def __init__(self, n: np.ndarray, root: np.ndarray, bits: np.ndarray, own: np.ndarray | None = None):
        own = np.ones(len(n), bool) if own is None else own
        self.n, self.root, self.bits, self.own = n, root, bits, own
        self.ones = np.bitwise_count(bits).sum(1).astype(np.int64)
        self.slack = n - self.ones
        starts = np.arange(0, len(n), LEAF)
        level = {
            "bits": np.bitwise_or.reduceat(bits, starts),
            "low": np.minimum.reduceat(n, starts), "high": np.maximum.reduceat(n, starts),
            "slack": np.maximum.reduceat(self.slack, starts),
            "first": np.minimum.reduceat(root, starts), "last": np.maximum.reduceat(root, starts),
            "own": np.logical_or.reduceat(own, starts),
        }
        self.levels = [level]
        joins = {"bits": np.bitwise_or, "low": np.minimum, "high": np.maximum, "slack": np.maximum, "first": np.minimum, "last": np.maximum, "own": np.logical_or}
        while len(level["low"]) > 1:
            starts = np.arange(0, len(level["low"]), FAN)
            level = {k: f.reduceat(level[k], starts) for k, f in joins.items()}
            self.levels.append(level)

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Members that may link across components and their likeness by bitmaps, by dual traversal from the root pair."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            a, b = self._kept(depth, a, b)
            if depth:
                size = len(self.levels[depth - 1]["low"])
                i, j = np.meshgrid(np.arange(FAN), np.arange(FAN), indexing="ij")
                a = (a[:, None] * FAN + i.ravel()).ravel()
                b = (b[:, None] * FAN + j.ravel()).ravel()
                live = (a <= b) & (b < size)
                a, b = a[live], b[live]
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            yield self._within(x, y)

    def _kept(self, depth: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.levels[depth]
        num, den = SHARE
        sizes = (den * v["high"][a] >= num * v["low"][b]) & (den * v["high"][b] >= num * v["low"][a])
        apart = ~((v["first"][a] == v["last"][a]) & (v["first"][b] == v["last"][b]) & (v["first"][a] == v["first"][b]))
        keep = sizes & apart & (v["own"][a] | v["own"][b])
        a, b = a[keep], b[keep]
        most = np.minimum(v["slack"][a], v["slack"][b]) + np.bitwise_count(v["bits"][a] & v["bits"][b]).sum(1)
        keep = (num + den) * most >= num * (v["low"][a] + v["low"][b])
        return a[keep], b[keep]

    def _within(self, x: int, y: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, q = np.arange(x * LEAF, min((x + 1) * LEAF, len(self.n))), np.arange(y * LEAF, min((y + 1) * LEAF, len(self.n)))
        both = np.bitwise_count(self.bits[p][:, None] & self.bits[q][None]).sum(2)
        most = both + np.minimum(self.slack[p][:, None], self.slack[q][None])
        num, den = SHARE
        n, m = self.n[p][:, None], self.n[q][None]
        keep = ((num + den) * most >= num * (n + m)) & (den * n >= num * m) & (den * m >= num * n)
        keep &= (self.root[p][:, None] != self.root[q][None]) & (self.own[p][:, None] | self.own[q][None])
        if x == y:
            keep &= p[:, None] < q[None]
        i, j = np.nonzero(keep)
        alike = both[i, j] / (self.ones[p[i]] + self.ones[q[j]] - both[i, j])
        return p[i], q[j], alike


def _spanning(root: np.ndarray, i: np.ndarray, j: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Places of the edges ``i, j`` of a spanning forest over components, the likeliest edges first."""
    names, at = np.unique(root, return_inverse=True)
    parent, left, kept = list(range(len(names))), len(names), []
    order = np.argsort(-alike, kind="stable")
    for e, u, v in zip(order.tolist(), at[i[order]].tolist(), at[j[order]].tolist(), strict=True):
        while parent[u] != u:
            parent[u] = u = parent[parent[u]]
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        if u != v:
            parent[u] = v
            kept.append(e)
            left -= 1
            if left == 1:
                break
    return np.array(kept, np.int64)


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass
class Members:
    """Rows of groups in order, as arrays."""

    h: np.ndarray
    band: np.ndarray
    root: np.ndarray
    n: np.ndarray
    id: np.ndarray
    own: np.ndarray
    bitmap: list[bytes]

    @staticmethod
    def of(batch: pa.RecordBatch) -> Members:
        return Members(*[batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)], batch.column(6).to_pylist())

    @staticmethod
    def joined(parts: list[Members]) -> Members:
        if len(parts) == 1:
            return parts[0]
        arrays = [np.concatenate([getattr(p, c) for p in parts]) for c in ("h", "band", "root", "n", "id", "own")]
        return Members(*arrays, [x for p in parts for x in p.bitmap])

    def part(self, x: int, y: int) -> Members:
        return Members(self.h[x:y], self.band[x:y], self.root[x:y], self.n[x:y], self.id[x:y], self.own[x:y], self.bitmap[x:y])

    def starts(self) -> np.ndarray:
        """Where the groups begin."""
        return np.flatnonzero(np.r_[True, (self.h[1:] != self.h[:-1]) | (self.band[1:] != self.band[:-1])])


def _group_pairs(group: Members, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``a, b`` of a group's signature tree and whether pairs were held back."""
    root, ids = group.root, group.id
    if root[0] == root[-1] or not group.own.any():
        return
    found, size, back = [], 0, False
    for part in Tree(group.n, root, _folded(group.bitmap), group.own).candidates():
        found.append(part)
        size += len(part[0])
        if size > CHUNK:
            i, j, alike = _joined(found)
            if whole:
                yield ids[i], ids[j], False
                found, size = [], 0
                continue
            kept = _spanning(root, i, j, alike)
            found, size, back = [(i[kept], j[kept], alike[kept])], len(kept), True
    if size:
        i, j, alike = _joined(found)
        if not whole:
            kept = _spanning(root, i, j, alike)
            i, j, back = i[kept], j[kept], back or len(kept) < len(i)
        yield ids[i], ids[j], back


def _small_pairs(rows: Members, begin: np.ndarray, end: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b`` of groups of one leaf, all compared in one step, and the blocks that held pairs back.

    A tree of one leaf prunes nothing: each group's pairs are listed at once.
    """
    num, den = SHARE
    sizes = end - begin
    at = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    after = np.repeat(end, sizes) - at - 1
    i = np.repeat(at, after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    n, root, own = rows.n, rows.root, rows.own
    live = (root[i] != root[j]) & (own[i] | own[j]) & (den * n[i] >= num * n[j]) & (den * n[j] >= num * n[i])
    i, j = i[live], j[live]
    keep, alike = _likely(rows.bitmap, n, i, j)
    i, j, alike = i[keep], j[keep], alike[keep]
    if whole or not len(i):
        return rows.id[i], rows.id[j], rows.h[:0]
    # Pairs stand by group; larger numbers of them are thinned to a spanning forest.
    cut = np.flatnonzero(np.r_[True, (rows.h[i[1:]] != rows.h[i[:-1]]) | (rows.band[i[1:]] != rows.band[i[:-1]])])
    upto = np.r_[cut[1:], len(i)]
    given, held = np.ones(len(i), bool), []
    for x, y in zip(cut[upto - cut > FEW].tolist(), upto[upto - cut > FEW].tolist(), strict=True):
        kept = _spanning(root, i[x:y], j[x:y], alike[x:y])
        if len(kept) < y - x:
            held.append(rows.h[i[x]])
            given[x:y] = False
            given[x + kept] = True
    return rows.id[i[given]], rows.id[j[given]], np.array(held, np.int64)


def cross_pairs(members: DataFrame, whole: bool) -> DataFrame:
    """``a, b, h``: pairs across components that a block's signature tree lets through.

    ``members`` has ``h, id, n, root, bitmap``.  Members go to a group by the band
    of their size and, as guests, to the next one, so a group spans a factor of
    1.6; guests are not compared with each other, as they meet in their own band.
    Unless ``whole``, a large group gives a spanning forest of its components, and
    a row with only ``h`` tells of a block that held pairs back.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(SHARE[1] / SHARE[0])) + 1e-9).cast("int")
    dealt = members.withColumn("_band", band).withColumn("band", F.explode(F.array(F.col("_band"), F.col("_band") + 1)))

    def pairs_of(rows: Members) -> Iterator[pa.RecordBatch]:
        begin = rows.starts()
        end = np.r_[begin[1:], len(rows.h)]
        small = (end - begin > 1) & (end - begin <= LEAF)
        found = [_small_pairs(rows, begin[small], end[small], whole)]
        large = end - begin > LEAF
        for x, y in zip(begin[large].tolist(), end[large].tolist(), strict=True):
            for a, b, back in _group_pairs(rows.part(x, y), whole):
                found.append((a, b, rows.h[x : x + back]))
        for a, b, held in found:
            if len(a) or len(held):
                none = pa.nulls(len(held), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(np.minimum(a, b), pa.int64()), none]),
                        pa.concat_arrays([pa.array(np.maximum(a, b), pa.int64()), none]),
                        pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(held, pa.int64())]),
                    ],
                    ["a", "b", "h"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[Members] = []  # the rows of the group that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Members.of(batch)
            last = rows.starts()[-1]
            goes_on = bool(waiting) and waiting[-1].h[-1] == rows.h[0] and waiting[-1].band[-1] == rows.band[0]
            if last == 0 and goes_on:
                waiting.append(rows)
                continue
            done = [*waiting, rows.part(0, last)] if last else waiting
            waiting = [rows.part(last, len(rows.h))]
            if done:
                yield from pairs_of(Members.joined(done))
        if waiting:
            yield from pairs_of(Members.joined(waiting))

    order = ["h", "band", "root", "n", "id"]
    rows = dealt.select(*order, (F.col("band") == F.col("_band")).alias("own"), "bitmap")
    return rows.repartition("h", "band").sortWithinPartitions(*order).mapInArrow(run, "a long, b long, h long").distinct()


def links(pairs: DataFrame, classes: DataFrame, df: DataFrame, id_column: str, text: str) -> DataFrame:
    """The pairs (``a, b``) that reach the threshold, by bitmaps and then by exact intersection."""
    num, den = SHARE
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        (den * F.col("n_a") >= num * F.col("n_b")) & (den * F.col("n_b") >= num * F.col("n_a"))
    )

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            n = np.concatenate([batch.column(i).to_numpy() for i in (2, 3)])
            bits = [x for i in (4, 5) for x in batch.column(i).to_pylist()]
            keep, _ = _likely(bits, n, np.arange(size), np.arange(size, 2 * size))
            yield batch.select(range(4)).filter(pa.array(keep))

    listed = sized.select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    left = materialize(listed.mapInArrow(possible, "a long, b long, n_a long, n_b long"), "pairs")
    wanted = left.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes.select("id", "min_doc"), "id")

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets = [shingles(t) for t in rows["t"]]
            # Another text can have the same id: only the class's own set counts.
            mine = [_set_id(s) == key for s, key in zip(sets, rows["id"].tolist(), strict=True)]
            yield pd.DataFrame({"id": rows["id"][mine], "s": [s.astype(np.int64) for s, m in zip(sets, mine, strict=True) if m]})

    texts = df.select(F.col(id_column).cast("long").alias("min_doc"), F.col(text).alias("t"))
    sets = materialize(
        texts.join(wanted, "min_doc").select("id", "t").mapInPandas(gather, "id long, s array<long>").dropDuplicates(["id"]), "sets"
    )
    joined = left.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("s_b")), "b"
    )
    both = F.size(F.array_intersect("s_a", "s_b"))
    return joined.filter(den * both >= num * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def merge(roots: DataFrame | None, linked: DataFrame) -> DataFrame:
    """``id, root`` after the pairs ``linked`` have been joined to the components ``roots``."""
    if roots is None:
        return components(linked)
    at = lambda x: roots.select(F.col("id").alias(x), F.col("root").alias(f"r_{x}"))
    between = linked.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
        F.coalesce("r_a", "a").alias("a"), F.coalesce("r_b", "b").alias("b")
    )
    merged = components(between).select(F.col("id").alias("r"), F.col("root").alias("r2"))
    # A root that was no member of a component yet is a member from now on.
    known = roots.unionByName(merged.select(F.col("r").alias("id"), F.col("r").alias("root"))).distinct()
    return materialize(
        known.join(merged, known["root"] == merged["r"], "left").select("id", F.coalesce("r2", "root").alias("root")).distinct(), "roots"
    )


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` for every row of ``df``, written; no other folder is left."""
    with scratch(df.sparkSession):
        described = materialize(describe(df, id_column, text), "described")
        docs = described.filter("bucket IS NULL").select("doc_id", "n", "id", "bitmap")
        by_class = _classes(df, described, docs, id_column, text)
        named = docs.join(by_class, (docs["id"] == by_class["_id"]) & (docs["n"] > 0), "left").select(
            F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
        )
        with scratch(df.sparkSession, delete=False):  # the result outlives the block
            return materialize(named, "near_duplicates")


def _classes(df: DataFrame, described: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``_id, component_id`` of every class; folders on the way go as soon as what reads them stands."""
    spark = df.sparkSession
    classes = materialize(
        docs.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("min_doc"), F.max("n").alias("n"), F.max("bitmap").alias("bitmap"))
        .filter("min_doc IS NOT NULL"),
        "classes",
    )
    open_blocks = materialize(shared_blocks(block_rows(df, text, frequency_classes(described))), "blocks")
    roots = None
    for turn in range(FORESTS + 1):
        with scratch(spark, delete=False) as made:
            placed = open_blocks.withColumn("root", F.col("id"))
            if roots is not None:
                placed = open_blocks.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
            placed = materialize(placed, "placed")
            # Blocks of several components; of blocks with the same members one is enough.
            mixed = (
                placed.groupBy("h").agg(
                    F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("id")).alias("mark")
                )
                .filter("r0 <> r1").groupBy("size", "mark").agg(F.min("h").alias("h"))
            )
            members = placed.join(mixed.select("h"), "h", "left_semi").join(classes.select("id", "bitmap"), "id")
            found = materialize(cross_pairs(members, turn == FORESTS), "pairs")
            linked = links(found.filter("a IS NOT NULL").select("a", "b"), classes, df, id_column, text)
            earlier, roots = roots, merge(roots, linked)
            held = found.filter("h IS NOT NULL").select("h")
            last = held.isEmpty()
            before, kept = open_blocks, [roots._written_to]
            if not last:
                open_blocks = materialize(placed.select("h", "id", "n").join(held, "h", "left_semi"), "blocks")
                kept.append(open_blocks._written_to)
            drop_folders(spark, [path for path in made if path not in kept])
        release(*([earlier] if earlier is not None else []), *([] if last else [before]))
        if last:
            break
    final = (
        classes.select("id", "min_doc").join(roots, "id", "left").select("id", "min_doc", F.coalesce("root", "id").alias("root"))
    )
    least = final.groupBy("root").agg(F.min("min_doc").alias("component_id"))
    by_class = materialize(final.join(least, "root").select(F.col("id").alias("_id"), "component_id"), "by_class")
    release(roots, open_blocks)
    return by_class

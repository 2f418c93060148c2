"""Document fingerprints from closed syncmers.

Every k-mer of code points whose smallest s-mer lies at its first or last place
is an anchor.  The choice looks at the k-mer alone, so text around it does not
matter, and one anchor at least falls in any ``K - S`` successive places.  A
fingerprint lists the anchors' 32-bit hashes with the steps between them.  Two
fingerprints are compared by position: anchors of equal hash are paired in
order of occurrence, and the longest chain that rises in both texts counts.

Cases: a null text is an empty one, whose fingerprint is empty; a text shorter
than K is one anchor; equal texts have equal fingerprints, and two empty ones
likeness 1; long texts are hashed in overlapping segments with the same result;
rows without an id, or with a shared one, follow each other by the hash of the
text, repeated rows are each other's next document; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, S = 32, 12
SEGMENT = 1 << 19
_BASE = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``width``, by doubling."""
    h, size = codes, 1
    out, done = None, 0
    power = int(_BASE)
    while True:
        if width & size:
            if out is None:
                out, done = h, size
            else:
                shift = pow(int(_BASE), size, 1 << 64)
                n = len(codes) - (done + size) + 1
                out = out[:n] * np.uint64(shift) + h[done : done + n]
                done += size
        size *= 2
        if size > width:
            return out
        n = len(codes) - size + 1
        h = h[:n] * np.uint64(power) + h[size // 2 : size // 2 + n]
        power = power * power % (1 << 64)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width``, by doubling."""
    m, size = values, 1
    while size * 2 <= width:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint32) and places of the anchors of ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    codes = (codes + np.uint64(1)) * _MIX
    if not len(codes):
        return np.zeros(0, "<u4"), np.zeros(0, np.int64)
    if len(codes) < K:
        codes = np.concatenate([codes, np.zeros(K - len(codes), np.uint64)])
    hashes, places = [], []
    for at in range(0, len(codes) - K + 1, SEGMENT):
        part = codes[at : at + SEGMENT + K - 1]
        inner = _mixed(_windows(part, S))
        n = len(part) - K + 1
        low = _least(inner, K - S + 1)
        chosen = np.flatnonzero((low == inner[:n]) | (low == inner[K - S : K - S + n]))
        whole = _mixed(_windows(part, K))[chosen]
        hashes.append((whole >> np.uint64(32)).astype("<u4"))
        places.append(chosen + at)
    found, where = np.concatenate(hashes), np.concatenate(places)
    if not len(found):
        first = _mixed(_windows(codes[:K], K))
        return (first >> np.uint64(32)).astype("<u4"), np.zeros(1, np.int64)
    return found, where


def fingerprint(text: str) -> str:
    hashes, places = anchors(text)
    steps = np.diff(places, prepend=0).astype("<u2")
    return base64.b64encode(hashes.tobytes() + steps.tobytes()).decode()


def read_fingerprint(code: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(code)
    n = len(raw) // 6
    return np.frombuffer(raw, "<u4", n), np.cumsum(np.frombuffer(raw, "<u2", n, 4 * n).astype(np.int64))


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Hash and number of occurrence as one integer each."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    starts = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    out = np.empty(len(ranked), np.uint64)
    out[order] = (ranked.astype(np.uint64) << np.uint64(32)) + (np.arange(len(ranked)) - starts).astype(np.uint64)
    return out


def likeness(a: str, b: str) -> float:
    """Dice coefficient of the anchors that match in rising order, from 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (ha, _), (hb, _) = read_fingerprint(a), read_fingerprint(b)
    _, ia, ib = np.intersect1d(_numbered(ha), _numbered(hb), assume_unique=True, return_indices=True)
    line = ib[np.argsort(ia)]
    if len(line) < 2 or (np.diff(line) > 0).all():
        chain = len(line)
    else:
        tails: list[int] = []
        for x in line.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        chain = len(tails)
    return 2 * chain / (len(ha) + len(hb))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_following(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows dealt to slices of the id's order so that every row meets its successor.

    Slices hold consecutive ids; the first row of each also goes, marked
    ``_tail``, to the slice before (the very first one to the last), so texts are
    shuffled once and no task sees more than its slice.  An id that fills slices
    alone (or the rows without one) is cut by the hash of the text.  Returns ``_id, _slice,
    _tail, _key, _hash, _text``; null ids come first, ties are ordered by a hash of the text.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    lowest = -(1 << 63)
    rows = df.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(lowest)).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).withColumn("_hash", F.xxhash64("_text"))
    cuts = rows.select(F.percentile_approx("_key", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    # A cut that comes several times is an id of so many slices: they follow that of the ids below it.
    parts = {c: m if m > 1 else 0 for c, m in sorted(Counter(cuts).items())}
    starts = list(accumulate((1 + m for m in parts.values()), initial=0))
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    place = F.size(F.filter(longs(parts), lambda c: c < F.col("_key"))) + 1
    m = F.get(longs(parts.values()), place - 1)
    # The upper half of the hash, scaled to the number of parts: rising with the hash.
    part = F.shiftright((F.shiftright("_hash", 32) + F.lit(1 << 31)) * m, 32)
    alone = (m > 0) & (F.get(longs(parts), place - 1) == F.col("_key"))
    sliced = rows.withColumn("_slice", (F.element_at(longs(starts), place) + F.when(alone, part + 1).otherwise(0)).cast("int"))
    # Of the rows of one id, or without one, only the first goes to the slice before.
    firsts = {r[0]: r[1] for r in sliced.groupBy("_slice").agg(F.min(F.struct("_key", "_hash"))).collect()}
    used = sorted(firsts)
    before = {s: used[i - 1] for i, s in enumerate(used)}
    none = (lowest, lowest)
    first = [F.array(*[F.lit(firsts.get(s, none)[i]).cast("long") for s in range(starts[-1] + 1)]) for i in (0, 1)]
    previous = F.array(*[F.lit(before.get(s, s)) for s in range(starts[-1] + 1)])
    own = F.struct(F.col("_slice").alias("s"), F.lit(0).alias("t"))
    tail = F.struct(F.element_at(previous, F.col("_slice") + 1).alias("s"), F.lit(1).alias("t"))
    is_first = (F.col("_key") == F.element_at(first[0], F.col("_slice") + 1)) & (F.col("_hash") == F.element_at(first[1], F.col("_slice") + 1))
    dealt = sliced.withColumn("_to", F.explode(F.when(is_first, F.array(own, tail)).otherwise(F.array(own))))
    return (
        dealt.select("_id", F.col("_to.s").alias("_slice"), F.col("_to.t").alias("_tail"), "_key", "_hash", "_text")
        .repartition("_slice")
        .sortWithinPartitions("_slice", "_tail", "_key", "_hash", "_text")
    )


def fingerprint_edits(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likenesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                code = fingerprint(row[3])
                if held is not None and held[1] == row[1] and not held[2]:
                    changed = edited(held[3], row[3])
                    other = fingerprint(changed)
                    out.append((
                        held[0], len(held[3]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        held[4], other, likeness(held[4], other), likeness(held[4], code),
                    ))
                held = (*row, code)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names)

    names = [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["long", "long", "string", "string", "string", "double", "double"]
    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[k] for k in kinds]
    schema = ", ".join(f"`{a}` {b}" for a, b in zip(names, kinds, strict=True))
    rows = with_following(df.withColumn(id_column, F.col(id_column).cast("long")), id_column, text)
    return rows.select("_id", "_slice", "_tail", "_text").mapInArrow(run, schema)

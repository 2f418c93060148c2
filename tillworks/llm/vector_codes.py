"""Vector code compression: product codes learned and looked up by equal-average search.

A vector of integers (components scaled and floored) is cut into equal parts,
and each part is replaced by the index of the nearest entry of its position's
codebook.  Entries are sorted by their component sum.  A search starts where
the part's own sum falls and expands outward, always to the side whose sum is
nearer.  By Cauchy-Schwarz the squared gap of two sums over the dimension is at
most the squared distance, so the search ends once that bound strictly exceeds
the best distance: no entry further out is nearer or as near.  All arithmetic
is exact, in 64-bit integers.

Learning takes the parts of the smallest ids as first entries; in each round the
tasks add up counts and sums per entry, Spark adds those, and only one row per
entry (``parts * entries``, set by parameters) reaches the driver.

Rows without a vector, or with a null or non-finite component, go.  Rows without
an id count as the largest ids; rows that share an id are ordered by vector and
coded each.  The table's length of vectors is the most common one (the greatest
of several) and must be a positive multiple of ``parts``; a vector of another
length is not learned from and has a null code and error.  Fewer rows than
``entries`` give smaller codebooks, an empty table an empty result.  Components
so large that squared distances leave 64 bits raise an error instead of wrapping.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


class EqualAverage:
    """The codebooks ``[part, entry, component]`` of one round, sorted for the search."""

    def __init__(self, books: np.ndarray):
        sums = books.sum(2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, 1)
        self.entries = np.take_along_axis(books, self.order[:, :, None], 1).reshape(-1, books.shape[2])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each part of ``x [row, part, component]``; ties to the lower index."""
        rows, parts, width = x.shape
        size, flat = self.sums.shape[1], x.reshape(-1, width)
        total = flat.sum(1)
        high = np.empty(len(flat), np.int64)
        for p in range(parts):
            high[p::parts] = np.searchsorted(self.sums[p], total[p::parts])
        # One flat array of all positions' entries; a part sees its own stretch of it.
        first = np.tile(np.arange(parts) * size, rows)
        sums, order = self.sums.reshape(-1), self.order.reshape(-1)
        best, index = np.full(len(flat), -1), np.zeros(len(flat), np.int64)
        far = np.iinfo(np.int64).max
        left = np.arange(len(flat))
        low, high = first + high - 1, first + high
        last = first + size - 1
        while len(left):
            below = np.where(low >= first, total[left] - sums[np.maximum(low, first)], far)
            above = np.where(high <= last, sums[np.minimum(high, last)] - total[left], far)
            gap = np.minimum(below, above)
            go = gap < far
            go[go] &= (best[left[go]] < 0) | (gap[go] ** 2 <= best[left[go]] * width)
            left, low, high, first, last, down = left[go], low[go], high[go], first[go], last[go], (below <= above)[go]
            at = np.where(down, low, high)
            apart = flat[left] - self.entries[at]
            distance, found = (apart * apart).sum(1), order[at]
            known = best[left]
            better = (known < 0) | (distance < known) | ((distance == known) & (found < index[left]))
            best[left[better]], index[left[better]] = distance[better], found[better]
            low, high = low - down, high + ~down
        return index.reshape(rows, parts), best.reshape(rows, parts)


def _cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """The vectors of a batch as ``[row, part, component]``, within the range of exact arithmetic."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, parts, width)
    # Squared sum gaps and squared distances of whole vectors stay below 2^63.
    limit = math.isqrt(2**63 - 1) // (2 * max(width, math.isqrt(parts * width) + 1))
    if x.size and max(int(x.max()), -int(x.min())) > limit:
        raise ValueError(f"a scaled component is beyond {limit}: squared distances would not fit 64 bits")
    return x


def scaled(df: DataFrame, id_column: str, vector: str, scale: int, others: list[str]) -> DataFrame:
    """Rows with a whole, finite vector: the id, ``others`` and ``_x``, the components scaled and floored."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = df.filter(F.col(vector).isNotNull()).filter(~F.exists(vector, bad))
    return whole.select(id_column, *others, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("_x"))


def learn(kept: DataFrame, id_column: str, parts: int, entries: int, rounds: int) -> np.ndarray | None:
    """Codebooks ``[part, entry, component]`` after ``rounds``; None without rows."""
    common = kept.groupBy(F.size("_x").alias("n")).count().filter("n > 0").sort(F.desc("count"), F.desc("n")).first()
    if common is None:
        return None
    if common["n"] % parts:
        raise ValueError(f"vectors of length {common['n']} do not cut into {parts} equal parts")
    width = common["n"] // parts
    fitting = kept.filter(F.size("_x") == common["n"])
    start = fitting.sort(F.col(id_column).asc_nulls_last(), "_x").limit(entries).select("_x").collect()
    books = _cut(pa.array([r["_x"] for r in start]), parts, width).transpose(1, 0, 2).copy()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, size = EqualAverage(books), books.shape[1]
        counts, sums = np.zeros(parts * size, np.int64), np.zeros((parts * size, width), np.int64)
        for batch in batches:
            x = _cut(batch.column(0), parts, width)
            slots = (search.nearest(x)[0] + np.arange(parts) * size).reshape(-1)
            counts += np.bincount(slots, minlength=len(counts))
            np.add.at(sums, slots, x.reshape(-1, width))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["slot", "n", "sums"]
        )

    for _ in range(rounds):
        partial = fitting.select("_x").mapInArrow(add_up, "slot long, n long, sums array<long>")
        totals = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        moved = books.copy()
        # One row per entry at most: bounded by the parameters.
        for row in totals.collect():
            p, k = divmod(row["slot"], books.shape[1])
            moved[p, k] = [row[f"s{i}"] // row["n"] for i in range(width)]
        books = moved
    return books


def compress(
    df: DataFrame,
    id_column: str,
    vector: str,
    others: list[str] | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Codes and codebooks.

    The codes have the id, the columns ``others``, ``code`` (two hex digits a
    part, so at most 256 entries) and ``error``, the squared distances summed over
    the parts; the codebooks are ``[part, entry, component]``.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name 256 entries at most")
    others = others or []
    kept = materialize(scaled(df, id_column, vector, scale, others), "scaled")
    books = learn(kept, id_column, parts, entries, rounds)
    if books is None:
        books = np.zeros((parts, 0, 0), np.int64)
        return kept.select(id_column, *others, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), books
    width, columns = books.shape[2], [id_column, *others]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = EqualAverage(books)
        for batch in batches:
            found, distance = search.nearest(_cut(batch.column(len(columns)), parts, width))
            digits = [bytes(r).hex() for r in found.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(columns))] + [pa.array(digits, pa.string()), pa.array(distance.sum(1))], [*columns, "code", "error"]
            )

    fits = F.size("_x") == parts * width
    schema = kept.drop("_x").schema.add("code", "string").add("error", "long")
    coded = kept.filter(fits).mapInArrow(code, schema)
    odd = kept.filter(~fits).select(*columns, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(odd), books


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and place, comma-joined."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def with_label_error(codes: DataFrame, label: str) -> DataFrame:
    """``codes`` with ``label_error``, the errors summed over rows of an equal label, nulls together.

    Sums combine before the shuffle.  They are few where labels are, and adaptive
    execution then broadcasts them; else it splits the partitions of a hot label.
    """
    codes = materialize(codes, "codes")
    totals = codes.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, codes[label].eqNullSafe(totals["_label"]), "left").drop("_label")


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL for the digests of ``embeddings``: every part against every entry of its position."""
    apart = "list_sum(list_transform(generate_series(1, len(x.v)), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))"
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS c
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"cuts AS (SELECT r, vec_id, label, p, c[p * len(c) // {parts} + 1:(p + 1) * len(c) // {parts}] AS v, c FROM kept, (SELECT unnest(range({parts})) AS p))",
        f"books0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, c) - 1 AS k, v FROM cuts QUALIFY k < {entries})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""found{i} AS (SELECT x.r, x.p, x.v, b.k, {apart} AS d FROM cuts x JOIN books{i} b ON x.p = b.p
    QUALIFY row_number() OVER (PARTITION BY x.r, x.p ORDER BY d, b.k) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""means{i} AS (SELECT p, k, list(CAST(m AS BIGINT) ORDER BY j) AS v FROM (SELECT p, k, j, floor(sum(v[j]) / count(*)) AS m
      FROM found{i}, LATERAL (SELECT unnest(generate_series(1, len(v))) AS j) GROUP BY p, k, j) GROUP BY p, k),
    books{i + 1} AS (SELECT p, k, coalesce(m.v, b.v) AS v FROM books{i} b LEFT JOIN means{i} m USING (p, k))"""
            )
    return f"""WITH {', '.join(steps)},
  coded AS (SELECT r, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM found{rounds} GROUP BY r),
  whole AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM books{rounds})
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), whole"""

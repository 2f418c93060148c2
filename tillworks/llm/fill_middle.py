"""Fill-in-the-middle transformation over an indexable skip list.

The units of a text (a word with the white space before it, or the white space
at the end) form the bottom lane of a skip list.  Express lanes hold fewer and
fewer of them, and every link carries two widths: the units and the code points
it spans.  A cut is a rank of units; descending from the sparsest lane while the
accumulated units stay within the rank reaches it after a few links a lane, and
the code points accumulated on the way are where to cut.

A row's draws come from the hash of the seed and its id, so they do not depend
on partitions or order.  Null text is empty and stays plain, as do texts that
hold a marker.  A null id draws as an empty one; rows that share an id share
their draws and are cut each by its own length.  Very long texts cost their
length once; an empty table gives an empty table; columns beside the id and the
text go through untouched, and a name that this operator adds may not be taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"
# One node in 2^LANE_BITS of a lane is on the next one.
LANE_BITS = 2


def unit_ends(text: str) -> np.ndarray:
    """Where each unit of ``text`` ends, in code points."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    white = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    return np.append(ends, len(points))


class SkipList:
    """Units by rank.  ``lanes[0]`` links every unit, each lane above about a quarter of the one below.

    A lane is the units and code points spanned by its links, in order, and for
    every node the number of links before its twin on the lane below.
    """

    def __init__(self, ends: np.ndarray):
        at = np.arange(1, len(ends) + 1, dtype=np.int64)
        # Heights are hashed from the place, so no text can make lanes degenerate.
        mixed = at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        low = np.uint64((1 << LANE_BITS) - 1)
        self.lanes, below = [], at
        while True:
            chars = ends[at - 1]
            # Places on the lane below of this lane's nodes, counted from its head.
            down = np.searchsorted(below, at) + 1
            self.lanes.append((np.diff(at, prepend=0), np.diff(chars, prepend=0), down))
            mixed, kept = mixed >> np.uint64(LANE_BITS), (mixed & low) == 0
            if not kept.any():
                break
            below, at, mixed = at, at[kept], mixed[kept]

    def code_points(self, rank: int) -> int:
        """Code points in the first ``rank`` units."""
        units = chars = link = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            unit_widths, char_widths, down = self.lanes[level]
            while link < len(unit_widths) and units + unit_widths[link] <= rank:
                units += int(unit_widths[link])
                chars += int(char_widths[link])
                link += 1
            if level:
                link = int(down[link - 1]) if link else 0
        return chars


def _draws(id_column: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hash, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    df: DataFrame, id_column: str, text: str, seed: int = 42, rate: int = 50, spm_share: int = 80
) -> DataFrame:
    """``df`` with ``n, form, prefix_chars, middle_chars, output``.

    ``rate`` percent of the texts are cut; of those ``spm_share`` percent put the
    suffix first.  Other texts are ``plain``: output as they are.
    """
    taken = {c.name for c in T.StructType.fromDDL(ADDED)} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")

    def cut(value: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
        ends = unit_ends(value)
        n = len(ends)
        if not n or h3 % 100 >= rate or any(m in value for m in MARKERS):
            return n, "plain", None, None, value
        units = SkipList(ends)
        first, second = (units.code_points(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = value[:first], value[first:second], value[second:]
        if h4 % 100 < spm_share:
            return n, "spm", first, second - first, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
        return n, "psm", first, second - first, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle

    rest = df.columns
    # Text outputs can be twice a batch; 64-bit offsets hold any.
    kinds = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = [batch.column(len(rest) + i).to_pylist() for i in range(5)]
            done = list(zip(*map(cut, *inputs), strict=True)) if batch.num_rows else [()] * len(kinds)
            added = [pa.array(values, kind) for values, (_, kind) in zip(done, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(rest))] + added, rest + [k for k, _ in kinds])

    # Names that no column of the table has.
    prefix = "_" * max([0, *(len(c) for c in rest)])
    inputs = [F.coalesce(F.col(text), F.lit("")), *_draws(id_column, seed)]
    source = df.select(*rest, *[c.alias(f"{prefix}_{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(ADDED).fields])
    return source.mapInArrow(run, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text, rebuilt from a row's form and output; markers never occur inside the pieces."""
    parts = F.split(F.col(output), "|".join(MARKERS), -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    rebuilt = {k: F.concat(*[F.element_at(parts, i + 1) for i in places]) for k, places in order.items()}
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", rebuilt["psm"]).otherwise(rebuilt["spm"])


def digest_sql(seed: int = 42, rate: int = 50, spm_share: int = 80) -> str:
    """DuckDB SQL for the digests of ``documents``: units as a list, cuts by slices of it."""
    number = lambda i: f"('0x' || substr(sha, {1 + 8 * i}, 8))::BIGINT"
    return rf"""WITH units AS (SELECT doc_id, coalesce(text, '') AS body, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS sha,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
  ranks AS (SELECT *, len(u) AS n, least({number(0)} % (len(u) + 1), {number(1)} % (len(u) + 1)) AS a, greatest({number(0)} % (len(u) + 1), {number(1)} % (len(u) + 1)) AS b,
    CASE WHEN body = '' OR regexp_matches(body, '{"|".join(MARKERS)}') OR {number(2)} % 100 >= {rate} THEN 'plain'
      WHEN {number(3)} % 100 < {spm_share} THEN 'spm' ELSE 'psm' END AS form FROM units),
  pieces AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM ranks)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
    sha256(body) AS restored_sha256 FROM pieces"""

"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, shuffled by a hash of their ids, form a stream of
words cut into ``ceil(size / BLOCK_WORDS)`` blocks of nearly equal size.  A source
gets as many slots as its target needs blocks, in turn and beginning anew after
the last; its last slot is cut where the target, in whole words, is reached.  The
order of the slots are the van der Corput points (base 2) below their number: the
point of a slot falls into the share of the slots that is its source's.  How many
slots of a source come before one follows from the binary digits of the point's
index, so slots are ranked without a window or a shuffle, and any prefix of the
schedule is mixed as the whole.

Cases: a null text has size 0, a null source is a source of its own (last);
documents without words are taken 0 times; repeated rows are separate
documents; ties in the shuffle go by id and size, and documents without an id are
shuffled by their texts; a source with a target gets one word at least; an empty table gives an empty
result.  Only sources, at most ``MAX_SOURCES``, reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import cycle, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import running_total
from tillworks.session import materialize

BLOCK_WORDS = 32
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
MAX_SOURCES = 100_000
BITS = 40
SLOTS_PER_TASK = 1 << 20


def word_targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> list[float]:
    """Words to take of each source: shares of the sum by weight, at most ``most`` times the
    size, the excess shared by weight among the others until none is above."""
    given = [w for w, _ in zip(cycle(weights), sizes, strict=False)]
    target: list[float | None] = [None] * len(sizes)
    left = float(sum(sizes))
    while True:
        open_ = [i for i, t in enumerate(target) if t is None]
        total = sum(given[i] for i in open_)
        over = [i for i in open_ if left * given[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * given[i] / total
            return [float(t) for t in target]
        for i in over:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in over)


def reversed_bits(i: np.ndarray) -> np.ndarray:
    """The van der Corput point of each index, in units of ``2 ** -BITS``."""
    out = np.zeros_like(i)
    for b in range(BITS):
        out |= ((i >> b) & 1) << (BITS - 1 - b)
    return out


def ranks(i: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many ``j < i`` have their point in ``[low, high)``, from the digits of ``i``.

    Indices below ``i`` fall into one aligned run of ``2 ** b`` for each digit set;
    the points of such a run are equally spaced.
    """
    out = np.zeros_like(i)
    for b in range(BITS):
        run = ((i >> b) & 1).astype(bool)
        if not run.any():
            continue
        first = reversed_bits(((i[run] >> b) >> 1) << (b + 1))
        step = BITS - b
        below = lambda x: np.maximum(0, (x - first + (1 << step) - 1) >> step)  # noqa: B023, E731
        out[run] += below(high[run]) - below(low[run])
    return out


def plan(targets: list[float], sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Per source: blocks, words of a short block, blocks with one word more, slots, and words in all slots."""
    size = np.array(sizes, np.int64)
    blocks = np.maximum(1, -(-size // BLOCK_WORDS))
    base, extra = size // blocks, size % blocks
    words = np.minimum(MOST_TIMES * size, np.round(np.array(targets)).astype(np.int64))
    words = np.where((np.array(targets) > 0) & (size > 0), np.maximum(1, words), 0)
    rounds, rest = np.divmod(words, np.maximum(1, size))
    # The longer blocks come first.
    long = extra * (base + 1)
    part = np.where(rest <= long, -(-rest // (base + 1)), extra - (long - rest) // np.maximum(1, base))
    return blocks, base, extra, rounds * blocks + part, words


def schedule(spark, targets: list[float], sizes: list[int]) -> DataFrame:
    """``slot, source_rank, epoch, block, most`` of the whole mix; ``most`` is how many words of the block are taken."""
    blocks, base, extra, slots, words = plan(targets, sizes)
    n_slots = int(slots.sum())
    bits = max(0, n_slots - 1).bit_length()
    edges = np.cumsum(np.r_[0, slots]) << (BITS - bits)
    shared = spark.sparkContext.broadcast((edges, blocks, base, extra, slots, words, np.array(sizes, np.int64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges, blocks, base, extra, slots, words, size = shared.value
        for rows in batches:
            i = rows["id"].to_numpy(np.int64)
            i = i[reversed_bits(i) < edges[-1]]
            source = np.searchsorted(edges, reversed_bits(i), "right") - 1
            k = ranks(i, edges[source], edges[source + 1])
            epoch, block = k // blocks[source], k % blocks[source]
            start = block * base[source] + np.minimum(block, extra[source])
            whole = base[source] + (block < extra[source])
            most = np.where(k == slots[source] - 1, words[source] - epoch * size[source] - start, whole)
            slot = ranks(i, np.zeros_like(i), np.full_like(i, edges[-1]))
            yield pd.DataFrame({"slot": slot, "source_rank": source, "epoch": epoch, "block": block, "most": most})

    n_points = (1 << bits) if n_slots else 0
    parts = max(1, -(-n_points // SLOTS_PER_TASK))
    return spark.range(0, n_points, 1, parts).mapInPandas(run, "slot long, source_rank long, epoch long, block long, most long")


def mix(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents with ``size, source_size, target, taken, first_slot, slots, copies``, and the
    schedule with the pieces of documents in each slot (``slot, epoch, id, first, words``).

    ``first_slot`` is where a document stands first in the mix and ``slots`` in how
    many it stands; ``copies`` has, of each time it is taken (at most ``MOST_TIMES``),
    the first slot, the place of its first word there and the words.  ``row`` names a key of single rows to keep.
    """
    spark = df.sparkSession
    extra = [F.col(row).alias("_row")] if row else []
    sized = materialize(
        df.select(
            F.col(id_column).alias("_id"), *extra,
            # Without an id the text says where a document stands in the shuffle.
            F.when(F.col(id_column).isNull(), F.xxhash64(text)).alias("_text"),
            F.col(source).alias("_source"),
            F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size"),
        ),
        "sized",
    )
    found = sized.groupBy("_source").agg(F.sum("_size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(((r["_source"], r["n"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in found]
    targets = word_targets(sizes) if sum(sizes) else [0.0] * len(sizes)
    starts = [0, *np.cumsum(sizes).tolist()]
    kind = sized.schema["_source"].dataType.simpleString()
    _, base, longer, _, _ = plan(targets, sizes)
    known = spark.createDataFrame(
        [(s, i, n, starts[i], t, int(base[i]), int(longer[i])) for i, ((s, n), t) in enumerate(zip(found, targets, strict=True))],
        f"_s {kind}, source_rank long, source_size long, _start long, target double, _base long, _longer long",
    )
    # One row per source: bounded by MAX_SOURCES, checked above.
    ranked = sized.join(F.broadcast(known), sized["_source"].eqNullSafe(known["_s"])).drop("_s", "_source")
    ranked = ranked.withColumn("_shuffled", F.xxhash64(F.lit(seed), "_id", "_text")).drop("_text")
    placed = running_total(ranked, ["source_rank", "_shuffled", "_id", "_size"], "_size", "_before")
    placed = placed.withColumn("_at", F.col("_before") - F.col("_start"))
    def block_of(word: str):
        """The block a word lies in; the longer blocks come first."""
        long = "_longer * (_base + 1)"
        return F.expr(f"IF({word} >= {long}, _longer + ({word} - {long}) div _base, {word} div (_base + 1))")

    begins = F.col("block") * F.col("_base") + F.least("block", "_longer")
    ends = begins + F.col("_base") + (F.col("block") < F.col("_longer")).cast("long")
    pieces = (
        placed.filter(F.col("_size") > 0)
        .withColumn("block", F.explode(F.sequence(block_of("_at"), block_of("(_at + _size - 1)"))))
        .select(
            "_id", "source_rank", "_at", "block", F.greatest(F.lit(0), begins - F.col("_at")).alias("first"),
            F.least(F.col("_at") + F.col("_size"), ends).alias("_end"), F.greatest(begins, F.col("_at")).alias("_from"), begins.alias("_begins"),
        )
    )
    slots = schedule(spark, targets, sizes)
    scheduled = (
        slots.join(pieces, ["source_rank", "block"])
        .withColumn("words", F.least(F.col("_end"), F.col("_begins") + F.col("most")) - F.col("_from"))
        .filter("words > 0")
    )
    # A document with words is known by its source and place in it, a copy by its epoch.
    of_copy = lambda e, c: F.when(F.col("epoch") == e, F.col(c))
    stands = F.struct("slot", (F.col("_from") - F.col("_begins")).alias("place"))
    scheduled = scheduled.withColumn("_stands", stands)
    first = [F.min(of_copy(e, "_stands")) for e in range(MOST_TIMES)]
    copies = [
        F.struct(first[e]["slot"].alias("slot"), first[e]["place"].alias("place"), F.sum(of_copy(e, "words")).alias("words")) for e in range(MOST_TIMES)
    ]
    taken = scheduled.groupBy(F.col("source_rank").alias("_r"), F.col("_at").alias("_a")).agg(
        F.sum("words").alias("_taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("_slots"),
        F.filter(F.array(*copies), lambda c: c["slot"].isNotNull()).alias("copies"),
    )
    mixed = placed.join(
        taken, (placed["source_rank"] == taken["_r"]) & (placed["_at"] == taken["_a"]) & (placed["_size"] > 0), "left"
    ).select(
        F.col("_id").alias(id_column), *([F.col("_row").alias(row)] if row else []), F.col("_size").alias("size"), "source_size", "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"), "first_slot", F.coalesce("_slots", F.lit(0)).cast("long").alias("slots"), "copies",
    )
    return mixed, scheduled.select("slot", "epoch", F.col("_id").alias(id_column), "first", "words")


def take_texts(df: DataFrame, mixed: DataFrame, row: str, text: str) -> DataFrame:
    """``df`` as mixed, in the order of the schedule, without ``row``, the key of single rows.

    A document comes as often as it is taken, each time at its first slot of that
    epoch and with the words taken there: all of them, the last time perhaps fewer.
    """
    wanted = mixed.filter(F.col("taken") > 0).select(row, F.col("size").alias("_size"), F.explode("copies").alias("_copy"))
    joined = df.join(wanted, row).drop(row)
    schema = df.drop(row).schema
    place, at = schema.names.index(text), len(schema.names)
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def first_words(t: str, n: int) -> str:
        return t[: next(islice(word.finditer(t), n - 1, None)).end()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, (size, taken) = batch.column(place), [batch.column(at + i).to_pylist() for i in (0, 1)]
            texts = [t if n >= m else first_words(t, n) for t, n, m in zip(column.to_pylist(), taken, size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, column.type) if i == place else batch.column(i) for i in range(at)], schema.names
            )

    listed = joined.select(*schema.names, "_size", F.col("_copy.words").alias("_words"), F.col("_copy.slot").alias("_slot"), F.col("_copy.place").alias("_place"))
    ordered = listed.repartitionByRange("_slot", "_place").sortWithinPartitions("_slot", "_place")
    return ordered.drop("_slot", "_place").mapInArrow(run, schema)

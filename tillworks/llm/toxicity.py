"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models of order ``ORDER`` are counted from the labelled training rows, one
of toxic and one of ordinary documents; only the rows of the calibration, a
quarter of up to 3,000 and a shrinking share of more, are not counted.  Each subtracts a discount from its own
counts and gives the mass to one lower-order Kneser-Ney model of continuation
counts that both classes share, so that rare expressions are told apart only as
far as the classes' own counts do.  The log-likelihood ratio of an n-gram is
therefore decided by its own and its context's counts, and where a class has
seen neither, the shared part cancels.  A word's ratio is the sum over its
characters; a document is described by length-normalised ratios (of the whole
text and of its most telling words), which a logistic model turns into a score.

The ratios are a Spark table of every n-gram counted.  While it has at most
``HELD_GRAMS`` rows, which is counted first, tasks hold it and rate the words of
their own rows; a larger one is joined with the n-grams of all distinct words,
and the rated words with the rows.  Both ways rate every word by every n-gram.

Cases: a null or empty text has no words and gets the score of zero ratios;
without labels of both classes every score is the share of toxic labels;
repeated labels of an id count as toxic if one is; ties need no order; an empty
table of documents gives no scores, without labels it is the share 0.5.  Long
words cost their length once.  Ids and other columns never pass through Python.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import materialize, release

ORDER = 5
DISCOUNT = 0.75
# The logistic model is fitted on about this many labelled rows, kept out of the counts.
CALIBRATION_ROWS = 3000
FLUSH = 200_000
# Ratios that a task holds at most, about 50 bytes each; more are joined.
HELD_GRAMS = 1_000_000
# So many words' ratios are held by a task in the joined way; those of all others are joined.
FREQUENT = 50_000
WORD = re.compile(r"[^\W\d_]+")


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of padded words in one array, and where each word's windows start."""
    joined = "".join(" " * (ORDER - 1) + w + "\n" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.array([len(w) + ORDER for w in words], np.int64)
    return codes, np.cumsum(sizes) - sizes


def _live(codes: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows of ``width`` that lie within one word: no end before their last place."""
    view = np.lib.stride_tricks.sliding_window_view(codes, width)
    return np.flatnonzero((view[:, :-1] != 10).all(1))


def gram_counts(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of weighted words with their counts."""
    names = list(words)
    codes, starts = _codes(names)
    live = _live(codes, ORDER)
    weight = np.array([words[w] for w in names], np.int64)[np.searchsorted(starts, live, "right") - 1]
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, ORDER)[live]).view(f"<U{ORDER}").ravel()
    distinct, at = np.unique(grams, return_inverse=True)
    return distinct, np.bincount(at, weight, len(distinct)).astype(np.int64)


def count_grams(df: DataFrame, text: str, label: str) -> DataFrame:
    """``g, n0, n1``: how often each n-gram stands in ordinary and in toxic rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())

        def flush():
            for c in (0, 1):
                if seen[c]:
                    g, n = gram_counts(seen[c])
                    yield pd.DataFrame({"g": g.astype(object), "n0": n * (c == 0), "n1": n * (c == 1)})
                    seen[c].clear()

        for rows in batches:
            for t, y in zip(rows["t"], rows["y"], strict=True):
                if t:
                    seen[int(y)].update(WORD.findall(t.lower()))
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield from flush()
        yield from flush()

    rows = df.select(F.col(text).alias("t"), F.col(label).cast("int").alias("y"))
    local = rows.mapInPandas(run, "g string, n0 long, n1 long")
    return local.groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def shared_model(grams: DataFrame) -> DataFrame:
    """``g, p``: Kneser-Ney probabilities of order ``ORDER - 1`` from continuation counts."""
    tables = []
    table = grams.select("g")
    for k in range(ORDER - 1, 0, -1):
        table = table.groupBy(F.substring("g", 2, k).alias("g")).agg(F.count(F.lit(1)).alias("n"))
        tables.append(table)
    model = None
    for k, t in enumerate(reversed(tables), start=1):
        head = F.substring("g", 1, k - 1)
        sums = t.groupBy(head.alias("h")).agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("d"))
        own = t.withColumn("h", head).join(sums, "h")
        if model is None:
            # Below one character: every character seen is as likely.
            model = own.select("g", ((F.col("n") - DISCOUNT) / F.col("s") + DISCOUNT / F.col("s")).alias("p"))
            continue
        lower = model.select(F.col("g").alias("low"), F.col("p").alias("q"))
        model = own.join(lower, F.substring("g", 2, k - 1) == F.col("low")).select(
            "g", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("d") * F.col("q")) / F.col("s")).alias("p")
        )
    return model


def ratios(grams: DataFrame) -> DataFrame:
    """``g, r``: log-likelihood ratios of n-grams, and of contexts with an unseen end (shorter by one)."""
    head = F.substring("g", 1, ORDER - 1)
    heads = grams.groupBy(head.alias("h")).agg(
        F.sum("n0").alias("s0"), F.sum("n1").alias("s1"),
        F.count_if(F.col("n0") > 0).alias("d0"), F.count_if(F.col("n1") > 0).alias("d1"),
    )

    def share(c: int):
        """The mass a class leaves to the shared model in this context."""
        return F.when(F.col(f"s{c}") > 0, DISCOUNT * F.col(f"d{c}") / F.col(f"s{c}")).otherwise(1.0)

    def prob(c: int):
        own = F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0))
        return F.when(F.col(f"s{c}") > 0, own / F.col(f"s{c}")).otherwise(0.0) + share(c) * F.col("p")

    model = shared_model(grams).withColumnRenamed("g", "low")
    seen = (
        grams.withColumn("h", head).join(heads, "h").join(model, F.substring("g", 2, ORDER - 1) == F.col("low"))
        .select("g", F.ln(prob(1) / prob(0)).alias("r"))
    )
    ends = heads.select(F.col("h").alias("g"), F.ln(share(1) / share(0)).alias("r"))
    return seen.unionByName(ends)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``word, n``: every distinct word of all rows and how often it stands there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush():
            if seen:
                yield pd.DataFrame({"word": np.array(list(seen), object), "n": list(seen.values())})
                seen.clear()

        for rows in batches:
            for t in rows["t"]:
                if t:
                    seen.update(WORD.findall(t.lower()))
            if len(seen) > FLUSH:
                yield from flush()
        yield from flush()

    local = df.select(F.col(text).alias("t")).mapInPandas(run, "word string, n long")
    return local.groupBy("word").agg(F.sum("n").alias("n"))


class HeldRatios:
    """Ratios of n-grams by their code points, looked up by a hash and compared in full."""

    def __init__(self, grams: list[str], ratio: np.ndarray):
        sizes = np.array([len(g) for g in grams], np.int64)
        self.tables = {}
        for width in (ORDER, ORDER - 1):
            at = np.flatnonzero(sizes == width)
            joined = "".join(grams[i] for i in at)
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, width)
            # The first seed under which no two n-grams of the table share a hash.
            seed = next(s for s in count() if len(np.unique(self._hash(codes, s))) == len(codes))
            order = np.argsort(self._hash(codes, seed))
            self.tables[width] = (seed, self._hash(codes, seed)[order], codes[order], ratio[at][order])

    @staticmethod
    def _hash(codes: np.ndarray, seed: int) -> np.ndarray:
        h = np.full(len(codes), np.uint64(seed))
        for i in range(codes.shape[1]):
            h = (h ^ (h >> np.uint64(31)) ^ codes[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of each n-gram, and whether the table has it."""
        seed, hashes, known, ratio = self.tables[codes.shape[1]]
        if not len(hashes):
            return np.zeros(len(codes)), np.zeros(len(codes), bool)
        h = self._hash(codes, seed)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        found = hashes[at] == h
        found[found] = (known[at[found]] == codes[found]).all(1)
        return ratio[at], found

    def rate(self, words: list[str]) -> np.ndarray:
        """The log-likelihood ratio of each word, over its characters and its end."""
        codes, starts = _codes(words)
        live = _live(codes, ORDER)
        # The windows of a long list are cut in pieces, for bounded memory.
        total, view = np.zeros(len(words)), np.lib.stride_tricks.sliding_window_view(codes, ORDER)
        for piece in np.array_split(live, len(live) // FLUSH + 1):
            windows = view[piece]
            own, has_own = self._find(windows)
            back, has_back = self._find(windows[:, :-1])
            value = np.where(has_own, own, np.where(has_back, back, 0.0))
            total += np.bincount(np.searchsorted(starts, piece, "right") - 1, value, len(words))
        return total


def word_ratios(words: DataFrame, table: DataFrame) -> DataFrame:
    """``word, n, r`` of the rows ``word, n, wid``, by joins with the whole table."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The number stands for the word: a copy of it in each window would be quadratic.
        for rows in batches:
            codes, starts = _codes(rows["word"].tolist())
            live = _live(codes, ORDER)
            view, wid = np.lib.stride_tricks.sliding_window_view(codes, ORDER), rows["wid"].to_numpy()
            for piece in np.array_split(live, len(live) // FLUSH + 1):
                grams = np.ascontiguousarray(view[piece]).view(f"<U{ORDER}").ravel()
                yield pd.DataFrame({"wid": wid[np.searchsorted(starts, piece, "right") - 1], "g": grams.astype(object)})

    grams = words.select("wid", "word").mapInPandas(cut, "wid long, g string")
    back = table.filter(F.char_length("g") == ORDER - 1).select(F.col("g").alias("h"), F.col("r").alias("back"))
    own = table.filter(F.char_length("g") == ORDER)
    # The same n-gram stands in many words: its ratio is looked up once.
    known = (
        grams.select("g").distinct().join(own, "g", "left").withColumn("h", F.substring("g", 1, ORDER - 1)).join(back, "h", "left")
        .select("g", F.coalesce("r", "back", F.lit(0.0)).alias("r"))
    )
    rated = grams.join(known, "g").groupBy("wid").agg(F.sum("r").alias("r"))
    return words.join(rated, "wid").select("word", "n", "r")


N_FEATURES = 5


def _row(total: float, size: int, most: float, top: list[float]) -> list[float]:
    """1, the ratio per character, and those of the most telling words."""
    if not size:
        return [1.0] + [0.0] * (N_FEATURES - 1)
    # Repeats of one word speak for themselves once in the maxima.
    top = sorted(sorted(set(top), reverse=True)[:3] + [0.0, 0.0], reverse=True)
    return [1.0, 10 * total / size, most, top[0], sum(top[:3]) / 3]


def _parts(words: Counter, ratio: dict) -> tuple[float, int, float | None, list[float], list[str]]:
    """Sum, size, maximum and best ratios of a row's words, and the words without a ratio."""
    total, size, most, top, rare = 0.0, 0, None, set(), []
    for w, n in words.items():
        size += n * (len(w) + 1)
        r = ratio.get(w)
        if r is None:
            rare.append(w)
        else:
            total += n * r
            top.add(r)
            most = r / (len(w) + 1) if most is None else max(most, r / (len(w) + 1))
    return total, size, most, sorted(top, reverse=True)[:3], rare


def features(df: DataFrame, table: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep`` and ``x``, the features of the text, for every row."""
    if table.count() > HELD_GRAMS:
        return _joined_features(df, table, keep, text)
    rows = table.toPandas()
    held = HeldRatios(rows["g"].tolist(), rows["r"].to_numpy(float))
    shared = df.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio: dict[str, float] = {}
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            counted = [Counter(WORD.findall(t.lower())) if t else Counter() for t in texts]
            fresh = list({w: None for words in counted for w in words if w not in ratio})
            if len(ratio) + len(fresh) > FLUSH:
                ratio.clear()
                fresh = list({w: None for words in counted for w in words})
            if fresh:
                ratio.update(zip(fresh, shared.value.rate(fresh).tolist(), strict=True))
            x = [_row(*_parts(words, ratio)[:4]) for words in counted]
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    source = df.select(*keep, F.col(text).alias("_t"))
    return source.mapInArrow(run, df.select(*keep).schema.add("x", T.ArrayType(T.DoubleType())))


def _joined_features(df: DataFrame, table: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The same by joins.

    Ratios of frequent words are sent to the tasks, at most ``FREQUENT`` of them;
    those of all other words are joined to the rows.
    """
    words = materialize(word_counts(df, text).withColumn("wid", F.monotonically_increasing_id()), "words")
    rated = materialize(word_ratios(words, table), "rated")
    release(words)
    sizes = dict(rated.groupBy(F.floor(F.log2("n")).alias("k")).count().collect())
    least, held = 64, 0
    while least > 1 and held + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        held += sizes.get(least, 0)
    frequent = F.floor(F.log2("n")) >= least
    known = rated.filter(frequent).select("word", "r").toPandas()
    shared = df.sparkSession.sparkContext.broadcast(dict(zip(known["word"], known["r"].tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            out = []
            for t in batch.column(len(kept)).to_pylist():
                words = Counter(WORD.findall(t.lower())) if t else Counter()
                parts = _parts(words, ratio)
                out.append((*parts, [words[w] for w in parts[4]]))
            found = [pa.array(values, kind) for values, (_, kind) in zip(zip(*out, strict=True), added, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], *found], [*kept, *[n for n, _ in added]])

    added = [
        ("_total", pa.float64()), ("_size", pa.int64()), ("_most", pa.float64()), ("_top", pa.list_(pa.float64())),
        ("_rare", pa.list_(pa.string())), ("_times", pa.list_(pa.int32())),
    ]
    kept = [*keep, "_row"]
    source = df.select(*keep, F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_t"))
    schema = T.StructType(source.schema.fields[:-1])
    held_parts = "_total double, _size long, _most double, _top array<double>, _rare array<string>, _times array<int>"
    schema = T.StructType([*schema.fields, *T.StructType.fromDDL(held_parts).fields])
    parts = materialize(source.mapInArrow(run, schema), "parts")
    rest = (
        parts.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("w"))
        .select("_row", F.col("w._rare").alias("word"), F.col("w._times").alias("times"))
        .join(rated.filter(~frequent).select("word", "r"), "word")
        .groupBy("_row").agg(
            F.sum(F.col("times") * F.col("r")).alias("_total2"), F.max(F.col("r") / (F.char_length("word") + 1)).alias("_most2"),
            F.slice(F.sort_array(F.collect_set("r"), False), 1, 3).alias("_top2"),
        )
    )
    both = parts.drop("_rare", "_times").join(rest, "_row", "left").select(
        *keep, (F.col("_total") + F.coalesce("_total2", F.lit(0.0))).alias("_total"), "_size", F.greatest("_most", "_most2").alias("_most"),
        F.concat("_top", F.coalesce("_top2", F.array().cast("array<double>"))).alias("_top"),
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = len(keep)
            x = [_row(*v) for v in zip(*(batch.column(at + i).to_pylist() for i in range(4)), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(at)], pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return both.mapInArrow(finish, df.select(*keep).schema.add("x", T.ArrayType(T.DoubleType())))


def train(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str):
    """Count both classes and fit the logistic model; ``docs`` and ``labels`` are training rows only."""
    marked = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(F.max(label).alias("_y"))
    sizes = {r[0]: r[1] for r in marked.groupBy("_y").count().collect()}
    n, toxic = sum(sizes.values()), sizes.get(1, 0)
    share = (toxic + 0.5) / (n + 1)
    if not toxic or toxic == n:
        return None, np.array([np.log(share / (1 - share))] + [0.0] * (N_FEATURES - 1))
    draw = F.pmod(F.xxhash64(F.lit("toxic"), F.col(id_column)), F.lit(1 << 30)) / float(1 << 30)
    apart = draw < min(0.25, CALIBRATION_ROWS / n)
    rows = docs.filter(F.col(text).isNotNull()).select(id_column, F.col(text).alias("_t"))
    # Labels grow with the documents: both sides are shuffled at every size.
    counted = rows.filter(~apart).join(marked.filter(~apart).hint("merge"), id_column)
    grams = materialize(count_grams(counted, "_t", "_y"), "grams")
    table = materialize(ratios(grams), "ratios")
    release(grams)
    sample = features(rows.filter(apart).join(marked.filter(apart), id_column), table, ["_y"], "_t").toPandas()
    weights = np.array([np.log(share / (1 - share))] + [0.0] * (N_FEATURES - 1))
    if sample["_y"].nunique() == 2:
        x, y = np.array(sample["x"].tolist()), sample["_y"].to_numpy(float)
        order = np.lexsort(x.T)
        x, y = x[order], y[order]
        ridge = np.diag([1e-3] + [0.3] * (N_FEATURES - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            h = x.T @ (x * (p * (1 - p))[:, None]) + ridge
            weights = weights + np.linalg.solve(h + 1e-6 * np.eye(N_FEATURES), x.T @ (y - p) - ridge @ weights)
    return table, weights


def score(df: DataFrame, model, id_column: str, text: str, keep: list[str], threshold: float = 0.7) -> DataFrame:
    """``id`` (with ``keep``), ``score`` and ``predicted`` for every row."""
    table, weights = model
    kept = [id_column, *keep]
    if table is None:
        described = df.select(*kept, F.array(*[F.lit(float(i == 0)) for i in range(N_FEATURES)]).alias("x"))
    else:
        described = features(df, table, kept, text)
    terms = [F.element_at("x", i + 1) * float(w) for i, w in enumerate(weights)]
    logit = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), reduce(lambda a, b: a + b, terms)))
    scored = described.select(*kept, (1 / (1 + F.exp(-logit))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

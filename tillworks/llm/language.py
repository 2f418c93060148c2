"""Language identification by string kernels.

A text is the set of its character n-grams of one to three letters (a blended
spectrum, presence only), hashed to ``DIMS`` positions.  The kernel of two
texts is the cosine of their sets.  A bounded, documented sample of labelled
rows gives Nyström landmarks; one-versus-rest kernel ridge regression on the
landmark features gives a weight per landmark and language.  Scoring is two
matrix products per batch: presence by landmarks, then landmarks by languages.

Cases: a null text or one without a letter is ``und`` with score 0; with no
labelled rows everything is ``und``; very long texts keep a set of bounded size;
ties go to the first language by code point; repeated rows are judged alike; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import beside

DIMS = 1 << 14
LANDMARKS = 192
# The classifier is fitted on about this many labelled rows for each language.
SAMPLE_PER_LANG = 600
MAX_LANGS = 500
RIDGE = 1e-2
ROWS = 64
LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def presence(text: str) -> np.ndarray:
    """Hashed positions of the n-grams of ``text`` (may repeat); letters only, spaces between words."""
    plain = " " + OTHER.sub(" ", text.lower()) + " "
    c = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    two = (c[:-1] << np.uint64(21)) + c[1:]
    three = two[:-1] * np.uint64(0x100000001B3) + c[2:]
    grams = np.concatenate([c, two, three])
    return ((grams * _MIX) >> np.uint64(50)).astype(np.int64)


def _matrix(texts: list[str]) -> np.ndarray:
    """Rows of unit length, one per text."""
    x = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, t in enumerate(texts):
        x[i, presence(t)] = 1
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def fit(sets: list[np.ndarray], langs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, landmark rows, and weights (landmarks x languages)."""
    names = sorted(set(langs))
    x = np.zeros((len(sets), DIMS), dtype=np.float32)
    for i, s in enumerate(sets):
        x[i, s] = 1
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    # Landmarks take turns over the languages so that each has its own.
    turn = sorted(range(len(langs)), key=lambda i: (sum(l == langs[i] for l in langs[:i]), langs[i]))
    marks = x[turn[:LANDMARKS]]
    k_mm, k_nm = (marks @ marks.T).astype(np.float64), (x @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(k_mm)
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    phi = np.hstack([k_nm @ root, np.ones((len(sets), 1))])
    y = np.array([[1.0 if l == n else -1.0 for n in names] for l in langs])
    share = np.array([1.0 / (langs.count(l) * len(names)) for l in langs]) * len(langs)
    beta = np.linalg.solve(phi.T @ (phi * share[:, None]) + RIDGE * np.eye(phi.shape[1]), phi.T @ (y * share[:, None]))
    return names, marks, np.vstack([root @ beta[:-1], beta[-1:]])


def train(df: DataFrame, id_column: str, text: str, lang: str) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Fit on labelled rows; which are taken depends on a hash of id and text, and their number is bounded."""
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    if not counts:
        return None
    if len(counts) > MAX_LANGS:
        raise ValueError(f"{len(counts)} languages; at most {MAX_LANGS} are expected")
    wanted = F.lit(0.0)
    for name, n in sorted(counts.items()):
        wanted = F.when(F.col(lang) == name, F.lit(min(1.0, SAMPLE_PER_LANG / n))).otherwise(wanted)
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col(id_column), F.col(text)), F.lit(1 << 30)) / float(1 << 30)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows[[bool(LETTER.search(t)) for t in rows["t"]]]
            packed = [np.unique(presence(t)).astype("<u2").tobytes() for t in rows["t"]]
            yield pd.DataFrame({"k": rows["k"], "l": rows["l"], "s": packed})

    rows = (
        labelled.filter(draw < wanted)
        .select(F.xxhash64(F.lit("order"), F.col(id_column), F.col(text)).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t"))
        .mapInPandas(sets, "k long, l string, s binary")
        .sort("k", "l", "s")
        .limit(2 * SAMPLE_PER_LANG * len(counts))
        .toPandas()
    )
    if rows.empty:
        return None
    return fit([np.frombuffer(s, "<u2").astype(np.int64) for s in rows["s"]], rows["l"].tolist())


def predict(df: DataFrame, model, id_column: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """``id`` (with ``keep``), ``lang_pred`` and ``score`` for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        model = shared.value
        lang, best = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
        live = [i for i, t in enumerate(texts) if model and t and LETTER.search(t)]
        for at in range(0, len(live), ROWS):
            part = live[at : at + ROWS]
            names, marks, weights = model
            k = _matrix([texts[i] for i in part]) @ marks.T
            s = 4 * (k @ weights[:-1] + weights[-1])
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            top = p.argmax(1)
            lang[part], best[part] = np.array(names, dtype=object)[top], p[np.arange(len(part)), top]
        return lang, best

    return beside(df, [id_column, *(keep or [])], [F.col(text)], "lang_pred string, score double", lambda: score)

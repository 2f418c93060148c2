"""Packing documents into training sequences along a space-filling curve.

A document's token ids are counted into a hashed, signed vector, projected to
``AXES`` dimensions and placed on a Hilbert curve.  Documents are range-sorted
by their place on it, and the stream of their tokens is cut every ``LENGTH``
tokens, so that neighbours on the curve share sequences and only the very last
sequence needs padding.  Token ids pass through one shuffle and are written
twice (as found, and in order), since places in the stream follow from the
totals of all partitions.

Cases: a null text is an empty one and still holds the end id; copies share a
place on the curve and are kept apart by id; long documents go on in the next
sequence; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.common import beside, running_total
from tillworks.session import materialize

LENGTH = 2048
END_ID = 1
AXES, CURVE_BITS, DIMS = 3, 16, 64
SPECIAL = "<|endoftext|>"
# Characters on whose classes the two libraries' Unicode tables agree; runs of
# white space beyond this length go to the plain path as well.
_UNSURE = re.compile(
    r"[^\x00-\u04ff\u2000-\u206f\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]|\s{1000}|" + re.escape(SPECIAL)
)
_loaded: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of whole texts, as ``tokenizers`` gives them.

    Where the ranks of the same byte-pair vocabulary lie beside the file (ending
    ``.tiktoken``), texts of well-known characters are encoded with them, which
    gives the same ids in a fraction of the time; all other texts, and all texts
    where there are no ranks, go through ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.ranked:
            return self.whole(texts)
        sure = [not _UNSURE.search(t) for t in texts]
        rest = iter(self.whole([t for t, s in zip(texts, sure, strict=True) if not s]))
        return [np.array(self.ranked.encode_ordinary(t), "<u2") if s else next(rest) for t, s in zip(texts, sure, strict=True)]


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with integer axes below ``2 ** bits``."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_places(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents: hashed vectors, projected, spread over the axes' range."""
    vectors = np.zeros((len(ids), DIMS))
    for i, a in enumerate(ids):
        h = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        vectors[i] = np.bincount((h >> np.uint64(58)).astype(np.int64), sign, DIMS)
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-12)
    projection = np.random.default_rng(11).standard_normal((DIMS, AXES))
    spread = (np.tanh(vectors @ projection) + 1) / 2
    return hilbert_keys(np.minimum((spread * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1), CURVE_BITS)


def tokenize(df: DataFrame, id_column: str, text: str, vocabulary: str) -> DataFrame:
    """``id``, ``ids`` (two bytes each, little-endian), ``n_tokens``, ``place`` on the curve and ``_row``, a number of the row's own."""

    def start():
        encode, end = encoder(vocabulary).encode, np.array([END_ID], "<u2")
        row = count(TaskContext.get().partitionId() << 40)

        def run(texts: list[str]) -> tuple:
            ids = [np.append(x, end) for x in encode(texts)]
            return [x.tobytes() for x in ids], [len(x) for x in ids], curve_places(ids), [next(row) for _ in ids]

        return run

    return beside(df, [id_column], [F.coalesce(F.col(text), F.lit(""))], "ids binary, n_tokens long, place long, _row long", start)


def pack(df: DataFrame, id_column: str, text: str, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences: ``id, start, length, ids`` (four bytes each,
    little-endian), ``doc_tokens, sequence_id, offset``; sort by the last two to write sequences."""
    tokens = materialize(tokenize(df, id_column, text, vocabulary), "tokens")
    along = running_total(tokens.drop("ids"), ["place", id_column, "n_tokens", "_row"], "n_tokens", "_before")
    placed = tokens.select(id_column, "ids", "_row").join(along.select("_row", "_before"), "_row")
    added = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    fields = T.StructType.fromDDL(added).fields

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, source = [], []
            for row, (raw, before) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    sequence, offset = divmod(before + at, length)
                    n = min(length - offset, len(ids) - at)
                    out.append((at, n, ids[at : at + n].tobytes(), len(ids), sequence, offset))
                    source.append(row)
                    at += n
            columns = zip(*out, strict=True) if out else [[]] * len(fields)
            made = [pa.array(c, pa.binary() if f.name == "ids" else pa.int64()) for c, f in zip(columns, fields, strict=True)]
            # A piece has the id of its row, as it came.
            key = batch.column(0).take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([key, *made], [id_column, *[f.name for f in fields]])

    schema = T.StructType([tokens.schema[id_column], *fields])
    return placed.select(id_column, "ids", "_before").mapInArrow(cut, schema)

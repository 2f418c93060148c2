"""Vector codes: the search and every column against brute force, and the defined cases."""

import hashlib
import random

import numpy as np
import pytest

from tillworks.llm import queries, vector_codes
from tillworks.llm.common import settings as session_settings

SCHEMA = "vec_id long, embedding array<float>, label int, code_ string, _x int"
NAMES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def brute(rows):
    """The contract in plain Python: every entry is looked at."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // 16
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:64]] for p in range(16)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min(range(len(books[p])), key=lambda k: (dist(cut(v, p), books[p][k]), k))
    for _ in range(2):
        members = {}
        for _, v, _ in kept:
            for p in range(16):
                members.setdefault((p, near(v, p)), []).append(cut(v, p))
        books = [[[sum(c) // len(c) for c in zip(*members[p, k], strict=True)] if (p, k) in members else books[p][k] for k in range(len(books[p]))] for p in range(16)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, lab in kept:
        picks = [near(v, p) for p in range(16)]
        error = sum(dist(cut(v, p), books[p][k]) for p, k in enumerate(picks))
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{k:02x}" for k in picks), error, lab))
    return [(i, c, e, by_label[lab], digest) for i, c, e, lab in out]


def vectors(n, seed=1, dims=32):
    draw = random.Random(seed)
    rows = [(i, [draw.choice([-0.5, -1 / 256, 0.0, 0.25, draw.gauss(0, 0.4)]) for _ in range(dims)], draw.choice([None, 1, 1, 2])) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * dims, 1), (-5, [float("nan")] * dims, 2), (-6, [float("inf")] + [0.0] * (dims - 1), 2)]
    rows += [rows[3], rows[3], (3, rows[4][1], None), (None, rows[5][1], 1), (None, rows[5][1], 1), (2**60 + 1, rows[6][1], 1), (2**60 + 3, rows[7][1], 1)]
    draw.shuffle(rows)
    # What a float column holds.
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], lab) for i, v, lab in rows]


def table_at(spark, path, rows):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("n", [0, 1, 20, 300])
def test_query_by_brute_force(spark, tmp_path, n):
    few = {0: [(1, None, 1), (2, [None], None)], 1: [(4, [0.25] * 32, None)]}
    rows = few[n] if n in few else vectors(n)
    table_at(spark, tmp_path, rows)
    found = queries.op12_vector_codes(spark, str(tmp_path)).select(*NAMES).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_sql_gives_the_same_rows():
    duckdb = pytest.importorskip("duckdb")
    rows = [r for r in vectors(90) if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    found = con.sql(f"SELECT {', '.join(NAMES)} FROM ({vector_codes.codes_sql()})").fetchall()
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("spread", [1, 3, 40, 10**7])
def test_search_finds_the_nearest_with_ties_to_the_lower_index(spread):
    draw = np.random.default_rng(spread)
    books = draw.integers(-spread, spread + 1, (5, 30, 3))
    books[:, 7] = books[:, 21]
    x = np.concatenate([draw.integers(-spread, spread + 1, (400, 5, 3)), books.transpose(1, 0, 2)])
    all_of_them = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
    index, distance = vector_codes.EqualAverage(books).nearest(x)
    assert (index == all_of_them.argmin(2)).all() and (distance == all_of_them.min(2)).all()


def test_odd_lengths_large_components_and_empty_tables(spark):
    session_settings(spark)
    make = lambda rows: spark.createDataFrame(rows, "k string, v array<double>")
    codes, books = vector_codes.compress(make([]), "k", "v")
    assert codes.collect() == [] and books.size == 0
    odd = [("a", [1.0] * 32), ("b", [2.0] * 32), ("c", [1.0] * 16), ("d", [])]
    found = {r["k"]: (r["code"], r["error"]) for r in vector_codes.compress(make(odd), "k", "v")[0].collect()}
    assert found == {"a": ("00" * 16, 0), "b": ("01" * 16, 0), "c": (None, None), "d": (None, None)}
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(make([("a", [1.0] * 5)]), "k", "v")
    with pytest.raises(Exception, match="would not fit"):
        vector_codes.compress(make([("a", [1e12] * 16)]), "k", "v")[0].collect()

"""Toxicity: the Kneser-Ney ratios and the registered query against plain Python, long words, ids."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillworks.llm import queries, toxicity
from tillworks.llm.common import settings as session_settings

N, D = toxicity.ORDER, toxicity.DISCOUNT


def windows(word):
    padded = " " * (N - 1) + word + "\n"
    return [padded[i : i + N] for i in range(len(word) + 1)]


def kneser_ney(texts):
    """The ratio of every n-gram and of every context with an unseen end, straight from the definition."""
    own = [Counter(), Counter()]
    for text, y in texts:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            own[y].update(windows(word))
    grams = set(own[0]) | set(own[1])
    # Continuation counts: by how many characters an n-gram of each lower order is preceded.
    tables, level = {}, grams
    for k in range(N - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in level)
        level = set(tables[k])

    def shared(g):
        t = tables[len(g)]
        same = [x for x in t if x[:-1] == g[:-1]]
        total = sum(t[x] for x in same)
        if len(g) == 1:
            return t[g] / total
        return (t[g] - D + D * len(same) * shared(g[1:])) / total

    by_head = [defaultdict(list), defaultdict(list)]
    for y in (0, 1):
        for g, n in own[y].items():
            by_head[y][g[:-1]].append(n)
    left = lambda y, h: D * len(by_head[y][h]) / sum(by_head[y][h]) if by_head[y][h] else 1.0

    def prob(y, g):
        seen = by_head[y][g[:-1]]
        return (max(own[y][g] - D, 0) / sum(seen) if seen else 0.0) + left(y, g[:-1]) * shared(g[1:])

    found = {g: math.log(prob(1, g) / prob(0, g)) for g in grams}
    return found | {h: math.log(left(1, h) / left(0, h)) for h in {g[:-1] for g in grams}}


def test_ratios_are_kneser_neys(spark):
    session_settings(spark)
    draw = random.Random(8)
    texts = [(" ".join("".join(draw.choice("abcé") for _ in range(draw.randrange(1, 7))) for _ in range(9)), draw.randrange(2)) for _ in range(40)]
    docs = spark.createDataFrame(texts, "t string, y int").repartition(3)
    got = {r["g"]: r["r"] for r in toxicity.ratios(toxicity.count_grams(docs, "t", "y")).collect()}
    want = kneser_ney(texts)
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_query_columns(spark, tmp_path):
    draw = random.Random(5)
    bad, good = ["vilqon", "grubzak", "trofil"], ["melora", "pasila", "tunaro", "vesilo"]
    ids = [2**60 + 1, 2**60 + 3, None, *range(900)]
    rows = []
    for i in ids:
        toxic = draw.random() < 0.4
        words = [draw.choice(good) for _ in range(12)] + ([draw.choice(bad) for _ in range(3)] if toxic else [])
        draw.shuffle(words)
        rows.append((i, "" if i == 5 else None if i == 6 else " ".join(words), int(toxic)))
    schema = "doc_id long, text string, x string, score_ int"
    spark.createDataFrame([(i, t, "a", 1) for i, t, _ in rows], schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op7_toxicity(spark, str(tmp_path)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    assert sorted((str(r["doc_id"]), r["held_out"]) for r in found) == sorted((str(i), held(i)) for i, _, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    label = {i: y for i, t, y in rows if t}
    right = [r["predicted"] == label[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] in label]
    assert len(right) > 200 and np.mean(right) > 0.97


@pytest.mark.parametrize("held", [10**6, 0])
def test_long_words_cost_their_length_once(spark, monkeypatch, held):
    session_settings(spark)
    monkeypatch.setattr(toxicity, "HELD_GRAMS", held)
    docs = spark.createDataFrame([(1, "abc" * 300_000), (2, "abc")], "doc_id long, text string")
    table = spark.createDataFrame([("abcab", 1.0), ("bcabc", 0.5), ("    a", 0.25)], "g string, r double")
    began = time.time()
    found = {r["doc_id"]: r["x"] for r in toxicity.features(docs, table, ["doc_id"], "text").collect()}
    assert time.time() - began < 60
    assert found[1][1] == pytest.approx(10 * (0.25 + 299_999 * 1.5) / 900_001, rel=1e-6)
    assert found[2][1] == pytest.approx(10 * 0.25 / 4)

"""The n-gram join: guests and small groups, ids, shared ids, folders."""

import random
import re

import numpy as np

from tillworks import session
from tillworks.llm import ngram_join, queries
from tillworks.llm.common import settings as session_settings


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """Size of the set and least id of the component, by comparing every two texts."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(sets[i]), least.get(find(i), key) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def corpus(seed, groups=14):
    """Chains and stars of edits of several lengths, copies, passages that many texts share, and short texts."""
    draw, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for _ in range(groups):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([3, 12, 40, 70, 300]))]
        for _ in range(draw.choice([1, 2, 3, 25])):
            rows.append(" ".join(words))
            if draw.random() < 0.3:
                rows.append(" ".join(words))
            for _ in range(draw.choice([1, 1, 2, 6])):
                words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
            if draw.random() < 0.2:
                words = words + passage
            if draw.random() < 0.3:
                words = words[: -max(1, len(words) // 8)] or words
    rows += [None, "", "  ", "one", "One", "a b c d", "a b c d e"]
    draw.shuffle(rows)
    return rows


def same(got, want):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_by_brute_force_with_large_ids_beside_nulls(spark, tmp_path):
    texts = corpus(1)
    ids = [2**60 + 2 * i + 1 for i in range(len(texts))]
    rows = list(zip(ids, texts, strict=True)) + [(None, texts[0]), (None, "alone without an id but with enough words"), (None, None)]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op2_ngram_join(spark, str(tmp_path)).select("doc_id", "n_shingles", "component_id").collect()
    # A row without an id counts in no minimum; it takes that of its copies.
    same(found, expected(rows))


def test_several_forests_and_bands(spark, monkeypatch):
    session_settings(spark)
    monkeypatch.setattr(ngram_join, "FEW", 1)
    for seed in (2, 3):
        rows = list(enumerate(corpus(seed)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        same(ngram_join.near_duplicates(docs).collect(), expected(rows))


def test_texts_under_one_id_keep_their_own_links(spark):
    session_settings(spark)
    base = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (1, " ".join(other)), (2, " ".join(base[:-2])), (3, " ".join(other[:-2])), (4, " ".join(base[:-4] + other[:20]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(ngram_join.near_duplicates(docs).collect(), expected(rows))


def test_bitmaps_of_several_sizes_bound_the_overlap():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 2**63, size).astype(np.uint64)) for size in (5, 200, 260, 270, 900, 1100)]
    sets += [np.unique(np.r_[s[: int(0.9 * len(s))], draw.integers(0, 2**63, len(s) // 20 + 1).astype(np.uint64)]) for s in sets]
    bits, n = [ngram_join._bitmap(s) for s in sets], np.array([len(s) for s in sets])
    i, j = np.triu_indices(len(sets), 1)
    keep, _ = ngram_join._likely(bits, n, i, j)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    links = 5 * both >= 4 * (n[i] + n[j] - both)
    assert links.sum() >= 5 and (keep | ~links).all()


def test_no_folder_but_the_result_is_left(spark, tmp_path):
    session_settings(spark)
    owned = []
    with session.scratch(spark, delete=False) as owned:
        done = ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(corpus(5, 6))), "doc_id long, text string"))
    files = lambda path: spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [p for p in owned if files(p).exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    assert there == [] and done.count() > 0
    assert files(done._written_to).exists(spark._jvm.org.apache.hadoop.fs.Path(done._written_to))

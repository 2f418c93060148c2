"""Ids beyond 2^53 beside nulls, shared ids and no ids at all, through the registered queries and the stages."""

import random

import pytest

import corpus_pipeline
from tillworks.llm import common, mixing, queries
from tillworks.llm.common import settings as session_settings

BIG = [2**60 + 1, 2**60 + 3, -(2**62) - 1]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, _0 string, score_ int"


def rows(ids):
    draw = random.Random(1)
    words = [f"w{i}x" for i in range(300)] + ["die", "the", "les"]
    out = []
    for n, i in enumerate(ids):
        text = None if n == 4 else "" if n == 5 else " ".join(draw.choice(words) for _ in range(60 + n)) + " mail a.b@example.org now"
        out.append((i, text, draw.choice(["en", "de", None]), draw.choice(["s", "t", None]), len(text or ""), "x", "y", 3))
    return out


CASES = {
    "large beside null": [*BIG, None, *range(20), None],
    "shared": [7] * 8 + BIG + [7] * 8,
    "none": [None] * 18,
}


@pytest.fixture(params=CASES, ids=list(CASES))
def folder(request, spark, tmp_path):
    # One file and one batch: nulls and large ids stand side by side.
    spark.createDataFrame(rows(CASES[request.param]), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, n % 2) for n, i in enumerate(CASES[request.param])]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), sorted(CASES[request.param], key=lambda i: (i is None, i or 0))


@pytest.mark.parametrize("name", ["op2_ngram_join", "op4_language", "op6_mixing", "op7_toxicity", "op8_pii", "op9_quality", "op10_syncmers", "op11_fill_middle"])
def test_a_row_for_every_row_under_its_own_id(spark, folder, name):
    path, ids = folder
    found = queries.QUERIES[name](spark, path).select("doc_id").collect()
    assert sorted((r[0] for r in found), key=lambda i: (i is None, i or 0)) == ids


def test_packed_ids(spark, folder):
    path, ids = folder
    found = queries.op1_packing(spark, path).filter("start = 0").select("doc_id").collect()
    assert sorted((r[0] for r in found), key=lambda i: (i is None, i or 0)) == ids


def test_language_is_learned_without_ids(spark, tmp_path):
    spark.createDataFrame(rows([None] * 60), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert "en" in {r.lang_pred for r in queries.op4_language(spark, str(tmp_path)).collect()}


def test_stages_keep_ids(spark):
    session_settings(spark)
    for ids in CASES.values():
        docs = spark.createDataFrame(rows(ids), SCHEMA).drop("start", "_0", "score_").coalesce(1)
        known = set(ids)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, "").collect()
            assert {r.doc_id for r in kept} <= known, name
            if name in ("private", "near_duplicates"):
                assert {r.doc_id for r in kept} == known


def test_mix_stands_in_schedule_order_and_every_prefix_is_mixed(spark):
    session_settings(spark)
    draw = random.Random(3)
    docs = spark.createDataFrame(
        [(i, " ".join(f"d{i}w{k}" for k in range(draw.randrange(1, 90))), draw.choice(["a", "a", "a", "b", "c"])) for i in range(400)], "doc_id long, text string, source string"
    )
    rows_ = docs.withColumn("_row", docs["doc_id"])
    mixed, scheduled = mixing.mix(rows_, row="_row")
    by_source = {r.doc_id: r.source for r in docs.collect()}
    first = {}
    for r in scheduled.collect():
        first[r.slot] = by_source[r.doc_id]
    order = [first[s] for s in sorted(first)]
    total = {s: order.count(s) for s in set(order)}
    assert set(first) == set(range(len(order)))
    bound = len(order).bit_length() + 1
    for n in range(1, len(order) + 1, 7):
        for s in total:
            assert abs(order[:n].count(s) - n * total[s] / len(order)) <= bound
    want = []
    for r in mixed.collect():
        assert (r.first_slot is None) == (r.taken == 0) and sum(c.words for c in r.copies or []) == r.taken
        want += [(c.slot, c.place, r.doc_id, c.words) for c in r.copies or []]
    taken = mixing.take_texts(rows_, mixed, "_row", "text").collect()
    assert [(r.doc_id, len(r.text.split())) for r in taken] == [(i, n) for *_, i, n in sorted(want)]


def test_beside_refuses_a_name_that_is_there(spark):
    with pytest.raises(ValueError, match="x"):
        common.beside(spark.createDataFrame([(1, 2)], "x int, y int"), ["x"], [], "x long", lambda: None)

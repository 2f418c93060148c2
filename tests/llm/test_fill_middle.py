"""The fill-in-the-middle transformation: the skip list, every column by brute force, the exact round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillworks.llm import fill_middle, queries
from tillworks.llm.common import settings as session_settings

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DIGEST = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, digest = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc_id, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def cases():
    draw = random.Random(3)
    texts = [None, "", " ", "\t\n", "a", " a", "a ", "<P>", "x <S> y", "a < P> <M", "<", "   \x1c", "é\U0001f600 z\n", "b" * 50000, "w " * 30000]
    texts += ["".join(draw.choice("ab \n<PSM>é\U0001f600") for _ in range(draw.randrange(60))) for _ in range(150)]
    ids = [None, None, 7, 7, -3, 2**60 + 1, 2**60 + 3]
    return [(ids[i] if i < len(ids) else i, t) for i, t in enumerate(texts)] + [(7, "again here"), (7, "again here"), (None, "no id at all")]


def same_rows(got, want):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_by_brute_force(spark, tmp_path):
    rows = [(i, t, "k", "v") for i, t in cases()]
    spark.createDataFrame(rows, "doc_id long, text string, _____0 string, ______0 string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_fill_middle(spark, str(tmp_path)).select(*DIGEST).collect()
    same_rows(found, [expected(i, t) for i, t in cases()])
    assert {r["form"] for r in found} == {"plain", "spm", "psm"}


def test_sql_gives_the_same_rows(tmp_path):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", cases())
    same_rows(con.sql(fill_middle.digest_sql()).fetchall(), [expected(i, t) for i, t in cases()])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t é\U0001f600", max_size=80))
def test_units_and_ranks(text):
    units = UNIT.findall(text)
    ends = fill_middle.unit_ends(text)
    assert list(ends) == list(np.cumsum([len(u) for u in units], dtype=int))
    found = fill_middle.SkipList(ends)
    assert [found.code_points(r) for r in range(len(units) + 1)] == [0, *ends]


def test_lanes_thin_out_and_a_search_takes_few_links():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 9, 200000))
    found = fill_middle.SkipList(ends)
    sizes = [len(lane[0]) for lane in found.lanes]
    assert sizes[0] == 200000 and 6 <= len(sizes) <= 14 and all(b < 0.5 * a for a, b in zip(sizes, sizes[1:]) if a > 500)
    for lane in found.lanes:  # widths of a lane add up to its last node
        assert lane[0].sum() <= 200000 and lane[1].sum() == ends[lane[0].sum() - 1]
    for rank in (0, 1, 77777, 199999, 200000):
        assert found.code_points(rank) == (ends[rank - 1] if rank else 0)


def test_empty_tables_and_clashing_names(spark):
    session_settings(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.transform(none, "doc_id", "text").collect() == []
    with pytest.raises(ValueError, match="output"):
        fill_middle.transform(none.selectExpr("*", "1 AS output"), "doc_id", "text")


def test_every_text_comes_back(spark):
    session_settings(spark)
    rows = [(i, t, "x", "y") for i, (_, t) in enumerate(cases())]
    texts = spark.createDataFrame(rows, "key int, body string, _____0 string, ______0 string")
    done = fill_middle.transform(texts, "key", "body", seed=1, rate=100, spm_share=50)
    wrong = done.filter(fill_middle.restored() != done["body"])
    assert wrong.count() == 0
    assert {(r["_____0"], r["______0"]) for r in done.collect()} == {("x", "y")}
    assert done.filter("form <> 'plain'").count() > 100

"""The pipeline over given documents with planted ones: each stage against plain Python, and ``run`` against the stages."""

import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillworks.llm.common import settings as session_settings
from tillworks.llm.queries import QUERIES, vocabulary
from tillworks.session import materialize, shared_folder

GIVEN = "/root/testdata/sf0.001/documents.parquet"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """The folder of the documents, and the input and output of every stage."""
    session_settings(spark)
    docs = spark.read.parquet(GIVEN).select(*COLUMNS)
    long = docs.filter(F.length("text") > 1500).orderBy("doc_id").limit(2).collect()
    prose, other = long[0]["text"], long[1]["text"]
    planted = [
        (900_001, prose, None, None, len(prose)),
        (900_002, prose + " end", "en", "late", len(prose) + 4),
        (900_003, None, None, "late", None),
        (900_004, "", None, "late", 0),
        (None, other, None, "late", len(other)),
        (900_005, "### $$$ " * 60, None, "late", 480),
        (900_006, f"{other} Write to some.one@mail.example.org or to 4111 1111 1111 1111.", None, "late", 0),
    ]
    folder = str(tmp_path_factory.mktemp("stages"))
    docs.unionByName(spark.createDataFrame(planted, docs.schema)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    now, steps = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, now, folder), name)
        steps[name] = (now, after)
        now = after
    return folder, steps


def test_quality_keeps_what_op9_keeps(spark, done):
    folder, steps = done
    before, after = steps["quality"]
    judged = Counter()
    for r in QUERIES["op9_quality"](spark, folder).filter("kept").select("doc_id").collect():
        judged[r["doc_id"]] += 1
    assert Counter(r["doc_id"] for r in after.select("doc_id").collect()) == judged
    assert rows_of(after) <= rows_of(before)
    kept = {r["doc_id"]: r["text"] for r in after.collect()}
    assert all(len(WORD.findall(t)) >= 50 for t in kept.values())
    assert 900_001 in kept and 900_006 in kept and not {900_003, 900_004, 900_005} & kept.keys()


def test_one_document_of_each_group_stays(done):
    before, after = done[1]["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    sets = []
    for _, t in rows:
        words = WORD.findall(t.translate(LOWER))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[find(i)].append((key is None, key or 0))
    want = Counter(None if least[0] else least[1] for least in map(min, groups.values()))
    assert Counter(r["doc_id"] for r in after.collect()) == want
    assert rows_of(after) <= rows_of(before)
    assert 900_001 not in want and 900_002 not in want


def test_personal_data_is_masked(done):
    before, after = done[1]["private"]
    texts = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["lang"] or "", r["source"] or "", r["text"]) for r in df.collect())
    masked = 0
    for was, now in zip(texts(before), texts(after), strict=True):
        assert was[:4] == now[:4]
        assert not EMAIL.search(now[4])
        assert now[4].count("[EMAIL]") >= len(list(EMAIL.finditer(was[4])))
        if not re.search(r"[0-9@]", was[4]):
            assert was[4] == now[4]
        masked += was[4] != now[4]
    assert masked
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    # The planted document if it is the one of its group that stayed, else the earlier one.
    assert "4111 1111 1111 1111" not in "".join(r["text"] for r in after.collect())


def test_sources_reach_their_targets(done):
    before, after = done[1]["mix"]
    words = lambda df: Counter({s: n for s, n in sum((Counter({r["source"]: len(WORD.findall(r["text"]))}) for r in df.collect()), Counter()).items()})
    sizes, taken = words(before), words(after)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while over := [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 3 * sizes[s]]:
        left -= sum(3 * sizes[s] for s in over)
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= set(over)
    target |= {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
    for s in order:
        assert abs(taken[s] - target[s]) <= 1
    texts = {}
    for r in before.collect():
        texts.setdefault((r["doc_id"], r["source"]), []).append(r["text"])
    for r in after.collect():
        assert any(t.startswith(r["text"]) for t in texts[r["doc_id"], r["source"]])
        assert r["n_chars"] == len(r["text"])


def test_pieces_are_the_tokens_of_all_documents(done):
    from tokenizers import Tokenizer

    before, after = done[1]["pack"]
    tokenizer = Tokenizer.from_file(vocabulary())
    pieces, places = defaultdict(Counter), []
    for r in after.collect():
        pieces[r["doc_id"]][r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        places.append((r["sequence_id"], r["offset"], r["length"]))
    # The stream has no gap, and is cut at the ends of documents and sequences alone.
    places.sort()
    at = 0
    for sequence, offset, length in places:
        assert sequence * 2048 + offset == at and offset + length <= 2048
        at += length
    total = 0
    for key, texts in ((k, [r["text"] for r in before.collect() if r["doc_id"] == k]) for k in {r["doc_id"] for r in before.collect()}):
        all_ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for t in texts]
        total += sum(map(len, all_ids))
        assert sum(n * length for (_, length, _, _), n in pieces[key].items()) == sum(map(len, all_ids))
        for start, length, crc, n in pieces[key]:
            assert any(len(ids) == n and zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in all_ids)
    assert total == at


def test_run_gives_what_the_stages_give_and_leaves_one_folder(spark, done):
    folder, steps = done
    root = f"{shared_folder(spark)}/tillworks"
    earlier = set(os.listdir(root))
    result = corpus_pipeline.run(spark, folder)
    assert Counter(map(tuple, result.collect())) == Counter(map(tuple, steps["pack"][1].collect()))
    left = set(os.listdir(root)) - earlier
    assert len(left) == 1 and left.pop().startswith("pack-")

import random
from collections import Counter

import corpus_pipeline
from tillworks.llm.common import settings as session_settings

SCHEMA = "doc_id long, text string, source string, n_chars long"


def test_stages_keep_rows_without_an_id_or_with_a_shared_one(spark):
    session_settings(spark)
    rng = random.Random(17)
    new = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    copied, nothing = new(), [None, "", "  "]
    alone = [(None, new()) for _ in range(6)] + [(5, new()) for _ in range(4)] + [(i, t) for i in (None, 5) for t in nothing]
    rows = [*alone, (None, copied), (None, copied), (9, copied), (8, copied + " x"), (5, "short one"), (None, "short one")]
    docs = spark.createDataFrame([(i, t, None, len(t or "")) for i, t in rows], SCHEMA)
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == Counter([*alone, (8, copied + " x"), (5, "short one")])
    # All words of one source are its target, so each row stays once.
    mixed = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert mixed == Counter((i, t, len(t)) for i, t in rows if (t or "").strip())
    # Two sources: one is repeated three times, of the other only a part is taken.
    shared = [(1, new() + " y", "a") for _ in range(2)] + [(1, None, "a"), (None, "a b", "a"), *[(1, new() + " z" * k, "b") for k in range(9)]]
    docs = spark.createDataFrame([(i, t, s, 0) for i, t, s in shared], SCHEMA)
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    words = Counter()
    for r in got:
        assert any(t and r["text"] and t.startswith(r["text"]) and i == r["doc_id"] and s == r["source"] for i, t, s in shared)
        words[r["source"]] += len(r["text"].split())
    total = Counter()
    for _, t, s in shared:
        total[s] += len((t or "").split())
    assert words == {"a": 3 * total["a"], "b": sum(total.values()) - 3 * total["a"]}

"""Every column of op10_syncmers against plain Python, with hot and missing ids."""

import hashlib
import random

import pytest

from tillworks.llm import syncmers
from tillworks.llm.queries import QUERIES
from tillworks.llm.common import settings as session_settings

K, S = syncmers.K, syncmers.S


def anchors(text):
    """Each window by itself: an anchor if its least inner hash stands first or last."""
    found = []
    for at in range(max(1, len(text) - K + 1)) if text else ():
        codes = [ord(c) for c in text[at : at + K]]
        if len(text) < K:
            return [(hash_of(codes + [None] * (K - len(codes))), 0)]
        inner = [hash_of(codes[i : i + S]) for i in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((hash_of(codes) >> 32, at))
    return found or ([(hash_of([ord(c) for c in text[:K]]) >> 32, 0)] if text else [])


def hash_of(codes):
    base, mix, whole = int(syncmers._BASE), int(syncmers._MIX), (1 << 64) - 1
    h = 0
    for c in codes:
        h = (h * base + (0 if c is None else (c + 1) * mix)) & whole
    h = ((h ^ (h >> 29)) * mix) & whole
    return h ^ (h >> 32)


def likeness(a, b):
    """The longest chain by comparing each pair of matches with all before it."""
    if not a or not b:
        return float(a == b)

    def numbered(found):
        seen = {}
        return {(h, seen.setdefault(h, []).append(0) or len(seen[h])): i for i, (h, _) in enumerate(found)}

    x, y = numbered(a), numbered(b)
    pairs = sorted((x[k], y[k]) for k in x.keys() & y.keys())
    best = []
    for i, (_, q) in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j][1] < q), default=0))
    return 2 * max(best, default=0) / (len(a) + len(b))


def texts_of(n):
    rng = random.Random(23)
    words = ["".join(rng.choice("abcdeü\U0001f600") for _ in range(5)) for _ in range(12)]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(n - 3)]
    return [*made, None, "", "x" * 100]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    session_settings(spark)
    # A third of the rows without an id, a third of one id, and copies of a text among both.
    ids = [None] * 50 + [7] * 50 + [*range(-20, 30)]
    texts = texts_of(150)
    texts[10] = texts[11] = texts[60] = texts[61] = texts[120]
    folder = str(tmp_path_factory.mktemp("syncmers"))
    df = spark.createDataFrame([(i, t, "a") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, _slice string")
    df.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_op10_equals_plain_python(spark, rows):
    placed = spark.read.parquet(f"{rows}/documents.parquet").selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()
    order = sorted(placed, key=lambda r: (-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["h"]))
    want = []
    for here, following in zip(order, [*order[1:], order[0]], strict=True):
        text, other = here["text"], following["text"]
        n = len(text) // 4
        changed = text[: len(text) - n] + other[:n]
        a = anchors(text)
        want.append((
            here["doc_id"], len(text), hashlib.sha256(changed.encode()).hexdigest(), syncmers.fingerprint(text), syncmers.fingerprint(changed),
            round(likeness(a, anchors(changed)), 9), round(likeness(a, anchors(other)), 9),
        ))
    got = QUERIES["op10_syncmers"](spark, rows).collect()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = [tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in names) for r in got]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_anchors_equal_plain_python():
    for text in texts_of(40):
        want = anchors(text or "")
        hashes, places = syncmers.anchors(text or "")
        assert places.tolist() == [p for _, p in want]
        if len(text or "") >= K:
            assert hashes.tolist() == [h for h, _ in want]


def test_a_hot_id_is_cut(spark, rows):
    dealt = syncmers.with_following(spark.read.parquet(f"{rows}/documents.parquet"), "doc_id", "text")
    sizes = [r["count"] for r in dealt.filter("_tail = 0").groupBy("_slice").count().collect()]
    # Eight slices of 150 rows; an id of 50 rows may not stay in one.
    assert sum(sizes) == 150 and max(sizes) <= 38
    assert dealt.filter("_tail = 1").select("_slice").distinct().count() == len(sizes)

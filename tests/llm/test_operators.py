"""Text operators against plain Python, and their cases: nulls, empty and long texts, ties, repeats, empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillworks.llm import html_text, language, mixing, ngram_join, packing, pii, quality, syncmers, toxicity, url_rules
from tillworks.llm.common import settings as session_settings
from tillworks.llm.components import components
from tillworks.llm.queries import vocabulary
from tillworks.session import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, id string"


def documents(spark, texts):
    session_settings(spark)
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "a", None, "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


WORDS = [f"w{i}x" for i in range(400)]
random.seed(5)
BASE = [random.choice(WORDS) for _ in range(120)]
TEXTS = [None, "", " \n ", "one", "One", "a b c d e", " ".join(BASE), " ".join(BASE[:-3] + ["q", "r", "s"]), " ".join(BASE), "x " * 20000,
         " ".join(random.choice(WORDS) for _ in range(80)), "Üñí co@d.example.org +1 (555) 555-1234 \U0001f600 4111 1111 1111 1111"]


def jaccard_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_ngram_join(spark):
    got = {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(documents(spark, TEXTS)).collect()}
    assert got == jaccard_components(TEXTS)


def test_ngram_join_of_copies_about_the_threshold(spark):
    """Chains of edits: neighbours link, far ones do not, and blocks hold pairs back."""
    draw, texts = random.Random(9), []
    for _ in range(3):
        words = [draw.choice(WORDS) for _ in range(100)]
        for k in range(25):
            words = words[:]
            for _ in range(draw.choice([1, 1, 2, 3])):
                words[draw.randrange(100)] = f"n{draw.random()}"
            texts.append(" ".join(words))
    got = {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(documents(spark, texts)).collect()}
    assert got == jaccard_components(texts)


def test_components_of_star_path_and_ring(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["root"], set()).add(r["id"])
    assert sorted(map(sorted, got.values())) == [list(range(60)), list(range(100, 141)), [200, 201, 202]]


def test_spanning_forest_takes_the_likeliest():
    i, j = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4])
    kept = ngram_join._spanning(np.arange(5), i, j, np.array([0.9, 0.5, 0.8, 0.7]))
    assert sorted(kept.tolist()) == [0, 2, 3]


def test_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(np.r_[s[rng.integers(0, 12) :], rng.integers(0, 1 << 63, 3, dtype=np.uint64)]) for s in sets for _ in range(2)]
    n = np.array([len(s) for s in sets])
    tree = ngram_join.Tree(n, np.arange(len(sets)), ngram_join._folded([ngram_join._bitmap(s) for s in sets]))
    kept = {tuple(sorted(p)) for i, j, _ in tree.candidates() for p in zip(i.tolist(), j.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 5 * both >= 4 * (n[i] + n[j] - both):
                assert (j, i) in kept


def test_packing_round_trip(spark):
    rows = packing.pack(documents(spark, TEXTS), "doc_id", "text", vocabulary(), 64).collect()
    whole = packing.encoder(vocabulary()).tokenizer
    for i, t in enumerate(TEXTS):
        own = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == i)
        ids = np.frombuffer(b"".join(x for _, x in own), "<u4").tolist()
        assert ids == whole.encode(t or "", add_special_tokens=False).ids + [1]
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(v == 64 for k, v in ends.items() if k < max(ends))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aé'sT 1\n\t\u00a0\u2003\u3042中\u0301.<|>", max_size=60))
def test_ids_are_those_of_tokenizers(t):
    encode = packing.encoder(vocabulary())
    for x in (t, t + packing.SPECIAL + t, t + " " * 1200 + t):
        assert encode.encode([x])[0].tolist() == encode.tokenizer.encode(x, add_special_tokens=False).ids


def test_mixing(spark):
    mixed = mixing.mix(documents(spark, TEXTS))[0].toPandas()
    assert len(mixed) == len(TEXTS)
    assert (mixed["taken"] <= 3 * mixed["size"]).all()
    assert mixing.word_targets([10, 10, 1000]) == pytest.approx([30, 30, 960])
    i = np.arange(3000)
    points = mixing.reversed_bits(i)
    low, high = np.full(3000, 1 << 37), np.full(3000, 3 << 38)
    inside = (points >= low) & (points < high)
    assert (mixing.ranks(i, low, high) == np.cumsum(inside) - inside).all()


def test_quality_counts(spark):
    rows = quality.with_stats(documents(spark, TEXTS)).collect()
    for r in rows:
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        times = Counter(windows)
        covered = {k + d for k, x in enumerate(windows) if times[x] > 1 for d in range(3)}
        assert (r["_q_n_words"], r["_q_word_chars"], r["_q_n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
    judged = quality.judge_quality(documents(spark, TEXTS), ["doc_id"]).collect()
    assert all(not r["_q_kept"] for r in judged if r["_q_base_failed"])


def test_urls(spark):
    session_settings(spark)
    urls = [None, "x", "http://a.example.net/en/1?q", "https://example.net/de/", "http://B.example.com/de/x", "http://net", "http://w.org/fr/#a", "http://notnet.com/", "http://spam-farm.example.org/en"]
    got = [tuple(r) for r in url_rules.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), "page_id", "url").select("host", "path", "rule", "verdict").collect()]
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("net/", "block") and got[4][2:] == ("example.com/de/", "block")
    assert got[5] == ("net", "", None, "allow") and got[6][2:] == ("org/fr/", "allow")
    assert got[7][2:] == (None, "allow") and got[8][2:] == (None, "block")


def test_html():
    page = "<nav><a>menu</a></nav><article><h1>T &amp; t</h1><p><b>one\n two<br><p>three</p></article><footer>x</footer><script>a<b</script>"
    assert html_text.main_text(page) == "T & t\none two\nthree"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<p>cut &am") == "cut &am"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1@.+- (9", max_size=40))
def test_pii_base_equals_plain_patterns(t):
    plain = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub(r"\D", "", s)) <= 19 and pii.luhn(re.sub(r"\D", "", s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15)]
    assert pii.base_spans(t) == [(k, m.start(), m.end()) for k, p, ok in plain for m in re.finditer(p, t) if ok(m[0])]


def test_pii_skip_edges_add_a_misspelt_repeat():
    model = (np.array([-2.0, 0, 0, 0, 0, 0, 0]), 0.2, 4.0)
    base, spans = pii.all_spans("pay 4111 1111 1111 1111 now " + "word " * 20 + "again 4111 1111 1111 1112 end", model)
    assert len(base) == 1 and len(spans) == 2


def test_syncmers(spark):
    long = "".join(random.choice("abcdefgh ") for _ in range(3000))
    hashes, places = syncmers.anchors(long)
    cut_hashes, cut_places = syncmers.anchors(long[100:])
    inner = {(h, p) for h, p in zip(hashes.tolist(), places.tolist(), strict=True) if p >= 100}
    assert {(h, p + 100) for h, p in zip(cut_hashes.tolist(), cut_places.tolist(), strict=True)} == inner
    assert np.diff(places).max() <= syncmers.K - syncmers.S
    rows = syncmers.fingerprint_edits(documents(spark, TEXTS)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text, following = TEXTS[r["doc_id"]] or "", TEXTS[(r["doc_id"] + 1) % len(TEXTS)] or ""
        assert r["edited_fingerprint"] == syncmers.fingerprint(syncmers.edited(text, following))


def test_models_on_edge_cases(spark):
    docs, none = documents(spark, TEXTS), documents(spark, TEXTS).limit(0)
    model = language.train(docs, "doc_id", "text", "lang")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model, "doc_id", "text").collect()}
    assert got[0] == got[1] == got[2] == "und" and got[6] == "en"
    labels = spark.createDataFrame([(6, 1), (6, 0), (10, 0), (9, 0)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels, "doc_id", "text", "toxic"), "doc_id", "text", []).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
    for empty in (quality.judge_quality(none, ["doc_id"]), ngram_join.near_duplicates(none), syncmers.fingerprint_edits(none),
                  pii.find(none, pii.train(none, "doc_id", "text"), "doc_id", "text"), mixing.mix(none)[0],
                  packing.pack(none, "doc_id", "text", vocabulary()), language.predict(none, None, "doc_id", "text")):
        assert empty.count() == 0


def test_toxicity_rates_words_by_every_ngram(spark, monkeypatch):
    session_settings(spark)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [None, "", *[" ".join(rng.choice(words) for _ in range(30)) for _ in range(60)]]
    docs = spark.createDataFrame([(i if i % 5 else None, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, y int")
    grams = toxicity.count_grams(docs, "text", "y")
    table = materialize(toxicity.ratios(grams))
    known = {r["g"]: r["r"] for r in table.collect()}
    assert grams.count() == sum(len(g) == toxicity.ORDER for g in known)

    def ratio(w):
        p = " " * (toxicity.ORDER - 1) + w + "\n"
        windows = [p[i : i + toxicity.ORDER] for i in range(len(w) + 1)]
        return sum(known.get(g, known.get(g[:-1], 0.0)) for g in windows)

    want = []
    for t in [*texts, "unseenwörd " + words[0]]:
        ws = re.findall(r"[^\W\d_]+", (t or "").lower())
        top = sorted(sorted({round(ratio(w), 9) for w in ws}, reverse=True)[:3] + [0.0, 0.0], reverse=True)
        want.append([1.0, 10 * sum(map(ratio, ws)) / sum(len(w) + 1 for w in ws), max(ratio(w) / (len(w) + 1) for w in ws), top[0], sum(top[:3]) / 3] if ws else [1.0, 0, 0, 0, 0])
    more = docs.unionByName(spark.createDataFrame([(7, "unseenwörd " + words[0], 0)], docs.schema))
    for held, frequent in ((10**6, 0), (0, 0), (0, 40), (0, 50_000)):
        monkeypatch.setattr(toxicity, "HELD_GRAMS", held)
        monkeypatch.setattr(toxicity, "FREQUENT", frequent)
        got = [r["x"] for r in toxicity.features(more, table, ["doc_id"], "text").collect()]
        assert np.allclose(np.array(sorted(got)), np.array(sorted(want)), atol=1e-6)


def test_mixing_reaches_targets_of_tiny_sources(spark):
    session_settings(spark)
    rng = random.Random(11)
    sizes = {f"s{i:03}": [rng.randint(1, 12) for _ in range(rng.randint(1, 4))] for i in range(80)}
    sizes["hot"] = [rng.randint(0, 90) for _ in range(300)]
    rows = [(s, " ".join("w" * n)) for s in sizes for n in sizes[s]]
    docs = spark.createDataFrame([(i if i % 7 else None, t, s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string")
    mixed, scheduled = mixing.mix(docs.withColumn("key", docs["source"]), row="key")
    got = mixed.toPandas()
    assert (got["taken"] <= 3 * got["size"]).all() and sorted(got["size"]) == sorted(n for x in sizes.values() for n in x)
    for s, part in got.groupby("key"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 1, s
    pieces = scheduled.toPandas()
    assert pieces["words"].sum() == got["taken"].sum() and (pieces["words"] > 0).all()
    assert sorted(set(pieces["slot"])) == list(range(pieces["slot"].max() + 1))
    assert pieces.groupby("slot")["words"].sum().max() <= mixing.BLOCK_WORDS


def test_html_keeps_short_parts_and_marked_pages():
    body = "<p>" + "a long paragraph of the article " * 5 + "</p>"
    long = ("a long paragraph of the article " * 5).strip()
    tags = "</div></div></section></div><div><section><div><div>"
    assert html_text.main_text(f"<h1>Title</h1>{tags}{body}{tags}<p>End.</p>") == f"Title\n{long}\nEnd."
    adverts = '<div class="ad">buy</div>' * 9
    assert html_text.main_text(f"<article><h1>Title</h1>{adverts}{body}{adverts}<p>End.</p></article>") == f"Title\n{long}\nEnd."
    assert html_text.main_text(f'<div class="post-content"><p>By A</p>{adverts}{body}</div>{adverts}<p>x</p>') == f"By A\n{long}"
    for tag in ('body class="no-sidebar"', 'article class="post has-comments"', 'main id="nav"', 'html class="menu"', 'div class="with-sidebar"', 'div class="share-text"'):
        assert html_text.main_text(f"<{tag}>{body}</{tag.split()[0]}>") == long, tag
    for tag in ('div class="site-nav"', 'div id="comments"', 'div class="x sidebar"', "aside", 'li class="comment-12"'):
        assert html_text.main_text(f"{body}<{tag}>gone</{tag.split()[0]}><p>kept</p>") == f"{long}\nkept", tag


def test_pii_links_all_like_mentions():
    model = (np.array([-2.0, 0, 0, 0, 0, 0, 0]), 0.0, 4.0)
    far = " " + "word " * 20
    added = lambda *parts: {t[a:b] for t in [far.join(parts)] for _, a, b in set(pii.all_spans(t, model)[1]) - set(pii.all_spans(t, model)[0])}
    a = "4111 1111 1111 1111"
    b = next(x for x in (f"4111 1111 9999 999{d}" for d in range(10)) if pii.luhn(x.replace(" ", "")))
    assert added(a, b, "4111 1111 1111 1112") == {"4111 1111 1111 1112"}
    assert added("+1 (212) 555-0123", "+1 555-0123", "+1 555-0199") == {"+1 555-0123"}
    assert added("+1 (212) 555-0123", "call 555-0123 or 212 555 0123") == {"555-0123", "212 555 0123"}
    assert added("john.smith@example.com", "john.smith#example.com", "other#example.com") == {"john.smith#example.com"}
    # By brute force: every doubtful mention has an edge to each like string.
    rng = random.Random(23)
    text = " , ".join("4111 1111 " + " ".join("".join(rng.choice("12") for _ in range(4)) for _ in range(2)) for _ in range(150))
    found = pii.mentions(text)
    plain = [pii._plain(text, m) for m in found]
    skip = set(pii.edges(text, found)[1])
    linked = {(i, plain[j]) for e in skip for i, j in (e, e[::-1])}
    for i, m in enumerate(found):
        for q in set(plain):
            if not m[3] and q != plain[i] and pii._alike(plain[i], q):
                assert (i, q) in linked

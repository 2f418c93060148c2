"""Personal data: the fitted field through the registered query, base columns by brute force, long lists."""

import hashlib
import random
import re
import time

from tillworks.llm import pii, queries
from tillworks.llm.common import settings as session_settings

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub(r"\D", "", s)) <= 19 and pii.luhn(re.sub(r"\D", "", s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15),
]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PATTERNS for m in re.finditer(p, text or "") if ok(m[0])]


def card(draw):
    while True:
        digits = "".join(draw.choice("0123456789") for _ in range(16))
        if pii.luhn(digits):
            return " ".join(digits[i : i + 4] for i in range(0, 16, 4))


def wrong(draw, number):
    i = draw.choice([i for i, c in enumerate(number) if c.isdigit()])
    return number[:i] + str((int(number[i]) + 1 + draw.randrange(8)) % 10) + number[i + 1 :]


def corpus(n=400):
    """Texts with a card and, in half of them, the card again with a wrong digit; in the rest another number that fails."""
    draw, words, out = random.Random(7), [f"word{i}" for i in range(500)], []
    fill = lambda: " ".join(draw.choice(words) for _ in range(40))
    for i in range(n):
        number = card(draw)
        second = wrong(draw, number) if i % 2 else None
        while second is None or (i % 2 == 0 and pii.luhn(re.sub(r"\D", "", second))):
            second = wrong(draw, card(draw))
        text = f"{fill()} pay {number} now {fill()} with {second} then {fill()} a.b{i}@example.org or 10.1.{i % 256}.7"
        out.append((i, text, text.index(second), len(second)))
    return out


def test_misspelt_repeats_are_found_through_the_query(spark, tmp_path):
    planted = corpus()
    extra = [(2**60 + 1, "mail x@y.org"), (None, None), (5000, ""), (5001, "no data 12345 here")]
    spark.createDataFrame([(i, t, "v") for i, t, *_ in planted] + [(*e, "v") for e in extra], "doc_id long, text string, spans string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = {r.doc_id: r for r in queries.op8_pii(spark, str(tmp_path)).collect()}
    hits = [f"card:{at}:{at + n}" in found[i].spans.split(",") for i, _, at, n in planted]
    recall = sum(hits[1::2]) / len(hits[1::2])
    assert recall >= 0.9, recall
    assert sum(hits[::2]) / len(hits[::2]) <= 0.05
    texts = {i: t for i, t, *_ in planted} | dict(extra)
    for i, r in found.items():
        spans = base(texts[i])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(filter(None, r.spans.split(",")))


def test_potentials_come_from_the_sample(spark):
    session_settings(spark)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in corpus(60)], "doc_id long, text string")
    _, chain, skip = pii.train(docs, "doc_id", "text")
    assert skip > 1 and abs(chain) < skip
    none = spark.createDataFrame([(i, f"code 4111 1111 1111 111{i % 10} of {i}") for i in range(9)], docs.schema).filter("doc_id % 10 <> 1")
    weights, chain, skip = pii.train(none, "doc_id", "text")
    assert not weights.any() and chain == skip == 0.0


def test_many_addresses_of_one_net_beside_a_doubtful_one():
    text = lambda n: " ".join(f"10.20.{i // 250}.{i % 250}" for i in range(n)) + " and 10.20.999.1 here"
    took = []
    for n in (2000, 16000):
        whole = text(n)
        found = pii.mentions(whole)
        began = time.time()
        pii.edges(whole, found)
        took.append(time.time() - began)
    assert took[1] < 24 * max(took[0], 0.02)

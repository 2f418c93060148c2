"""Numbers per group: ordinary keys by a window, heavy ones over several tasks."""

import random

from tillworks.operators import numbering


def rows():
    draw = random.Random(6)
    out = [("hot" if draw.random() < 0.5 else draw.choice(["a", "b", None]), draw.choice([None, *range(40)]), i) for i in range(1500)]
    return out + [("hot", 3, 7), ("hot", 3, 7), (None, None, 1)]


def expected():
    groups = {}
    for k, d, i in rows():
        groups.setdefault(k, []).append((d is not None, d or 0, i))
    return sorted((str(k), at, g == len(members)) for k, members in groups.items() for g, (_, at, _) in enumerate(sorted((m, m[2], 0) for m in members), 1))


def numbered(spark):
    df = spark.createDataFrame(rows(), "k string, d int, i int")
    found = numbering.sequence_rows(df, ["k"], ["d"], sequence="n", is_latest="last").collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r.k, []).append(r)
    for members in by_key.values():
        members.sort(key=lambda r: r.n)
        assert [r.n for r in members] == list(range(1, len(members) + 1))
        order = [(r.d is not None, r.d or 0, r.i) for r in members]
        assert order == sorted(order)
    return sorted((str(r.k), r.i, r.last) for r in found)


def test_ordinary_keys_are_not_written(spark, monkeypatch):
    monkeypatch.setattr(numbering, "materialize", lambda *a: 1 / 0)
    assert numbered(spark) == expected()


def test_a_key_of_half_the_rows_is_sorted_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(numbering, "HEAVY_ROWS", 400)
    real, sizes = numbering.materialize, []

    def seen(df, label):
        done = real(df, label)
        sizes.append((done.count(), {r.k for r in done.select("k").distinct().collect()}))
        return done

    monkeypatch.setattr(numbering, "materialize", seen)
    assert numbered(spark) == expected()
    assert len(sizes) == 1 and sizes[0][1] == {"hot"} and sizes[0][0] > 700

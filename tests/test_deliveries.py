"""Deliveries, batches and the fact that follows them: reruns, crashes between two steps, several writers."""

import threading

import pytest
from pyspark.sql import functions as F

from tillworks.plans import incremental
from tillworks.queries import orders_by_customer
from tillworks.sources import landing
from tillworks.sources.ledger import Ledger, put
from tillworks.streaming.feed import feed_stream


class Killed(RuntimeError):
    """Stands for a process that dies."""


def orders(spark, rows):
    return spark.createDataFrame([(k, k % 3, float(k), d) for k, d in rows], "o_orderkey int, o_custkey int, o_totalprice double, day string").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice", "CAST(day AS DATE) AS Date"
    )


OLD = [(i, f"2012-{1 + i % 3:02d}-{1 + i % 28:02d}") for i in range(30)] + [(99, None)]
LATE = [(200, "2012-01-05"), (201, "2012-01-06"), (202, "2012-01-07")]
NEW = [(300 + i, "2012-05-01") for i in range(4)]


def keys(frame):
    return sorted(r.o_orderkey for r in frame.collect())


def test_late_lines_add_to_an_old_month_and_a_rerun_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert landing.read_landed(spark, root) is None
    landing.land(orders(spark, OLD), root, "first")
    landing.land(orders(spark, LATE), root, "late")
    want = sorted(k for k, _ in OLD + LATE)
    assert keys(landing.read_landed(spark, root)) == want
    january = keys(landing.read_landed(spark, root, [(2012, 1)]))
    assert {200, 201, 202} < set(january) and len(january) == 13
    for name, rows in (("late", LATE), ("first", OLD)):
        landing.land(orders(spark, rows), root, name)
        assert keys(landing.read_landed(spark, root)) == want
    # A corrected delivery loses the months it no longer has, and these count as changed.
    before = {(r.year, r.month): r.since for r in landing.landed_months(spark, root).collect()}
    landing.land(orders(spark, OLD[:1]), root, "first")
    assert keys(landing.read_landed(spark, root)) == sorted([0, 200, 201, 202])
    after = {(r.year, r.month): r.since for r in landing.landed_months(spark, root).collect()}
    assert all(after[m] > before[m] for m in [(2012, 1), (2012, 2), (2012, 3), (None, None)])


def test_a_batch_is_published_once_whatever_happens_in_between(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert landing.publish_batch(orders(spark, OLD), root, "a")
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "update", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):  # the files are there, the ledger does not name them
            landing.publish_batch(orders(spark, LATE), root, "b")
    assert keys(landing.read_published(spark, root)) == sorted(k for k, _ in OLD)
    assert landing.publish_batch(orders(spark, LATE), root, "b")
    assert not landing.publish_batch(orders(spark, LATE), root, "b")
    assert keys(landing.read_published(spark, root)) == sorted(k for k, _ in OLD + LATE)


def together(*calls):
    errors, gate = [], threading.Barrier(len(calls))

    def run(call):
        gate.wait()
        try:
            call()
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(c,)) for c in calls]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors


def test_two_writers_of_a_batch_leave_one_copy(spark, tmp_path):
    done = []
    together(*[lambda: done.append(landing.publish_batch(orders(spark, LATE), str(tmp_path), "b")) for _ in range(2)])
    assert sorted(done) == [False, True] and keys(landing.read_published(spark, str(tmp_path))) == [200, 201, 202]


def test_writers_of_one_ledger_lose_no_row(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), "who string, n int")
    add = lambda i: ledger.update(lambda table, _: put(table, spark.createDataFrame([(f"w{i}", i)], "who string, n int"), ["who"]))
    together(*[lambda i=i: add(i) for i in range(6)])
    assert sorted(r.n for r in ledger.read().collect()) == list(range(6)) and ledger.latest() == 6
    assert [ledger.read(n).count() for n in range(7)] == list(range(7))
    left = sorted(p.name for p in tmp_path.iterdir())
    assert left == [f"v{n:012d}" for n in range(1, 7)]


def test_two_writers_of_progress_lose_no_row(spark, tmp_path):
    stores = [incremental.ProgressStore(spark, str(tmp_path)) for _ in range(3)]
    mark = lambda s, k, m: s.mark(k, [(2012, m)], incremental.CREATED)
    together(*[lambda s=s, k=k, m=m: mark(s, k, m) for s, k, m in zip(stores, ["invoice", "invoice", "gcs"], [1, 2, 1], strict=True)])
    assert sorted((r.kind, r.month) for r in stores[0].read().collect()) == [("gcs", 1), ("invoice", 1), ("invoice", 2)]


def fact_rows(frame):
    return sorted(map(tuple, frame.select("Year", "Month", "o_custkey", "n", "cents", "last_day").collect()))


def expected(spark, *deliveries):
    rows = orders(spark, [r for d in deliveries for r in d if r[1]]).withColumns({"Year": F.year("Date"), "Month": F.month("Date")})
    return fact_rows(orders_by_customer(rows))


def test_monthly_feed_killed_between_write_and_mark(spark, tmp_path, monkeypatch):
    feed, facts = f"{tmp_path}/feed", f"{tmp_path}/facts"
    store = incremental.ProgressStore(spark, f"{tmp_path}/progress")
    go = lambda: incremental.monthly_feed(spark, feed, facts, orders_by_customer, store)
    landing.land(orders(spark, OLD), feed, "first")
    assert go() == [(2012, 1), (2012, 2), (2012, 3)] and go() == []
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD)
    landing.land(orders(spark, LATE + NEW), feed, "late")
    with monkeypatch.context() as patch:
        patch.setattr(incremental.ProgressStore, "mark", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            go()
    # The new rows are written but not committed: data and progress are both the old ones.
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD)
    assert go() == [(2012, 1), (2012, 5)]
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD, LATE, NEW)


def test_a_failed_rebuild_keeps_the_earlier_rows_and_is_taken_up_first(spark, tmp_path):
    feed, facts = f"{tmp_path}/feed", f"{tmp_path}/facts"
    store = incremental.ProgressStore(spark, f"{tmp_path}/progress")
    landing.land(orders(spark, OLD), feed, "first")
    incremental.monthly_feed(spark, feed, facts, orders_by_customer, store)
    landing.land(orders(spark, LATE), feed, "late")
    with pytest.raises(Killed):
        incremental.monthly_feed(spark, feed, facts, lambda f: (_ for _ in ()).throw(Killed()), store)
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD)
    assert [tuple(r) for r in incremental.backfill_list(store.read(), "invoice").collect()] == [(2012, 1)]
    assert incremental.monthly_feed(spark, feed, facts, orders_by_customer, store) == [(2012, 1)]
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD, LATE)
    # A month that loses all its lines loses its rows.
    landing.land(orders(spark, LATE[:1]), feed, "first")
    assert incremental.monthly_feed(spark, feed, facts, orders_by_customer, store) == [(2012, 1), (2012, 2), (2012, 3)]
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, LATE, LATE[:1])


def test_the_stream_goes_on_after_a_failed_batch(spark, tmp_path):
    feed, facts, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/facts", f"{tmp_path}/checkpoint"
    store, built = incremental.ProgressStore(spark, f"{tmp_path}/progress"), []
    broken = threading.Event()

    def build(rows):
        if broken.is_set():
            raise Killed("batch")
        built.append(sorted({(r.Year, r.Month) for r in rows.select("Year", "Month").distinct().collect()}))
        return orders_by_customer(rows)

    go = lambda: feed_stream(spark, feed, facts, build, store, checkpoint, max_files=1).awaitTermination()
    landing.land(orders(spark, OLD), feed, "first")
    go()
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD)
    for name, rows in (("late", LATE), ("new", NEW), ("late", LATE)):
        landing.land(orders(spark, rows), feed, name)
    broken.set()
    with pytest.raises(Exception, match="batch"):
        go()
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD)
    broken.clear()
    go()
    assert fact_rows(incremental.read_fact(spark, facts, store)) == expected(spark, OLD, LATE, NEW)
    # One build for all that had landed of a month: the third delivery found January up to date.
    assert built == [[(2012, 1), (2012, 2), (2012, 3)], [(2012, 1)], [(2012, 5)]]
    go()
    assert len(built) == 3

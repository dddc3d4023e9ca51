"""Keyed stream state against batch twins: restarts, late pages, timers, several checkpoints on one state."""

import datetime as dt
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import catalog as C
from tallyloom.operators import reconcile as R
from tallyloom.sources.snapshots import Snapshots
from tallyloom.sources.staging import Staging
from tallyloom.streaming import jobs as J
from tallyloom.streaming import stateful as S

PAGE = "landed timestamp, domain string, page int, http_status int, body string"
T0 = dt.datetime(2024, 1, 1)


def page(domain, n, products, status=200, at=0):
    items = ", ".join(f'{{"id": {k}, "title": "t{k}", "product_type": "{"Mug" if k % 10 == 9 else "Dress"}"}}' for k in products)
    return (T0 + dt.timedelta(seconds=at), domain, n, status, "{}" if products is None else f'{{"products": [{items}]}}')


def missing(domain, n, at=0):
    return (T0 + dt.timedelta(seconds=at), domain, n, 200, '{"error": 1}')


@pytest.fixture
def walk(spark, tmp_path):
    S.with_state_store(spark)
    landed, out, progress = (str(tmp_path / x) for x in ("landed", "out", "progress"))

    def arrive(*pages, **more):
        spark.createDataFrame(list(pages), PAGE).coalesce(1).write.mode("append").parquet(landed)
        stream = J.arrivals(spark, landed, spark.createDataFrame([], PAGE).schema, 1)
        rows = J.collected(S.walked_pages(stream, **more), out, progress).collect()
        ends = [r for r in rows if r.kind == "end"]
        assert len({r.domain for r in ends}) == len(ends)
        ids = [(r.domain, r.product_id) for r in rows if r.kind == "id"]
        assert len(set(ids)) == len(ids)
        return {r.domain: (r.page, r.reason, r.complete, r.products) for r in ends}, set(ids)

    return arrive


def test_a_walk_ends_once_all_pages_before_its_end_are_there(walk):
    ends, ids = walk(page("a", 3, []), page("b", 1, [], 503), page("c", 1, [1, 0, 2, 1]), page("d", 1, [5]))
    assert ends == {"b": (1, "failed", False, 0)} and ids == {("c", "1"), ("c", "2"), ("d", "5")}
    # restarted: page 3 of a is remembered; b has ended, so its next page is ignored
    ends, ids = walk(page("a", 2, [3]), page("a", 1, [1, 2, 9]), page("b", 2, [7]), page("c", 2, [2, 3]), page("c", 3, [], 404), missing("d", 2), excluded=lambda p: p["product_type"] == "Mug")
    assert ends == {"a": (3, "empty", True, 3), "b": (1, "failed", False, 0), "c": (3, "end of catalog", True, 3), "d": (2, "missing key", False, 1)}
    assert ids == {("a", "1"), ("a", "2"), ("a", "3"), ("c", "1"), ("c", "2"), ("c", "3"), ("d", "5")}
    ends, late = walk(page("a", 4, [77]), page("c", 2, [88]), page("c", 4, []))
    assert late == ids and len(ends) == 4


def test_timers_end_open_walks(walk):
    walk(page("gap", 1, [1]), page("gap", 3, [3]), page("gap", 4, [], 429), page("open", 1, [1]), page("deep", 2, [2]), page("deep", 3, [3]), idle_seconds=60, watermark="1 second", cap=3)
    ends, ids = walk(page("clock", 1, [0], at=600), idle_seconds=60, watermark="1 second", cap=3)
    assert ends == {"gap": (4, "error", False, 2), "open": (1, "budget", False, 1), "deep": (3, "cap", False, 2)}
    assert ("gap", "3") in ids and ("deep", "3") in ids


def test_walk_equals_the_batch_twin(spark, walk):
    rng = random.Random(4)
    pages, clock = [], [page("clock", 1, [0], at=10**6)]
    for k in range(25):
        last = rng.randrange(1, 6)
        for n in range(1, last + 1):
            kind = rng.choice(["plain"] * 6 + ["empty", "missing", "error", "gone"])
            own = [k * 100 + n * 10 + j for j in range(rng.randrange(1, 4))] + [k * 100]
            pages.append(page(f"d{k}", n, own) if kind == "plain" else page(f"d{k}", n, []) if kind == "empty" else missing(f"d{k}", n) if kind == "missing" else page(f"d{k}", n, [1], 429 if kind == "error" else 404))
    rng.shuffle(pages)
    for part in (pages[:30], pages[30:], clock):
        ends, ids = walk(*part, watermark="1 second")
    table = spark.createDataFrame(pages, PAGE).drop("landed")
    twin = {r.domain: (r.end_page, r.reason, r.complete) for r in R.completeness(C.page_counts(table), streaming=True).collect()}
    assert {d: e[:3] for d, e in ends.items()} == twin
    end = {d: e[0] for d, e in twin.items()}
    listed = {(p[1], i) for p in pages if p[2] <= end[p[1]] and p[3] == 200 for i in [str(x["id"]) for x in __import__("json").loads(p[4]).get("products", [])] if i != "0"}
    assert {x for x in ids if x[0] != "clock"} == listed


BEAT = "store string, ts timestamp, kind string"


def written_out(beats, idle, hard, terminal):
    out = []
    for store in sorted({b[0] for b in beats}):
        times = sorted((b[1], b[2]) for b in beats if b[0] == store)
        sessions = []
        for t, kind in times:
            if sessions and (t - sessions[-1][-1][0]).total_seconds() < idle:
                sessions[-1].append((t, kind))
            else:
                sessions.append([(t, kind)])
        for s in sessions:
            start, last = s[0][0], s[-1][0]
            over, silent = start + dt.timedelta(seconds=hard), last + dt.timedelta(seconds=idle)
            done = [t for t, kind in s if kind in terminal]
            if done and done[0] <= over:
                at, verdict, n = done[0], "finished", sum(t <= done[0] for t, _ in s)
            elif silent > over:
                at, verdict, n = over, "over limit", sum(t <= over for t, _ in s)
            else:
                at, verdict, n = silent, "stalled", len(s)
            ms = lambda t: int(t.replace(tzinfo=dt.UTC).timestamp() * 1000)
            out.append((store, ms(start), ms(at), verdict, n))
    return sorted(out)


def test_watchdog_in_event_time(spark, tmp_path):
    S.with_state_store(spark)
    rng = random.Random(7)
    beats = [(f"s{rng.randrange(12)}", T0 + dt.timedelta(seconds=rng.randrange(4000)), rng.choice(["tick"] * 9 + ["done"])) for _ in range(160)]
    beats.sort(key=lambda b: b[1])
    landed, out, progress = (str(tmp_path / x) for x in ("landed", "out", "progress"))
    for part in (beats[:80], beats[80:], [("clock", T0 + dt.timedelta(days=1), "tick")]):
        rng.shuffle(part)
        spark.createDataFrame(part, BEAT).coalesce(1).write.mode("append").parquet(landed)
        stream = J.arrivals(spark, landed, spark.createDataFrame([], BEAT).schema, 1)
        rows = J.collected(S.watchdog(stream, 150, 400, ("done",), "1 hour"), out, progress).collect()
    assert sorted(map(tuple, rows)) == written_out(beats, 150, 400, ("done",))
    assert {r.verdict for r in rows} == {"finished", "over limit", "stalled"}


def test_a_silent_store_fails_while_the_stream_runs(spark, tmp_path):
    """No row arrives any more; the clock alone fires the timers."""
    S.with_state_store(spark)
    landed, progress = str(tmp_path / "landed"), str(tmp_path / "progress")
    spark.createDataFrame([("quiet", T0, "tick"), ("ready", T0, "done")], BEAT).coalesce(1).write.parquet(landed)
    stream = J.arrivals(spark, landed, spark.createDataFrame([], BEAT).schema)
    got, told = {}, threading.Event()

    def batch(rows, _):
        got.update({r.store: r.verdict for r in rows.collect()})
        if {"quiet", "busy"} <= set(got):
            told.set()

    query = S.watchdog(stream, 3, 6, ("done",)).writeStream.foreachBatch(batch).option("checkpointLocation", progress).trigger(processingTime="1 second").start()
    try:
        for k in range(40):  # a store that goes on past the hard limit
            if told.wait(1):
                break
            if k < 25:
                spark.createDataFrame([("busy", T0, "tick")], BEAT).coalesce(1).write.mode("append").parquet(landed)
    finally:
        query.stop()
    assert got == {"quiet": "stalled", "ready": "finished", "busy": "over limit"}


def test_snapshots(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), keep=2)
    assert table.read() is None and table.versions() == []
    one = spark.createDataFrame([(1,)], "x int")
    add = lambda k: lambda old: spark.createDataFrame([(k,)], "x int") if old is None else old.unionByName(spark.createDataFrame([(k,)], "x int"))
    assert table.commit(lambda old: one.where("false"), "w", 0) == 0 and table.read().collect() == [] and table.read().columns == ["x"]
    assert table.commit(add(1), "w", 1) == 1
    assert table.commit(add(1), "w", 1) == 1 and table.read().count() == 1  # came again
    assert table.commit(add(2), "other", 0) == 2  # another writer starts at 0
    assert table.commit(add(1), "w", 0) == 2
    assert sorted(r.x for r in table.read().collect()) == [1, 2] and [r.x for r in table.read(1).collect()] == [1]
    assert table.versions() == [1, 2]
    with pytest.raises(ValueError):
        table.read(0)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2

    # another writer commits while a change is made: the change is made again on top of what it left
    met = []

    def slow(old):
        if not met:
            met.append(table.commit(add(9), "fast", 0))
        return add(3)(old)

    assert table.commit(slow, "slow", 0) == 4 and sorted(r.x for r in table.read().collect()) == [1, 2, 3, 9]


def test_a_second_checkpoint_loses_nothing(spark, tmp_path):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    schema = "domain string, page int, http_status int, body string"

    def arrive(progress, *pages):
        spark.createDataFrame([p[1:] for p in pages], schema).coalesce(1).write.mode("append").parquet(landed)
        rows = J.ingest(spark, J.arrivals(spark, landed, spark.createDataFrame([], schema).schema, 1), state, str(tmp_path / progress), ["item_name"])
        return sorted(r.product_id for r in rows.collect())

    for k in range(3):
        got = arrive("one", page("a", k + 1, [k + 1]))
    assert got == ["1", "2", "3"]
    assert arrive("two", page("a", 9, [9])) == ["1", "2", "3", "9"]
    assert arrive("one", page("a", 8, [8])) == ["1", "2", "3", "8", "9"]
    assert len(Snapshots(spark, state).versions()) == 2  # older ones are gone
    time.sleep(0)


def test_two_phases_without_arrivals(spark, tmp_path):
    landed, schema = str(tmp_path / "landed"), "domain string, page int, http_status int, body string"
    spark.createDataFrame([], schema).write.parquet(landed)
    stream = J.arrivals(spark, landed, spark.createDataFrame([], schema).schema)
    saved = J.two_phase(spark, stream, *(str(tmp_path / x) for x in ("staging", "saved", "progress")), "r1", lambda rows: rows)
    assert saved.count() == 0 and "product_id" in saved.columns


def test_staging(spark, tmp_path):
    schema = "website string, product_id string, n int, ord long"
    staging = Staging(spark, str(tmp_path), ["website", "product_id"], "ord")
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    assert staging.read("r") is None and staging.websites("r") is None and staging.runs() == []
    staging.stage("r", rows(("b", "1", 1, 2), ("a", "1", 1, 3), ("b", "1", 2, 4)), 0, "one")
    staging.stage("r", rows(("a", "2", 5, 1)), 0, "two")
    staging.stage("r", rows(("a", "2", 9, 9)), 0, "two")  # the same batch again
    staging.stage("s", rows(("a", "1", 1, 1)))
    assert [tuple(r) for r in staging.read("r").collect()] == [("a", "2", 5, 1), ("a", "1", 1, 3), ("b", "1", 2, 4)]
    assert [r.n for r in staging.read("r", "b").collect()] == [2] and [r.website for r in staging.websites("r").collect()] == ["a", "b"]
    assert staging.read("r", version=0).count() == 2
    assert staging.runs() == ["r", "s"]
    staging.purge("r", "unknown")
    assert staging.runs() == ["s"] and staging.read("r") is None

"""Queries against their SQL where a shop lists an id twice, as it does from a million parts on; streams of wide rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tallyloom.operators import catalog as C
from tallyloom.operators import commands as M
from tallyloom.operators import reconcile as R
from tallyloom.streaming import jobs as J
from tallyloom.streaming import stateful as W

from test_queries import SF, plain
from test_runs import PAGE, page

NAMES = ["stream_dedupe", "two_phase", "stream_ingest", "stream_completeness", "catalog_diff", "range_diff", "removal_plan", "extraction_funnel", "first_seen_products", "cap_after_filter", "refresh_products", "crawl_stores"]


@pytest.fixture(scope="module")
def twice(tmp_path_factory):
    """The smallest tables, with each part once more, a million keys on: what the scrape adds to each fiftieth is there already."""
    import duckdb

    con, folder = duckdb.connect(), str(tmp_path_factory.mktemp("twice"))
    for f in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(f)[:-8]
        key = {"part": "p_partkey", "lineitem": "l_partkey"}.get(name)
        again = f" UNION ALL SELECT * REPLACE ({key} + 1000000 AS {key}) FROM '{f}'" if key else ""
        con.sql(f"COPY (SELECT * FROM '{f}'{again}) TO '{folder}/{name}.parquet'")
        con.sql(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return con, folder


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_where_ids_repeat(spark, twice, name):
    con, folder = twice
    df = __spark_entry__.queries()[name](spark, folder)
    columns = sorted(df.columns)
    wanted = con.sql(f"select {', '.join(columns)} from ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, df.select(*columns).collect())) == plain(wanted)


def test_places_of_a_page(spark, tmp_path):
    pages = spark.createDataFrame([page("a.com", 1, [1, 2, 2]), page("a.com", 2, [2, 3]), page("a.com", 3, [2, 3])], PAGE)
    rows = C.explode_products(pages).select("domain", "page", "pos", F.col("p.id").alias("product_id"))
    at = lambda keys: sorted((r.page, r.pos, r.product_id) for r in C.first_seen_products(rows, keys).collect())
    assert at(C.PRODUCT) == [(1, 0, "1"), (1, 1, "2"), (2, 1, "3")]
    assert at(C.PLACE) == [(1, 0, "1"), (1, 1, "2"), (1, 2, "2"), (2, 0, "2"), (2, 1, "3")]
    pages.withColumn("landed", F.timestamp_seconds("page")).coalesce(1).write.parquet(str(tmp_path / "landed"))
    for keys, n in ((C.PRODUCT, 3), (C.PLACE, 5)):
        stream = J.first_seen(J.arrivals(spark, str(tmp_path / "landed"), spark.read.parquet(str(tmp_path / "landed")).schema), keys)
        assert J.collected(stream, str(tmp_path / f"out{n}"), str(tmp_path / f"progress{n}")).count() == n


def test_streams_hold_few_wide_rows_and_bounded_state(spark, tmp_path):
    spark.createDataFrame([page("a.com", 1, [1])], PAGE).write.parquet(str(tmp_path / "landed"))
    name, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    before = spark.conf.get(name)
    J.run(J.arrivals(spark, str(tmp_path / "landed"), spark.createDataFrame([], PAGE).schema), str(tmp_path / "progress"), lambda rows, number, writer: seen.append(rows.sparkSession.conf.get(name)))
    assert seen == [str(J.PAGES_A_BATCH)] and spark.conf.get(name) == before
    W.with_state_store(spark, 100)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true" and spark.conf.get("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB") == "100"


def test_ids_of_a_walk_go_to_the_store_when_rows_are_through():
    class Ids(dict):
        containsKey, updateValue = dict.__contains__, dict.__setitem__

    walk = W.PageWalk(100, 1000)
    walk.ids, fresh = Ids(), {}
    assert [r[2] for r in walk._take("a", 1, ["1", "2", "1"], fresh, False)] == ["1", "2"] and not walk.ids
    assert [r[2] for r in walk._take("a", 2, ["2", "3"], fresh, False)] == ["3"]
    assert walk._store(fresh) and set(walk.ids) == {("1",), ("2",), ("3",)} and not fresh
    assert [r[2] for r in walk._take("a", 3, ["3", "4"], fresh, True)] == ["4"] and ("4",) not in walk.ids


def test_diffs_of_rows_that_repeat(spark):
    keys = ["domain", "product_id"]
    production = [("a", "1"), ("a", "1"), ("a", "2"), ("b", "1"), ("b", "1"), ("b", "2"), ("c", "9")]
    scraped = [("a", "1"), ("a", "3"), ("a", "3"), ("b", "1"), ("b", "1"), ("b", "2")]
    p, s = (spark.createDataFrame(x, "domain string, product_id string") for x in (production, scraped))
    rows = [("a", "1", "matched")] * 2 + [("a", "2", "missing")] + [("a", "3", "new")] * 2 + [("b", "1", "matched")] * 4 + [("b", "2", "matched"), ("c", "9", "missing")]
    assert sorted(map(tuple, R.catalog_diff(p, s, keys, repeats=True).collect())) == rows
    for ranges in (1, 64):
        assert sorted(map(tuple, R.digest_diff(p, s, keys, ranges, repeats=True).collect())) == rows
    assert R.catalog_diff(p, s, keys).count() == R.digest_diff(p, s, keys).count() == 6


def test_commands_read_pages_once(spark, tmp_path, monkeypatch):
    """Each body is parsed by one stage; what the walks tell is what page_counts and extract_catalog do."""
    rows = [page("a.com", 1, [1, 2, 2]), page("a.com", 2, [2, 0]), page("a.com", 3, []), page("b.com", 1, [], 503), ("c.com", 1, 200, "{}"), ("c.com", 2, 200, None)]
    pages = spark.createDataFrame(rows, PAGE)
    walks = C.extract_walks(pages)
    assert sorted(map(str, C.listed_in(walks).collect())) == sorted(map(str, C.extract_catalog(pages).collect()))
    assert sorted(map(str, C.walk_counts(walks).collect())) == sorted(map(str, C.page_counts(pages).collect()))
    parsed, parse = [], C.parse_pages
    monkeypatch.setattr(C, "parse_pages", lambda x: parsed.append(1) or parse(x))
    products = spark.createDataFrame([("a.com", "2", "old", 1, False)], "domain string, product_id string, item_name string, price_cents long, unavailable boolean")
    again = lambda repeats: M.refresh_products(M.Run(spark, str(tmp_path), f"r{repeats}"), pages, products, ["item_name"], F.lit(False), repeats=repeats)
    assert again(False).products.count() == 1 and len(parsed) == 1
    assert again(True).products.count() == 3 and len(parsed) == 2  # at its three places
    assert again(True).plan.count() == 1 and len(parsed) == 2  # all stages are there

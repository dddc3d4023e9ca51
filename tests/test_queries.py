"""A cross-section of registered queries against their DuckDB SQL at the smallest size."""

import glob
import os

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
NAMES = [
    "extract_catalog", "visible_text", "policy_weak", "category_text", "dedupe_domain", "branch_assign", "sync_branches", "catalog_diff", "removal_plan", "mark_removed", "upsert_products",
    "upsert_store", "completeness", "excluded_category", "clear_nonfashion", "quality_gate", "gallery_rule", "lead_image_rule", "product_score", "threshold_sweep", "stream_ingest", "idle_sessions", "best_policy_page",
    "verdict_join", "finalize_run", "rebuild_branches", "prune_stores", "recapture_policies", "budget_chunks", "filter_products", "live_monitor", "two_phase", "stream_completeness",
    "geocode_pick", "classify_store", "coords_backfill", "score_distribution", "drop_stats", "image_folders",
]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(rows):
    return sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    sql = __spark_entry__.oracle_sql()[name]
    wanted = duck.sql(f"select {', '.join(columns)} from ({sql})").fetchall()
    assert plain(map(tuple, df.select(*columns).collect())) == plain(wanted)


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

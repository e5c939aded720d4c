"""Physical plans of all registered batch queries."""

import re

import pytest

from tenderloom.plans.catalog import ORACLE, QUERIES

WRITES = ("r0", "j04", "w03", "k03", "k06", "s04_entries", "s06_bytes")   # work off jobs while they are built
TOP_K = ["f01_enrich_queue", "f01_analyze_queue", "f02_download_queue", "f07_unexported_minutes", "f08_minutes_without_file",
         "o01_newest_first", "o02_top_budgets", "o05_export_batch"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf):
    """Plans as they would be for large tables: nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {n: plan_of(q(spark, sf)) for n, q in QUERIES.items() if not n.startswith(WRITES)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_nested_loops(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoop" in p] == []


def test_no_global_window(plans):
    """Every window has a partition key."""
    bad = [n for n, p in plans.items() for w in re.findall(r"Window \[.*", p) if re.search(r"\], \[\], \[", w)]
    assert bad == []


def test_top_k_is_not_a_full_sort(plans):
    assert [n for n in TOP_K if "TakeOrderedAndProject" not in plans[n]] == []


def test_single_partition_only_for_totals(plans):
    """One task sees only partial aggregates or one-row results, never rows."""
    for name, plan in plans.items():
        for line in plan.splitlines():
            if "SinglePartition" in line:
                after = plan[plan.index(line) + len(line):]
                assert re.search(r"^[\s:+|-]*(\*\(\d+\) )?(HashAggregate|ObjectHashAggregate|SortAggregate)", after.lstrip("\n")), name


def test_columns_are_pruned(plans):
    assert "ReadSchema: struct<o_orderkey:bigint>" in plans["a06_without_url_id"]
    assert "html" not in plans["t03_url_parameter"].split("ReadSchema")[1]


def test_python_only_where_pages_and_archives_are_read(plans):
    python = {n for n, p in plans.items() if "Python" in p or "MapInArrow" in p or "MapInPandas" in p}
    assert all(n.startswith(("x0", "s0", "e02")) for n in python)


def test_every_query_has_sql_or_a_model():
    """The two without SQL are compared with a row-by-row model over the whole tables."""
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The tenders as a stored table, read the way stored tables are read."""
    from tenderloom import schemas as S
    from tenderloom.operators.quality import conform
    from tenderloom.sources import bindings as B
    from tenderloom.sources.tables import keyed
    path = str(tmp_path_factory.mktemp("stored") / "tenders")
    conform(B.tenders(spark, sf), S.TENDERS).write.parquet(path)
    return keyed(spark, path, S.TENDERS)


def test_queue_reaches_the_scan(stored):
    from tenderloom.operators.queue import queue
    plan = plan_of(queue(stored, "TO_ANALYZE", 20))
    assert "EqualTo(status,TO_ANALYZE)" in plan and "LessThan(retry_count,3)" in plan
    read = re.search(r"ReadSchema: struct<(.*?)>", plan)[1]
    assert {f.split(":")[0] for f in read.split(",")} == {"id", "reference", "zip_path", "estimation", "status", "retry_count", "created_at"}


def test_totals_read_only_their_columns(stored):
    import datetime as dt
    from tenderloom.operators.kpi import kpis
    read = re.search(r"ReadSchema: struct<(.*?)>", plan_of(kpis(stored, dt.date(1998, 6, 15))))[1]
    assert {f.split(":")[0] for f in read.split(",")} == {"url_id", "estimation", "status", "created_at"}


def test_upsert_reads_seeds_narrowly_and_joins_once(spark, sf, stored):
    from pyspark.sql import functions as F
    from tenderloom.operators import upsert
    from tenderloom.sources import bindings as B
    effects = upsert.upsert_effects(stored, B.listing_batch(spark, sf))
    reads = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(effects))
    assert {"id", "url_id", "reference", "hash_content"} in [{f.split(":")[0] for f in r.split(",")} for r in reads]
    whole = plan_of(upsert.apply_effects(stored, effects, F.current_timestamp()))
    assert len(re.findall(r"FullOuter", whole)) == 1

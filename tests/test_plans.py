"""What the optimizer makes of the queries: joins, shuffles, pruning, no global window on facts."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# streams and write-then-read queries run jobs while they are built; their sinks are plain scans
BUILT = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in (
    "src_tsv", "src_csv", "append_rows", "upsert_hourly", "chart_export"))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BUILT)
def test_no_cross_join_and_no_python_in_the_plan(spark, small, name):
    plan = physical(QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.fixture
def no_broadcast(spark):
    """As on large tables, where neither side of a join is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["run_summary_chunked", "run_ids_chunked", "gap_seconds_chunked", "cumsum_global"])
def test_chunked_scans_never_order_readings_by_key_alone(spark, small, name):
    """Windows over readings stay inside (key, chunk); only per-chunk summaries go by key."""
    plan = physical(QUERIES[name](spark, small))
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?), specifiedwindowframe", plan)
    over_readings = [w for w in windows if re.search(r"\btie#", w)]
    assert over_readings and all("_chunk#" in w.split(" ASC")[0] for w in over_readings)


def test_window_path_shuffles_readings_once(spark, small):
    plan = physical(QUERIES["run_summary"](spark, small))
    # the union of readings and log, and the per-device state before the range
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_chunked_path_shuffles_readings_once(spark, small):
    df = QUERIES["run_summary_chunked"](spark, small)
    df.collect()
    plan = physical(df).split("== Initial Plan ==")[0]
    rows = [l for l in plan.splitlines() if "Exchange" in l and re.search(r"watts#|hashpartitioning\(key#\d+L, _chunk", l)]
    assert any("ReusedExchange" in l and "watts#" in l for l in rows)


def test_season_dimension_is_broadcast(spark, small, no_broadcast):
    assert "BroadcastHashJoin" in physical(QUERIES["season_join"](spark, small))


def test_scan_reads_only_the_columns_and_rows_asked_for(spark, small):
    plan = QUERIES["filter_calendar"](spark, small)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    daily = QUERIES["sums_daily"](spark, small)._jdf.queryExecution().toString()
    assert "o_custkey" not in daily.split("ReadSchema")[1]


def test_top_k_is_not_a_full_sort(spark, small):
    for name in ("topk_recent", "topn_rank", "rpt_hourly"):
        assert re.search("TakeOrderedAndProject|GlobalLimit", physical(QUERIES[name](spark, small)))
    assert "WindowGroupLimit" in physical(QUERIES["rpt_daily_by_device"](spark, small))


@pytest.mark.parametrize("name", ["run_summary", "run_summary_chunked", "season_join", "bucket_join", "rpt_month_to_month"])
def test_results_do_not_depend_on_broadcast(spark, small, name, no_broadcast):
    import oracle

    got = oracle.spark_rows(QUERIES[name](spark, small))
    assert oracle.difference(got, oracle.duck_rows(oracle.connect(small), entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("rpt_close_") and n.endswith("_by_device")))
def test_close_outs_by_device_shuffle_only_periods_with_readings(spark, small, no_broadcast, name):
    """Empty periods and slots without a period are made by device and stay there: no exchange lies above them."""
    plan = physical(QUERIES[name](spark, small))
    above = re.split(r"Exchange hashpartitioning\([^\n]*key#", plan)[0]
    assert "explode(sequence(" in above and "Join" not in above
    assert name == "rpt_close_hour_sums_by_device" or "inline(slice(" in above
    assert "REPARTITION_BY_NUM" in plan.split("explode(sequence(")[1].split("Exchange")[1]  # a share of the devices, not of the bytes

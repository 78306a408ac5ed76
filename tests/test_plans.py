"""Plan shape: what must hold for the job to scale, checked on the physical plan."""

import datetime as dt
import re

from pyspark.sql import functions as F

from netbaseline.operators import active_model, resolve_assets
from netbaseline.operators.aggregate import level1
from netbaseline.plans.baseline import baseline_bounds
from netbaseline.sources import flows_from_events, group_members_from_events, modeling_params_fixture
from netbaseline.sources.control import TEST_INTERVAL
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def inputs(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    params = modeling_params_fixture(spark)
    assets = resolve_assets(active_model(params), group_members_from_events(ev))
    return flows_from_events(ev), assets


def test_scan_is_pruned_and_levels_aggregate_partially(spark):
    flows, assets = inputs(spark)
    p = plan_text(baseline_bounds(flows, assets, TEST_INTERVAL))
    # only the five columns the job needs are read from the flow table
    assert re.search(r"FileScan parquet \[ts#\d+,user_id#\d+L?,event_type#\d+,value#\d+,props#\d+\]", p), p
    # both levels aggregate map-side before their shuffle
    assert p.count("partial_sum") >= 2
    assert "partial_stddev_pop" in p
    # a small asset set is broadcast: the raw flows are filtered without a shuffle
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_large_asset_set_filters_after_level1(spark):
    flows, assets = inputs(spark)
    small = baseline_bounds(flows, assets, TEST_INTERVAL)
    large = baseline_bounds(flows, assets, TEST_INTERVAL, max_broadcast_rows=0)
    p = plan_text(large)
    # the asset join now sits above the level-1 aggregate (after its partial aggregation)
    assert "LeftSemi" not in p
    join = p.find("Join")
    level1_final = p.find("sum(in_flow")
    assert join != -1 and level1_final != -1 and join < level1_final, p
    cols = ["src_id", "direction", "sum_flow", "sum_count", "n_windows", F.col("w2.end").alias("end")]
    a, b = small.select(*cols), large.select(*cols)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_hot_asset_is_split_by_windows(spark):
    """One asset with a third of all rows: partial aggregation leaves one row per window and task."""
    t0 = dt.datetime(2024, 1, 1)
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("ast_hot")).otherwise(F.concat(F.lit("ast_"), (F.col("id") % 997).cast("string")))
        .alias("src_id"),
        F.lit("10.0.0.1").alias("src_ip"), F.lit(1).alias("src_port"), F.lit(1).alias("area_id"),
        F.lit("TCP").alias("protocol"), F.lit(10).cast("bigint").alias("in_flow"),
        F.lit(1).cast("bigint").alias("out_flow"), F.lit(None).cast("bigint").alias("r_time"),
        (F.lit(t0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 7)).alias("ts"))
    b = baseline_bounds(rows.repartition(8), None, "1h")
    hot = b.where("src_id = 'ast_hot' AND direction = 0").agg(F.sum("sum_flow"), F.sum("sum_count")).first()
    assert tuple(hot) == (10 * (n // 3), n // 3)
    # the exchanges carry partially aggregated rows, hashed on series and window (start)
    p = plan_text(b)
    m = re.search(r"Exchange hashpartitioning\(src_id#\d+[^)]*(window|__w1|_groupingexpression)#\d+", p)
    assert m, p
    assert "partial_sum(" in p[m.end():]


def test_flagship_has_no_nested_loop_join(spark):
    import __spark_entry__ as E
    df = E.flagship(spark, SF_SMALL)
    df.collect()
    p = plan_text(df)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, p


def test_flagship_reads_the_flows_once(spark):
    import __spark_entry__ as E
    df = E.flagship(spark, SF_SMALL)
    # the slots are written once; what follows reads them, not the raw flows
    assert "events.parquet" not in plan_text(df)


def test_time_filter_reaches_the_scan(spark):
    from netbaseline.plans.catalog import QUERIES
    for name in ("o10_o19_merge_profiles", "o20_upsert", "o24_clear_history"):
        df = QUERIES[name](spark, SF_SMALL)
        text = df._jdf.queryExecution().explainString(
            spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        filters = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
        assert any("LessThan(ts" in f for f in filters) and any("GreaterThanOrEqual(ts" in f for f in filters), (name, filters)


def test_size_check_moves_one_number_a_task(spark):
    from netbaseline.operators.sizing import is_small
    df = spark.range(100)
    assert is_small(df, 100) and not is_small(spark.range(101), 100)
    counted = plan_text(df.groupBy().count())
    assert "partial_count" in counted and "Limit" not in counted


def test_merge_groups_are_bounded(spark):
    """One key with thousands of addresses: one row per slot reaches the list of a key."""
    from netbaseline.operators.profile import upsert_results
    slots = spark.range(16_000).select(
        F.lit("m").alias("modeling_params_id"), F.lit("a").alias("src_id"), F.concat(F.lit("10.0.0."), "id").alias("src_ip"),
        F.lit(1).alias("area_id"), F.lit("TCP").alias("protocol"), F.lit(0).alias("up_down"),
        F.timestamp_seconds(F.col("id") * 3600).alias("window_end"), (F.col("id") % 24).cast("string").alias("name"),
        F.lit(1.0).alias("lo"), F.col("id").cast("double").alias("hi"), F.lit(0).alias("in_out"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("time"))
    df = upsert_results(None, slots)
    row = df.collect()
    assert len(row) == 1 and len(row[0]["flow"]) == 24 and row[0]["flow"][0] == ("0", "1.0-15984.0")
    p = plan_text(df)
    lists = p.find("collect_list")
    assert lists != -1 and "partial_max(struct" in p[lists:]


def test_blank_protocols_are_one_row(spark):
    from netbaseline.operators.profile import upsert_results
    rows = [("m", "a", "10.0.0.1", 1, p, 0, dt.datetime(2024, 1, 1, k), str(k), 1.0, 2.0, 0, dt.datetime(2024, 1, 1, k))
            for k, p in enumerate((None, "", "null", "\t", "TCP"))]
    slots = spark.createDataFrame(rows, "modeling_params_id string, src_id string, src_ip string, area_id int, protocol string, "
                                        "up_down int, window_end timestamp, name string, lo double, hi double, in_out int, "
                                        "time timestamp_ntz")
    out = upsert_results(None, slots).collect()
    assert sorted((r["protocol"], len(r["flow"])) for r in out) == [("", 4), ("TCP", 1)]
    assert len({r["id"] for r in out}) == 2


def test_messages_are_parsed_once(spark):
    """One ``from_json`` in the optimised plan, with the rejects dropped or kept, in a whole job too."""
    from netbaseline.sources import messages_from_events, parse_flows
    text = messages_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    optimised = lambda df: str(df._jdf.queryExecution().optimizedPlan())
    for flows in (parse_flows(text), parse_flows(text, keep_rejects=True), level1(parse_flows(text), 300),
                  parse_flows(text, keep_rejects=True).where("reject_reason is not null").groupBy("reject_reason").count()):
        assert optimised(flows).count("from_json") == 1

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from netbaseline.operators import (
    active_model, clear_history, diff_params, gate, horizon, interval_bounds, level1, level2, resolve_assets,
    split_directions, upsert_results,
)
from netbaseline.schema import MODELING_PARAMS_SCHEMA, RESULT_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
FLOW_SCHEMA = ("src_id string, src_ip string, src_port int, area_id int, protocol string, in_flow long, "
               "out_flow long, r_time long, ts timestamp")


def flows(spark, rows):
    full = [("ast_1", "10.0.0.1", 1, 3, "TCP", i, o, None, T0 + dt.timedelta(seconds=s)) for s, i, o in rows]
    return spark.createDataFrame(full, FLOW_SCHEMA)


def test_two_levels_by_hand(spark):
    df = flows(spark, [(10, 100, 10), (60, 200, 20), (360, 50, 5), (660, 70, 7)])
    l1 = level1(df, 300).orderBy("w1").collect()
    assert [(r["in_sum"], r["out_sum"], r["total_count"]) for r in l1] == [(300, 30, 2), (50, 5, 1), (70, 7, 1)]
    l2 = level2(split_directions(level1(df, 300)), 600)
    b = interval_bounds(l2, z=1.96).where("direction = 0").orderBy("w2").collect()
    first = b[0]
    assert (first["sum_flow"], first["sum_count"], first["n_windows"]) == (350, 3, 2)
    assert first["sd_flow"] == pytest.approx(125.0)
    half = 1.96 * 125.0 / math.sqrt(3)
    assert first["max_flow"] == pytest.approx(350 / 3 + half)
    assert first["min_flow"] == pytest.approx(350 / 3 - half)
    assert first["c_date"] == "2024-01-01"
    out = interval_bounds(l2).where("direction = 1").orderBy("w2").first()
    assert out["sum_flow"] == 35


def test_parity_q1_q2(spark):
    df = flows(spark, [(10, 100, 10), (60, 200, 20), (360, 50, 5)])
    l2p = level2(split_directions(level1(df, 300), parity=True), 600)
    b = interval_bounds(l2p, integer_mean=True).orderBy("direction").collect()
    # Q1: the out direction repeats the in figures; Q2: 350 div 3 = 116
    assert [r["sum_flow"] for r in b] == [350, 350]
    assert b[0]["mean_flow"] == 116.0


def params_df(spark, rows):
    return spark.createDataFrame(rows, MODELING_PARAMS_SCHEMA)


def prow(id_, switch=1, switch2=1, t=T0, groups="grp_1", mtype=1, span=1, hist=1):
    return (id_, mtype, 1, "mm", 5, span, None, 0.95, hist, 1, switch, switch2,
            '{"model_entity_group": "%s"}' % groups, "running", t)


def test_active_model_takes_newest_switched_on(spark):
    p = params_df(spark, [prow("a", t=T0), prow("b", t=T0 + dt.timedelta(days=1)),
                          prow("c", switch=0, t=T0 + dt.timedelta(days=2)),
                          prow("d", mtype=2, t=T0 + dt.timedelta(days=3))])
    assert [r["id"] for r in active_model(p).collect()] == ["b"]
    none = params_df(spark, [prow("c", switch=0)])
    assert active_model(none).count() == 0


def test_resolve_assets_exact_and_parity_q14(spark):
    p = params_df(spark, [prow("m", groups="grp_12")])
    members = spark.createDataFrame([("grp_1", "a"), ("grp_12", "b"), ("grp_123", "c"), ("grp_2", "d")],
                                    "group_id string, entity_id string")
    exact = sorted(r["entity_id"] for r in resolve_assets(p, members).collect())
    parity = sorted(r["entity_id"] for r in resolve_assets(p, members, parity=True).collect())
    assert exact == ["b"]
    assert parity == ["a", "b"]


VERSION_SCHEMA = ("id string, modify_time timestamp_ntz, model_result_span int, model_rate_timeunit string, "
                  "model_rate_timeunit_num int, model_update int, model_history_data_span int")


def test_diff_params_and_q10(spark):
    rows = [("m", T0, 1, "mm", 5, 1, 1),
            ("m", T0 + dt.timedelta(days=1), 2, "mm", 1, 1, None),
            ("m", T0 + dt.timedelta(days=2), 2, "hh", 1, 0, 3),
            ("m", T0 + dt.timedelta(days=3), None, None, None, None, None)]
    v = spark.createDataFrame(rows, VERSION_SCHEMA)
    d = diff_params(v).orderBy("modify_time").collect()
    assert [r["dimension_changed"] for r in d] == [False, True, True, False]
    assert [r["update_changed"] for r in d] == [False, False, True, False]
    assert [r["clear_history"] for r in d] == [False, False, True, False]
    assert [r["history_changed"] for r in d] == [False, False, True, False]
    assert [r["history_days"] for r in d] == [1, 1, 3, 3]
    p = diff_params(v, parity=True).orderBy("modify_time").collect()
    # Q10: the reference needs span AND number changed with the unit unchanged
    assert [r["dimension_changed"] for r in p] == [False, True, False, False]


def result_rows(spark, rows):
    return spark.createDataFrame(rows, RESULT_SCHEMA)


SLOT_SCHEMA = ("modeling_params_id string, src_id string, src_ip string, area_id int, protocol string, "
               "up_down int, window_end timestamp, name string, lo double, hi double, value string, in_out int, "
               "time timestamp_ntz")


def slot(src, name, value, hours, ip="10.0.0.1", up_down=0):
    t = T0 + dt.timedelta(hours=hours)
    lo, hi = (float(x) for x in value.split("-"))
    return ("m", src, ip, 1, "TCP", up_down, t, name, lo, hi, value, 0, t + dt.timedelta(hours=8))


def test_upsert_replaces_in_place_and_appends(spark):
    old_time = dt.datetime(2023, 12, 1, 8, 0)
    current = result_rows(spark, [
        ("id_k", "m", "k", "10.9.9.9", "TCP", [("10", "1.0-2.0"), ("11", "3.0-4.0")], 0, 0, old_time),
        ("id_u", "m", "untouched", "10.0.0.2", "TCP", [("3", "0.0-1.0")], 0, 0, old_time),
    ])
    slots = spark.createDataFrame([
        slot("k", "11", "5.0-6.0", 1), slot("k", "12", "7.0-8.0", 2), slot("k", "11", "9.0-9.5", 3),
        slot("k", "13", "1.5-2.5", 4),
        slot("new", "12", "0.5-0.6", 5), slot("new", "9", "0.7-0.8", 1, ip="8.8.8.8"),
    ], SLOT_SCHEMA)
    out = {r["src_id"]: r for r in upsert_results(current, slots).collect()}
    k = out["k"]
    assert [(s["name"], s["value"]) for s in k["flow"]] == [("10", "1.0-2.0"), ("11", "9.0-9.5"),
                                                            ("12", "7.0-8.0"), ("13", "1.5-2.5")]
    # attributes of the first write are kept
    assert (k["id"], k["src_ip"], k["time"]) == ("id_k", "10.9.9.9", old_time)
    assert [(s["name"], s["value"]) for s in out["untouched"]["flow"]] == [("3", "0.0-1.0")]
    new = out["new"]
    assert [s["name"] for s in new["flow"]] == ["9", "12"]
    assert new["src_ip"] == "8.8.8.8" and new["id"].startswith("msf_")
    assert new["time"] == T0 + dt.timedelta(hours=9)


def test_upsert_direction_key_and_q3(spark):
    slots = spark.createDataFrame([slot("k", "1", "1.0-1.0", 1, up_down=1), slot("k", "1", "2.0-2.0", 2, up_down=0)],
                                  SLOT_SCHEMA)
    assert upsert_results(None, slots).count() == 2
    ref = upsert_results(None, slots, parity=True).collect()
    # Q3: one row per (model, asset, protocol); the direction of the first write stays
    assert len(ref) == 1 and ref[0]["up_down"] == 1 and ref[0]["flow"][0]["value"] == "2.0-2.0"


def test_incremental_equals_full(spark):
    rows = [slot("k", str(h % 3), f"{h}.0-{h}.5", h) for h in range(8)]
    slots = spark.createDataFrame(rows, SLOT_SCHEMA)
    full = upsert_results(None, slots).collect()[0]
    first = upsert_results(None, slots.where(F.col("window_end") < F.lit(T0 + dt.timedelta(hours=4))))
    inc = upsert_results(first, slots.where(F.col("window_end") >= F.lit(T0 + dt.timedelta(hours=4)))).collect()[0]
    assert [tuple(s) for s in full["flow"]] == [tuple(s) for s in inc["flow"]]
    assert (full["id"], full["time"]) == (inc["id"], inc["time"])


def test_gate_and_horizon(spark):
    slots = spark.createDataFrame([slot("k", "1", "1.0-1.0", 24 * d) for d in range(5)], SLOT_SCHEMA)
    on = params_df(spark, [prow("m", hist=1)])
    off = params_df(spark, [prow("m", switch=0)])
    assert gate(slots, on).count() == 5
    assert gate(slots, off).count() == 0
    kept = horizon(slots, None, on).count()
    assert kept == 3  # first write, +1 day, +2 days
    earlier = result_rows(spark, [("x", "m", "z", "1.1.1.1", "TCP", [], 0, 1,
                                   T0 + dt.timedelta(hours=8) - dt.timedelta(days=1))])
    assert horizon(slots, earlier, on).count() == 2


def test_clear_history(spark):
    res = result_rows(spark, [("a", "m", "s1", "1.1.1.1", "TCP", [], 0, 1, T0),
                              ("b", "m", "s2", "1.1.1.1", "TCP", [], 0, 1, T0 + dt.timedelta(days=2)),
                              ("c", "other", "s3", "1.1.1.1", "TCP", [], 0, 1, T0)])
    v = spark.createDataFrame([("m", T0 - dt.timedelta(days=1), 1, "mm", 5, 1, 1),
                               ("m", T0 + dt.timedelta(days=1), 1, "mm", 5, 0, 1)], VERSION_SCHEMA)
    kept = sorted(r["id"] for r in clear_history(res, diff_params(v)).collect())
    assert kept == ["b", "c"]

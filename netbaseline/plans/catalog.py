"""Registered checks: one Spark query per operator and its SQL oracle.

Every query reads the driver's test tables (``events``) or tables Spark
derives from them, over the whole table.  The SQL side is plain ANSI-ish SQL
as DuckDB runs it, built from the same fixed values.  Times are compared as
text (``yyyy-MM-dd HH:mm:ss``, UTC unless named ``*_local``) and derived
doubles are rounded to two decimals with ``floor(x * 100 + 0.5) / 100``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from netbaseline.functions.bounds import kib_bounds
from netbaseline.functions.convert import round2, to_boolean, to_int
from netbaseline.functions.ids import result_id
from netbaseline.functions.network import internal_flag
from netbaseline.functions.text import blank_aware_equals, blank_aware_equals_ci, is_blank, to_text
from netbaseline.functions.time import local_ntz, slot_key, window_lengths, z_for_confidence, zone_date
from netbaseline.operators.aggregate import level1, level2, split_directions
from netbaseline.operators.params import active_model, active_models, clear_history, diff_params, resolve_assets
from netbaseline.operators.profile import explode_profiles, gate, horizon, slot_rows, upsert_results, written_slots
from netbaseline.operators.aggregate import interval_bounds
from netbaseline.operators.membership import keep_known_assets
from netbaseline.plans.baseline import baseline_bounds, baseline_slots, model_assets, model_config
from netbaseline.sources.control import (
    GROUP_COUNT, MEMBER_AGAIN, MEMBER_DAYS, MEMBER_LENGTH, MODELING_PARAMS_ROWS, TEST_INTERVAL, decode_profiles, encode_profiles, group_members_from_events, modeling_params_fixture,
    modeling_params_sql, output_records, param_versions_from_events, read_control_table,
)
from netbaseline.sources.flows import (
    EDGE_BAD_NUMBER, EDGE_BLANK_SOURCE, EDGE_NO_INFLOW, EDGE_NO_RTIME, EDGE_NOT_JSON, flows_from_events,
    messages_from_events, parse_flows,
)

# Fixed values of the test stream: files in time order, and which records of the first come with the last.
STREAM_FILES, LATE_EVERY = 4, 97
D1, D2 = window_lengths(TEST_INTERVAL)
W1_US, W2_US = D1 * 1_000_000, D2 * 1_000_000
# A level-2 window boundary near the middle of the test month: the first
# batch of the incremental checks ends here, so no window is split.
SPLIT_AT = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=(1_705_363_200 // D2) * D2)
# Cuts inside level-1 and level-2 windows, off any border: the batches of the cut-anywhere checks.
CUTS = (dt.datetime(2024, 1, 9, 15, 17, 3, 250_000), dt.datetime(2024, 1, 21, 2, 41, 59))
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _utc_text(c) -> F.Column:
    return F.date_format(local_ntz(c, "UTC"), TS_FMT)


def _inputs(spark: SparkSession, sf_dir: str):
    ev = _events(spark, sf_dir)
    return ev, flows_from_events(ev), modeling_params_fixture(spark), group_members_from_events(ev)


def _bounds_cols(df: DataFrame) -> DataFrame:
    return df.select(
        "src_id", "src_ip", "area_id", "protocol", "direction",
        _utc_text(F.col("w2.end")).alias("w2_end"), "c_date",
        "sum_flow", "sum_count", "n_windows",
        round2("mean_flow").alias("mean_flow"), round2("min_flow").alias("min_flow"),
        round2("max_flow").alias("max_flow"))


def _slot_cols(df: DataFrame, *more: str) -> DataFrame:
    return df.select("modeling_params_id", "src_id", "src_ip", "area_id", "protocol", "up_down",
                     _utc_text("window_end").alias("w2_end"), "name", "lo", "hi", "in_out",
                     F.date_format("time", TS_FMT).alias("time_local"), *more)


def _result_cols(df: DataFrame, *more) -> DataFrame:
    return df.select("id", "modeling_params_id", "src_id", "src_ip", "protocol", "up_down", "in_out",
                     F.date_format("time", TS_FMT).alias("time_local"), F.size("flow").alias("n_slots"), _profile_text(), *more)


def _profile_text() -> F.Column:
    """All slots of a profile in order, as ``name=low-high,...``."""
    return F.array_join(F.transform("flow", lambda s: F.concat(s["name"], F.lit("="), s["value"])), ",").alias("profile")


def _halves(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flows before and after ``SPLIT_AT``; the filter is on the stored column, so it reaches the scan."""
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    return flows_from_events(ev.where(F.col("ts") < split)), flows_from_events(ev.where(F.col("ts") >= split))


# ---------------------------------------------------------------- Spark side

def q_o01(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = F.col("event_id") % 100
    src = F.concat(F.lit("ast_"), F.col("user_id").cast("string"))
    for code, blank in EDGE_BLANK_SOURCE.items():
        src = F.when(k == code, F.lit(blank).cast("string")).otherwise(src)
    return ev.select("event_id", src.alias("src_id")).where(~is_blank("src_id"))


def q_o02(spark, sf_dir):
    msgs = messages_from_events(_events(spark, sf_dir))
    return parse_flows(msgs).drop("ts")


def q_o02_rejects(spark, sf_dir):
    msgs = messages_from_events(_events(spark, sf_dir))
    return (parse_flows(msgs, keep_rejects=True).where(F.col("reject_reason").isNotNull())
            .groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")))


def q_o05(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    rows = split_directions(level1(keep_known_assets(flows, assets)[0], D1))
    return rows.select("src_id", "src_ip", "area_id", "protocol", _utc_text(F.col("w1.end")).alias("w1_end"),
                       "direction", "flow_size", "total_count")


def q_o07(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    model = active_model(params)
    assets = resolve_assets(model, members)
    n_assets = assets.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_assets"))
    per_asset = flows.groupBy("src_id").agg(F.count(F.lit(1)).alias("n"))  # a hot asset is one row a task
    n_flows = (per_asset.join(assets, per_asset["src_id"] == assets["entity_id"])
               .groupBy("model_id").agg(F.sum("n").alias("n_flows")))
    return (model.select(F.col("id").alias("model_id"), to_int("model_result_span").alias("result_span"),
                         F.col("model_confidence_interval").alias("confidence"),
                         F.coalesce(to_int("model_history_data_span"), F.lit(1)).alias("history_days"))
            .join(n_assets, "model_id", "left").join(n_flows, "model_id", "left"))


def q_o08(spark, sf_dir):
    _, _, params, members = _inputs(spark, sf_dir)
    return resolve_assets(active_models(params), members)


def q_o08_parity(spark, sf_dir):
    _, _, params, members = _inputs(spark, sf_dir)
    return resolve_assets(active_models(params), members, parity=True)


def q_o09(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    kept, _ = keep_known_assets(flows, assets)
    return kept.drop("ts")


def q_o11(spark, sf_dir):
    _, flows, _, _ = _inputs(spark, sf_dir)
    l1 = level1(flows, D1)
    return l1.select("src_id", "src_ip", "area_id", "protocol",
                     _utc_text(F.col("w1.start")).alias("w1_start"), _utc_text(F.col("w1.end")).alias("w1_end"),
                     "in_sum", "out_sum", "total_count")


def q_o12(spark, sf_dir):
    _, flows, _, _ = _inputs(spark, sf_dir)
    l2 = level2(split_directions(level1(flows, D1)), D2)
    return l2.select("src_id", "src_ip", "area_id", "protocol", "direction",
                     _utc_text(F.col("w2.start")).alias("w2_start"), _utc_text(F.col("w2.end")).alias("w2_end"),
                     "sum_flow", "sum_count", "n_windows", round2("sd_flow").alias("sd_flow"))


def q_o13(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    return _bounds_cols(baseline_bounds(flows, assets, TEST_INTERVAL, z=1.96))


def q_o13_parity(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    return _bounds_cols(baseline_bounds(flows, assets, TEST_INTERVAL, z=1.96, parity=True))


def _slots(spark, sf_dir, flows=None):
    ev, all_flows, params, members = _inputs(spark, sf_dir)
    return baseline_slots(all_flows if flows is None else flows, params, members, TEST_INTERVAL), params


def q_o10_o19(spark, sf_dir):
    ev, flows, params, members = _inputs(spark, sf_dir)
    first, second = _halves(ev)
    cfg = model_config(params)
    assets = model_assets(params, members, cfg)
    s1 = baseline_slots(first, params, members, TEST_INTERVAL, config=cfg, assets=assets)
    s2 = baseline_slots(second, params, members, TEST_INTERVAL, config=cfg, assets=assets)
    stored = upsert_results(None, s1)
    merged = upsert_results(stored, s2)
    return explode_profiles(merged).select("src_id", "protocol", "up_down", "pos", "name", "lo", "hi")


def q_o20(spark, sf_dir):
    ev, flows, params, members = _inputs(spark, sf_dir)
    s1, s2 = _half_slots(ev, params, members)
    return _result_cols(upsert_results(upsert_results(None, s1), s2))


def _half_slots(ev, params, members):
    cfg = model_config(params)
    assets = model_assets(params, members, cfg)
    return tuple(baseline_slots(part, params, members, TEST_INTERVAL, config=cfg, assets=assets) for part in _halves(ev))


def _control_table(df: DataFrame, name: str) -> Callable[[], DataFrame]:
    """A control table derived once and written to the scratch folder; every call reads that Parquet source anew."""
    from netbaseline.session import fresh_folder
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return lambda: read_control_table(df.sparkSession, name, path=path)


def _as_parquet(df: DataFrame, name: str) -> DataFrame:
    """A control table written to the scratch folder and read as a Parquet source."""
    return _control_table(df, name)()


def q_s02_s03(spark, sf_dir):
    _, _, params, members = _inputs(spark, sf_dir)
    return resolve_assets(active_models(_as_parquet(params, "modeling_params")), _as_parquet(members, "group_members"))


def q_s04(spark, sf_dir):
    """The second half merged into stored results whose profiles are JSON text."""
    ev, _, params, members = _inputs(spark, sf_dir)
    s1, s2 = _half_slots(ev, params, members)
    before = decode_profiles(_as_parquet(encode_profiles(upsert_results(None, s1)), "model_result"))
    return _result_cols(upsert_results(before, s2))


def q_o06(spark, sf_dir):
    _, flows, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    out = output_records(baseline_bounds(flows, assets, TEST_INTERVAL, z=1.96))
    at = lambda k: F.get_json_object("record", f"$.{k}")
    return out.select("direction", at("srcId").alias("src_id"), at("srcIp").alias("src_ip"),
                      at("areaId").cast("int").alias("area_id"), at("protocol").alias("protocol"),
                      round2(at("min").cast("double")).alias("min_flow"), round2(at("max").cast("double")).alias("max_flow"),
                      F.array_join(F.json_object_keys("record"), ",").alias("keys"))


def q_o08_union_parity(spark, sf_dir):
    _, _, params, members = _inputs(spark, sf_dir)
    return model_assets(params, members, model_config(params), parity=True).select("entity_id").distinct()


def q_o20_parity(spark, sf_dir):
    ev, flows, params, members = _inputs(spark, sf_dir)
    slots = baseline_slots(flows, params, members, TEST_INTERVAL, parity=True)
    res = upsert_results(None, slots, parity=True)
    return res.select("id", "src_id", "src_ip", "protocol", "up_down", "in_out",
                      F.date_format("time", TS_FMT).alias("time_local"), F.size("flow").alias("n_slots"), _profile_text())


def q_o21(spark, sf_dir):
    ev, flows, params, members = _inputs(spark, sf_dir)
    candidates = params.where("model_type = 1 AND model_child_type = 1")
    assets = resolve_assets(candidates, members)
    # Level 1 once per series; its rows, not the raw flows, are repeated per model.
    tagged = level1(flows, D1).join(assets.select(F.col("model_id").alias("modeling_params_id"),
                                                  F.col("entity_id").alias("src_id")), "src_id")
    bounds = interval_bounds(level2(split_directions(tagged), D2))
    spans = candidates.select(F.col("id").alias("modeling_params_id"), to_int("model_result_span").alias("span"))
    slots = slot_rows(bounds.join(spans, "modeling_params_id"), None, F.col("span"))
    return _slot_cols(gate(slots, params))


def q_o22(spark, sf_dir):
    slots, params = _slots(spark, sf_dir)
    return _slot_cols(horizon(written_slots(slots), None, params, model_id=model_config(params).model_id))


def q_o23(spark, sf_dir):
    versions = param_versions_from_events(_events(spark, sf_dir))
    return diff_params(versions).withColumn("modify_time", F.date_format("modify_time", TS_FMT))


def q_o23_parity(spark, sf_dir):
    versions = param_versions_from_events(_events(spark, sf_dir))
    return (diff_params(versions, parity=True).select("id", F.date_format("modify_time", TS_FMT).alias("modify_time"),
                                                      "dimension_changed"))


def q_o24(spark, sf_dir):
    ev, flows, params, members = _inputs(spark, sf_dir)
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    s1, s2 = _half_slots(ev, params, members)
    stored = upsert_results(None, s1)
    changes = diff_params(param_versions_from_events(ev)).where(F.col("modify_time") < split)
    return _result_cols(upsert_results(clear_history(stored, changes), s2))


def q_f01_f04(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = F.col("event_id") % 8
    a = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit(" ")).when(k == 2, F.lit("null"))
         .when(k == 6, F.lit("\t")).when(k == 7, F.lit("\n "))
         .when(k == 3, F.upper(F.col("event_type"))).otherwise(F.col("event_type")))
    b = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("event_type"))
    return ev.select("event_id", is_blank(a).alias("a_blank"), blank_aware_equals(a, b).alias("same"),
                     blank_aware_equals_ci(a, b).alias("same_ci"), to_text(a).alias("a_text"))


def q_f05_f07(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = F.col("event_id") % 7
    s = (F.when(k == 0, F.col("value").cast("string"))
         .when(k == 1, F.get_json_object("props", "$.k"))
         .when(k == 2, F.concat(F.lit(" \t"), F.get_json_object("props", "$.k"), F.lit("\n")))
         .when(k == 3, F.lit("abc"))
         .when(k == 4, F.lit(""))
         .when(k == 5, F.lit("null"))
         .otherwise(F.concat(F.lit("-"), F.col("value").cast("string"))))
    words = F.element_at(F.array(*[F.lit(w) for w in ["TRUE", "yes", "1", "False", "no", "0", "\tyes", " Yes "]]),
                         (F.col("event_id") % 8 + 1).cast("int"))
    return ev.select("event_id", s.alias("s"), to_int(s).alias("as_int"), to_boolean(words).alias("as_bool"),
                     to_boolean(words, True).alias("as_bool_default_true"),
                     round2(F.when(k != 4, F.col("value") * 1.005)).alias("r2"))


def q_f08(spark, sf_dir):
    ev, flows, _, _ = _inputs(spark, sf_dir)
    return flows.select("r_time", zone_date("ts").alias("date_local"),
                        zone_date("ts", TS_FMT).alias("ts_local"),
                        zone_date("ts", "yyyy-MM-dd", "-05:00").alias("date_minus5"))


def q_f09(spark, sf_dir):
    ev = _events(spark, sf_dir)
    u = F.col("user_id")
    k = F.col("event_id") % 8
    ip = (F.when(k == 0, F.concat(F.lit("172."), (u % 40).cast("string"), F.lit(".0.1")))
          .when(k == 1, F.concat(F.lit("192."), (u % 200 + 100).cast("string"), F.lit(".1.1")))
          .when(k == 2, F.concat(F.lit("10."), (u % 256).cast("string"), F.lit(".2.3")))
          .when(k == 3, F.concat(F.lit("11.0.0."), (u % 256).cast("string")))
          .when(k == 4, F.concat((u % 300).cast("string"), F.lit(".1.1.1")))
          .when(k == 5, F.lit("not-an-ip"))
          .when(k == 6, F.concat(F.lit("172.168."), (u % 256).cast("string"), F.lit(".9")))
          .otherwise(F.concat(F.lit("8.8.8."), (u % 256).cast("string"))))
    return ev.select("event_id", ip.alias("ip"), internal_flag(ip).alias("in_out"),
                     internal_flag(ip, parity=True).alias("in_out_parity"))


def q_f10(spark, sf_dir):
    _, flows, _, _ = _inputs(spark, sf_dir)
    return flows.select("r_time", slot_key("ts", 1).alias("slot_hour"), slot_key("ts", 2).alias("slot_weekday"),
                        slot_key("ts", 3).alias("slot_month"), slot_key("ts", 4).alias("slot_month_year"))


def q_f11(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("double")
    lo_b = F.col("value") * 100.0 - k * 37.0
    hi_b = F.col("value") * 100.0 + k * 37.0
    lo, hi = kib_bounds(lo_b, hi_b)
    return ev.select("event_id", lo.alias("lo"), hi.alias("hi"))


def q_f15(spark, sf_dir):
    _, flows, _, _ = _inputs(spark, sf_dir)
    keys = flows.select("src_id", "protocol").distinct()
    return keys.select("src_id", "protocol",
                       result_id(F.lit("msf_base"), "src_id", "protocol", F.lit(0)).alias("id"))


def q_o04_sql_entry(spark, sf_dir):
    from netbaseline.functions.time import zone_date
    from netbaseline.plans.sql import sql_bounds
    _, flows, params, members = _inputs(spark, sf_dir)
    kept, _ = keep_known_assets(flows, resolve_assets(active_model(params), members))
    b = sql_bounds(kept, TEST_INTERVAL, z=1.96).withColumn("c_date", zone_date(F.col("w2.end")))
    return _bounds_cols(b)


def q_f12(spark, sf_dir):
    from netbaseline.functions.bounds import interval_text
    ev = _events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("double")
    lo, hi = kib_bounds(F.col("value") * 100.0 - k * 37.0, F.col("value") * 100.0 + k * 37.0)
    return ev.select("event_id", interval_text(lo, hi).alias("value"))


def q_o20_o22_stream(spark, sf_dir):
    from netbaseline.streaming.baseline import stream_results_from_files
    return _result_cols(stream_results_from_files(spark, sf_dir))


def q_o14_o18(spark, sf_dir):
    from netbaseline.streaming.baseline import stream_bounds_from_files
    return _bounds_cols(stream_bounds_from_files(spark, sf_dir))


def q_o14_o18_large(spark, sf_dir):
    """The same with an asset set beyond the broadcast bound."""
    from netbaseline.streaming.baseline import stream_bounds_from_files
    return _bounds_cols(stream_bounds_from_files(spark, sf_dir, max_broadcast_rows=0))


def _between(ev: DataFrame, cuts) -> list[DataFrame]:
    """The events before, between and after some times; the filter is on the stored column."""
    at = [F.lit(t).cast("timestamp_ntz") for t in cuts]
    first, last = ev.where(F.col("ts") < at[0]), ev.where(F.col("ts") >= at[-1])
    return [first, *(ev.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(at, at[1:])), last]


def _micros(t: dt.datetime) -> int:
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def q_o12_o19_cut(spark, sf_dir):
    """Interval bounds of three batches cut inside windows: the open windows' moments are carried over."""
    from netbaseline.plans.incremental import ALL, advance_bounds
    ev, _, params, members = _inputs(spark, sf_dir)
    assets = resolve_assets(active_model(params), members)
    out, held = None, None
    for part, until in zip(_between(ev, CUTS), [*map(_micros, CUTS), ALL]):
        bounds, step = advance_bounds(flows_from_events(part), assets, TEST_INTERVAL, held, until)
        out, held = bounds if out is None else out.unionByName(bounds), step.held
    return _bounds_cols(out)


def q_o19_o20_cut(spark, sf_dir):
    """The result table after three runs cut inside windows, each a version of the log of changed rows."""
    from netbaseline.plans.incremental import incremental_baseline
    from netbaseline.session import fresh_folder
    from netbaseline.streaming.log_store import ResultStore
    ev, _, params, members = _inputs(spark, sf_dir)
    store = ResultStore(spark, fresh_folder(spark, "cut-results"))
    for k, (part, until) in enumerate(zip(_between(ev, CUTS), [*CUTS, None])):
        incremental_baseline(flows_from_events(part), params, members, TEST_INTERVAL, store, until, k)
    return _result_cols(store.latest())


def _live_job(spark, sf_dir, versions=None, members=group_members_from_events, messages=False, **options):
    """The live job run over the test stream to its end; ``versions`` (None: the literal rows) and ``members`` are made from the events.

    They stand in for control tables: made once, and read anew at every batch.
    """
    from netbaseline.session import fresh_folder
    from netbaseline.sources.flows import read_flow_messages
    from netbaseline.streaming.baseline import events_in_files
    from netbaseline.streaming.live import LiveJob, start_live
    from netbaseline.streaming.log_store import ResultStore
    ev = _events(spark, sf_dir)
    out, files = fresh_folder(spark, "live"), {"maxFilesPerTrigger": spark.sparkContext.defaultParallelism}
    events_in_files(spark, sf_dir, f"{out}/in", messages)
    params = _control_table(versions(ev), "live-params") if versions else lambda: modeling_params_fixture(spark)
    job = LiveJob(ResultStore(spark, f"{out}/results"), params, _control_table(members(ev), "live-members"), TEST_INTERVAL, **options)
    if messages:
        source = read_flow_messages(spark, "text", options=files, path=f"{out}/in/part*")
    else:
        source = flows_from_events(spark.readStream.schema(ev.schema).options(**files).parquet(f"{out}/in/part*"))
    start_live(source, job, f"{out}/_checkpoint", {"availableNow": True}, parsed=not messages).awaitTermination()
    return job


def q_live(spark, sf_dir):
    """Messages to result table: text files, one parse, two models at once, open windows carried over."""
    return _result_cols(_live_job(spark, sf_dir, messages=True).store.latest())


def q_live_dropped(spark, sf_dir):
    """What the live job left out, by reason and (late records) level-1 window."""
    dropped = _live_job(spark, sf_dir, messages=True).store.dropped()
    return dropped.select("reason", _utc_text("window_start").alias("window_start"), "n")


def q_live_members(spark, sf_dir):
    """Memberships that begin and end while the stream runs."""
    from netbaseline.sources.control import dated_members_from_events
    return _result_cols(_live_job(spark, sf_dir, members=dated_members_from_events).store.latest())


def q_live_idle(spark, sf_dir):
    """A source that falls silent: the windows left open are closed by the idle timer."""
    job = _live_job(spark, sf_dir)
    job.close_idle()
    return _result_cols(job.store.latest())


def q_asof(spark, sf_dir):
    """Slots of two models judged by the parameter version in force at each window's end."""
    from netbaseline.operators.asof import after_clears, asof_slots, version_intervals, within_horizon
    from netbaseline.operators.membership import tag_known_assets
    from netbaseline.operators.open_windows import window_moments, window_stats, window_sums
    from netbaseline.sources.control import listed_versions_from_events
    from netbaseline.streaming.live import dated_assets
    ev, flows, _, members = _inputs(spark, sf_dir)
    versions = listed_versions_from_events(ev)
    intervals = _as_parquet(version_intervals(versions), "intervals")
    sums = window_sums(tag_known_assets(flows, dated_assets(versions, members)), D1)
    slots = asof_slots(window_stats(window_moments(sums, D1, D2), D2), intervals)
    return _slot_cols(within_horizon(_as_parquet(after_clears(slots, intervals), "asof-slots")), "epoch")


def q_live_epochs(spark, sf_dir):
    """The same in the stream: switches, clears and changed dimensions while it runs; one clean profile per epoch."""
    from netbaseline.sources.control import listed_versions_from_events
    job = _live_job(spark, sf_dir, versions=listed_versions_from_events)
    m, old = job.store.manifest(), job.store.closed()
    dim = F.lit(None).cast("string")
    for model, text in m.dimensions.items():
        dim = F.when(F.col("modeling_params_id") == model, F.lit(text)).otherwise(dim)
    rows = job.store.table(m).withColumn("dimension", dim)
    rows = rows if old is None else rows.unionByName(old.drop("epoch"))
    return _result_cols(rows, F.substring_index("dimension", "|", 1).cast("int").alias("epoch"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "o01_has_source_asset": q_o01,
    "o02_parse_flows": q_o02,
    "o02_parse_rejects": q_o02_rejects,
    "o05_direction_rows": q_o05,
    "o07_active_model": q_o07,
    "o08_resolve_assets": q_o08,
    "o08_resolve_assets_parity": q_o08_parity,
    "o09_known_assets": q_o09,
    "o11_level1_sums": q_o11,
    "o12_level2_stats": q_o12,
    "o13_interval_bounds": q_o13,
    "o13_interval_bounds_parity": q_o13_parity,
    "o10_o19_merge_profiles": q_o10_o19,
    "o20_upsert": q_o20,
    "o20_upsert_parity": q_o20_parity,
    "o21_gate": q_o21,
    "o22_horizon": q_o22,
    "o23_param_changes": q_o23,
    "o23_param_changes_parity": q_o23_parity,
    "o24_clear_history": q_o24,
    "f01_f04_text": q_f01_f04,
    "f05_f07_conversions": q_f05_f07,
    "f08_zone_date": q_f08,
    "f09_internal_ip": q_f09,
    "f10_slot_key": q_f10,
    "f11_normalised": q_f11,
    "f15_result_id": q_f15,
    "o04_sql_entry": q_o04_sql_entry,
    "f12_interval_text": q_f12,
    "o14_o18_stream_baseline": q_o14_o18,
    "o14_o18_stream_large_assets": q_o14_o18_large,
    "o20_o22_stream_sink": q_o20_o22_stream,
    "o12_o19_cut_windows": q_o12_o19_cut,
    "o19_o20_cut_batches": q_o19_o20_cut,
    "s01_o02_live_messages": q_live,
    "o18_dropped_records": q_live_dropped,
    "o09_live_membership": q_live_members,
    "o14_o16_idle_source": q_live_idle,
    "o07_o22_asof_parameters": q_asof,
    "o23_o24_live_epochs": q_live_epochs,
    "s02_s03_control_tables": q_s02_s03,
    "s04_initial_results": q_s04,
    "o06_output_records": q_o06,
    "o08_union_of_models_parity": q_o08_union_parity,
}


# ------------------------------------------------------------------ SQL side

def _r2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def _trim_sql(x: str) -> str:
    return f"trim({x}, E' \\t\\n\\r')"


def _blank_sql(x: str) -> str:
    return f"({x} IS NULL OR {_trim_sql(x)} = '' OR {x} = 'null')"


def _id_sql(*parts: str) -> str:
    return f"'msf_' || substr(sha256(CAST(to_json([{', '.join(parts)}]) AS VARCHAR)), 1, 22)"


def _ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _us_text(us: str) -> str:
    return _ts_text(f"make_timestamp({us})")


FLOWS_SQL = f"""
flows AS (
  SELECT 'ast_' || CAST(user_id AS VARCHAR) AS src_id,
         (CASE user_id % 4 WHEN 0 THEN '10.0.0.' WHEN 1 THEN '172.20.0.' WHEN 2 THEN '192.168.1.'
               ELSE '8.8.4.' END) || CAST(user_id % 250 AS VARCHAR) AS src_ip,
         CAST(event_id % 65536 AS INTEGER) AS src_port,
         CAST(user_id % 7 AS INTEGER) AS area_id,
         CASE event_type WHEN 'click' THEN 'TCP' WHEN 'view' THEN 'TCP' WHEN 'purchase' THEN 'UDP'
              WHEN 'signup' THEN 'UDP' WHEN 'error' THEN 'ICMP' END AS protocol,
         CAST(round(value * 100) AS BIGINT) AS in_flow,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS out_flow,
         epoch_us(ts) // 1000 AS r_time,
         ts, event_id
  FROM events),
members AS (
  SELECT DISTINCT 'grp_' || CAST(user_id % {GROUP_COUNT} AS VARCHAR) AS group_id,
                  'ast_' || CAST(user_id AS VARCHAR) AS entity_id
  FROM events),
modeling_params AS {modeling_params_sql()},
candidates AS (
  SELECT * FROM modeling_params WHERE model_type = 1 AND model_child_type = 1),
actives AS (
  SELECT * FROM candidates WHERE model_switch = 1 AND model_switch_2 = 1),
active AS (
  SELECT * FROM actives ORDER BY modify_time DESC, id DESC LIMIT 1),
"""


def _assets_sql(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT g.model_id, m.entity_id
  FROM (SELECT id AS model_id,
               trim(unnest(string_split(json_extract_string(model_alt_params, '$.model_entity_group'), ',')))
                 AS group_id
        FROM {src}) g
  JOIN members m ON m.group_id = g.group_id
  WHERE g.group_id <> '' AND m.entity_id IS NOT NULL),"""


def _levels_sql(src: str, prefix: str = "", model: bool = False, parity: bool = False, z: float = 1.96,
                exact: bool = False) -> str:
    """Both window levels and the bounds; ``exact``: the spread from whole sums and squares."""
    x = "CAST(flow_size AS HUGEINT)"
    sd = (f"sqrt(CAST(count(*) * sum({x} * {x}) - sum({x}) * sum({x}) AS DOUBLE)) / count(*)" if exact else "stddev_pop(flow_size)")
    mk = "modeling_params_id, " if model else ""
    out = "in_sum" if parity else "out_sum"
    mean = ("CAST(sum_flow // sum_count AS DOUBLE)" if parity
            else "CAST(sum_flow AS DOUBLE) / CAST(sum_count AS DOUBLE)")
    return f"""
{prefix}l1 AS (
  SELECT {mk}src_id, src_ip, area_id, protocol, epoch_us(ts) // {W1_US} AS b1,
         CAST(sum(in_flow) AS BIGINT) AS in_sum, CAST(sum(out_flow) AS BIGINT) AS out_sum,
         count(*) AS total_count
  FROM {src} GROUP BY ALL),
{prefix}l1d AS (
  SELECT {mk}src_id, src_ip, area_id, protocol, b1, 0 AS direction, in_sum AS flow_size, total_count FROM {prefix}l1
  UNION ALL
  SELECT {mk}src_id, src_ip, area_id, protocol, b1, 1 AS direction, {out} AS flow_size, total_count
  FROM {prefix}l1),
{prefix}l2 AS (
  SELECT {mk}src_id, src_ip, area_id, protocol, direction, ((b1 + 1) * {W1_US} - 1) // {W2_US} AS b2,
         CAST(sum(flow_size) AS BIGINT) AS sum_flow, CAST(sum(total_count) AS BIGINT) AS sum_count,
         {sd} AS sd_flow, count(*) AS n_windows
  FROM {prefix}l1d GROUP BY ALL),
{prefix}bounds AS (
  SELECT *, {mean} AS mean_flow,
         {mean} + {z} * sd_flow / sqrt(CAST(sum_count AS DOUBLE)) AS max_flow,
         {mean} - {z} * sd_flow / sqrt(CAST(sum_count AS DOUBLE)) AS min_flow,
         make_timestamp((b2 + 1) * {W2_US}) AS w2_end_ts,
         make_timestamp((b2 + 1) * {W2_US}) + INTERVAL 8 HOUR AS w2_end_local
  FROM {prefix}l2),"""


def _slots_sql(prefix: str, span: str = "1", model_id: str | None = "'msf_base'", more: str = "") -> str:
    mid = model_id if model_id else "modeling_params_id"
    name = (f"CAST(CASE WHEN {span} = 1 THEN hour(w2_end_local) WHEN {span} = 2 THEN isodow(w2_end_local) "
            f"WHEN {span} IN (3, 4) THEN month(w2_end_local) END AS VARCHAR)")
    lo = f"CASE WHEN {_r2('min_flow')} < 0 THEN 0.0 ELSE {_r2(_r2('min_flow') + ' / 1024')} END"
    hi = _r2(_r2("max_flow") + " / 1024")
    return f"""
{prefix}slots AS (
  SELECT {mid} AS modeling_params_id, src_id, src_ip, area_id, protocol, CAST(direction AS INTEGER) AS up_down,
         b2, w2_end_ts, {name} AS name, {lo} AS lo, {hi} AS hi,
         {_internal_sql('src_ip')} AS in_out, w2_end_local AS time{more}
  FROM {prefix}bounds),"""


IP_RE = (r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
         r"(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")


def _internal_sql(ip: str, parity: bool = False) -> str:
    a = f"CAST(split_part(trim({ip}), '.', 1) AS INTEGER)"
    b = f"CAST(split_part(trim({ip}), '.', 2) AS INTEGER)"
    extra = f" OR ({a} = 172 AND {b} = 168)" if parity else ""
    return (f"(CASE WHEN {ip} IS NULL OR NOT regexp_full_match(trim({ip}), '{IP_RE}') THEN NULL "
            f"WHEN {a} = 10 OR ({a} = 172 AND {b} BETWEEN 16 AND 31) OR ({a} = 192 AND {b} = 168){extra} "
            f"THEN 0 ELSE 1 END)")


def _bounds_select(prefix: str = "") -> str:
    return f"""
SELECT src_id, src_ip, area_id, protocol, direction, {_ts_text('w2_end_ts')} AS w2_end,
       strftime(w2_end_local, '%Y-%m-%d') AS c_date, sum_flow, sum_count, n_windows,
       {_r2('mean_flow')} AS mean_flow, {_r2('min_flow')} AS min_flow, {_r2('max_flow')} AS max_flow
FROM {prefix}bounds"""


def _slot_select(src: str) -> str:
    return f"""
SELECT modeling_params_id, src_id, src_ip, area_id, protocol, up_down, {_ts_text('w2_end_ts')} AS w2_end,
       name, lo, hi, in_out, {_ts_text('time')} AS time_local
FROM {src}"""


def _results_sql(src: str, name: str = "results") -> str:
    """Result rows of a full run: first row attributes, profile from the latest value per slot."""
    rid = _id_sql("modeling_params_id", "src_id", "coalesce(protocol, '')", "CAST(up_down AS VARCHAR)")
    return f"""
{name}_first AS (
  SELECT modeling_params_id, src_id, protocol, up_down,
         arg_min(src_ip, b2) AS src_ip, arg_min(in_out, b2) AS in_out, min(time) AS time,
         CAST(count(DISTINCT name) AS INTEGER) AS n_slots
  FROM {src} GROUP BY ALL),
{name}_slots AS (
  SELECT modeling_params_id, src_id, protocol, up_down, name, min(b2) AS first_b2,
         CAST(arg_max(lo, b2) AS VARCHAR) || '-' || CAST(arg_max(hi, b2) AS VARCHAR) AS value
  FROM {src} GROUP BY ALL),
{name}_profiles AS (
  SELECT modeling_params_id, src_id, protocol, up_down, string_agg(name || '=' || value, ',' ORDER BY first_b2) AS profile
  FROM {name}_slots GROUP BY ALL),
{name} AS (
  SELECT {rid} AS id, modeling_params_id, src_id, src_ip, protocol, up_down, in_out, time, n_slots, profile
  FROM {name}_first JOIN {name}_profiles USING (modeling_params_id, src_id, protocol, up_down)),"""


def _with(*parts: str) -> str:
    body = "".join(parts).rstrip().rstrip(",")
    return "WITH " + body.lstrip() + "\n"


KEPT_SQL = _assets_sql("assets", "active") + """
kept AS (SELECT * FROM flows WHERE src_id IN (SELECT entity_id FROM assets)),"""

# The late records of the test stream: every LATE_EVERY-th one of its first file.
ON_TIME_SQL = f"""
on_time AS (
  SELECT * FROM kept
  WHERE NOT (event_id * {STREAM_FILES} // (SELECT max(event_id) + 1 FROM events) = 0 AND event_id % {LATE_EVERY} = 0)),"""

RESULT_SELECT = f"""
SELECT id, modeling_params_id, src_id, src_ip, protocol, up_down, in_out, {_ts_text('time')} AS time_local, n_slots, profile
FROM results"""


def _profile_sql() -> str:
    return _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept"), _slots_sql(""), """
per_slot AS (
  SELECT src_id, protocol, up_down, name, arg_max(lo, b2) AS lo, arg_max(hi, b2) AS hi, min(b2) AS first_b2
  FROM slots GROUP BY ALL),""") + """
SELECT src_id, protocol, up_down,
       CAST(row_number() OVER (PARTITION BY src_id, protocol, up_down ORDER BY first_b2) - 1 AS INTEGER) AS pos,
       name, lo, hi
FROM per_slot"""


def _versions_sql() -> str:
    return """
ev_days AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'msf_base' ELSE 'msf_prev' END AS id, CAST(ts AS DATE) AS day, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
daily AS (
  SELECT id, day, max(ts) AS modify_time, count(*) AS n, max(k) AS k_max, min(k) AS k_min, sum(k) AS k_sum
  FROM ev_days GROUP BY id, day),
versions AS (
  SELECT id, modify_time,
         CASE WHEN k_max % 3 = 0 THEN 'hh' ELSE 'mm' END AS unit,
         CAST(1 + (k_min + day_of_month_ // 2) % 2 AS INTEGER) AS num,
         CAST(1 + n % 2 AS INTEGER) AS span,
         CASE WHEN day_of_month_ % 7 = 3 THEN NULL ELSE CAST(1 + k_sum % 3 AS INTEGER) END AS hist,
         CASE WHEN day_of_month_ % 5 = 0 THEN NULL ELSE CAST((k_max + day_of_month_) % 2 AS INTEGER) END AS upd
  FROM (SELECT *, dayofmonth(day) AS day_of_month_ FROM daily)),
lagged AS (
  SELECT *,
         row_number() OVER w AS rn,
         lag(span) OVER w AS p_span, lag(unit) OVER w AS p_unit, lag(num) OVER w AS p_num,
         lag(upd) OVER w AS p_upd, lag(hist) OVER w AS p_hist,
         last_value(hist IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hist_sofar
  FROM versions
  WINDOW w AS (PARTITION BY id ORDER BY modify_time)),
changes AS (
  SELECT id, modify_time,
         CASE WHEN rn = 1 THEN false ELSE
           (span IS NOT NULL AND span IS DISTINCT FROM p_span)
           OR (unit IS NOT NULL AND unit IS DISTINCT FROM p_unit)
           OR (num IS NOT NULL AND num IS DISTINCT FROM p_num) END AS dimension_changed,
         CASE WHEN rn = 1 THEN false ELSE
           (span IS NOT NULL AND span IS DISTINCT FROM p_span) AND (unit IS NOT DISTINCT FROM p_unit)
           AND (num IS NOT NULL AND num IS DISTINCT FROM p_num) END AS dimension_changed_parity,
         CASE WHEN rn = 1 THEN false ELSE upd IS NOT NULL AND upd IS DISTINCT FROM p_upd END AS update_changed,
         CASE WHEN rn = 1 THEN false ELSE upd IS NOT NULL AND upd IS DISTINCT FROM p_upd AND upd <> 1 END
           AS clear_history,
         CASE WHEN rn = 1 THEN false ELSE hist IS NOT NULL AND hist IS DISTINCT FROM p_hist END AS history_changed,
         coalesce(hist_sofar, 1) AS history_days
  FROM lagged),"""


def _split_us() -> int:
    return int((SPLIT_AT - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000


def _horizon_sql(src: str) -> str:
    """``written``: slots up to the horizon of their model (first write + 2 * history days)."""
    return f"""
limits AS (
  SELECT s.modeling_params_id,
         min(s.time) + to_days(CAST(2 * max(coalesce(a.model_history_data_span, 1)) AS INTEGER)) AS until
  FROM {src} s JOIN actives a ON a.id = s.modeling_params_id GROUP BY s.modeling_params_id),
written AS (
  SELECT s.* FROM {src} s JOIN limits l USING (modeling_params_id) WHERE s.time <= l.until),"""


def _stream_sql() -> str:
    # Append mode emits a window once the watermark (latest event time of a kept flow - 5 s) passes its end.
    return _with(FLOWS_SQL, KEPT_SQL, ON_TIME_SQL, _levels_sql("on_time"), f"""
closed AS (
  SELECT * FROM bounds
  WHERE (b2 + 1) * {W2_US} <= (SELECT epoch_us(max(ts)) - 5000000 FROM on_time)),""") + _bounds_select().replace(
        "FROM bounds", "FROM closed")


def _stream_sink_sql() -> str:
    # Finished windows only (watermark = latest event time of a kept flow - 5 s), then the
    # horizon of the model in force (first write + 2 * history days), then the result rows.
    return _with(FLOWS_SQL, KEPT_SQL, ON_TIME_SQL, _levels_sql("on_time"), _slots_sql(""), f"""
closed_slots AS (
  SELECT * FROM slots
  WHERE (b2 + 1) * {W2_US} <= (SELECT epoch_us(max(ts)) - 5000000 FROM on_time)),""", _horizon_sql("closed_slots"),
                 _results_sql("written")) + RESULT_SELECT


# ---- the live job ----

def _of_model(column: int, default: str) -> str:
    """CASE over the literal parameter rows: a column of the model's row."""
    rows = " ".join(f"WHEN '{r[0]}' THEN {r[column]}" for r in MODELING_PARAMS_ROWS if r[column] is not None)
    return f"CASE modeling_params_id {rows} ELSE {default} END"


_Z_SQL = "CASE modeling_params_id " + " ".join(f"WHEN '{r[0]}' THEN {z_for_confidence(r[7])}" for r in MODELING_PARAMS_ROWS) + " END"
_MODEL_ASSETS = _assets_sql("model_assets", "candidates")
_IS_LATE = (f"(event_id * {STREAM_FILES} // (SELECT max(event_id) + 1 FROM events) = 0 AND event_id % {LATE_EVERY} = 0)")


def _known_sql(flows: str = "flows", assets: str = _MODEL_ASSETS, inside: str = "") -> str:
    """``known``: flows of the modelled assets per model; ``on_time``: those not late; ``reached``: time up to which windows are closed."""
    return f"""{assets}
known AS (SELECT a.model_id AS modeling_params_id, f.* FROM {flows} f JOIN model_assets a ON f.src_id = a.entity_id{inside}),
on_time AS (SELECT * FROM known WHERE NOT {_IS_LATE}),
reached AS (SELECT make_timestamp(epoch_us(max(ts)) - 5000000) AS t FROM on_time),"""


def _message_flows_sql() -> str:
    """``read_flows``: the flows as their messages say, without those that can not be read."""
    bad = ", ".join(str(c) for c in (EDGE_NOT_JSON, EDGE_NO_RTIME, EDGE_BAD_NUMBER, *EDGE_BLANK_SOURCE))
    return f"""
read_flows AS (
  SELECT * REPLACE (CASE WHEN event_id % 100 = {EDGE_NO_INFLOW} THEN 0 ELSE in_flow END AS in_flow)
  FROM flows WHERE event_id % 100 NOT IN ({bad})),"""


def _live_sql(known: str, before: str = "", closed: str = "w2_end_ts <= (SELECT t FROM reached)") -> str:
    return _with(FLOWS_SQL, before, known, _levels_sql("on_time", model=True, z=_Z_SQL, exact=True),
                 _slots_sql("", span=_of_model(5, "1"), model_id=None), f"""
closed_slots AS (
  SELECT s.* FROM slots s JOIN actives a ON a.id = s.modeling_params_id AND s.time >= a.modify_time WHERE {closed}),""",
                 _horizon_sql("closed_slots"), _results_sql("written")) + RESULT_SELECT


def _live_dropped_sql(rejects: str) -> str:
    return _with(FLOWS_SQL, _message_flows_sql(), _known_sql("read_flows")) + f"""
SELECT reason, window_start, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'late' AS reason, {_us_text(f'(epoch_us(ts) // {W1_US}) * {W1_US}')} AS window_start FROM known WHERE {_IS_LATE})
GROUP BY ALL
UNION ALL SELECT reject_reason, NULL, n FROM ({rejects})"""


_DATED_ASSETS = f"""
dated AS (
  SELECT 'grp_' || CAST(u % {GROUP_COUNT} AS VARCHAR) AS group_id, 'ast_' || CAST(u AS VARCHAR) AS entity_id, first, until
  FROM (SELECT u, u % {MEMBER_DAYS} AS first, u % {MEMBER_DAYS} + {MEMBER_LENGTH} AS until FROM (SELECT DISTINCT user_id AS u FROM events)
        UNION ALL SELECT u, {MEMBER_AGAIN}, 100000 FROM (SELECT DISTINCT user_id AS u FROM events) WHERE u % 3 = 0)),
model_assets AS (
  SELECT model_id, entity_id, TIMESTAMP '2024-01-01' + to_days(CAST(first AS INTEGER)) AS valid_from,
         TIMESTAMP '2024-01-01' + to_days(CAST(until AS INTEGER)) AS valid_to
  FROM dated JOIN (
    SELECT id AS model_id, trim(unnest(string_split(json_extract_string(model_alt_params, '$.model_entity_group'), ','))) AS group_id
    FROM candidates) USING (group_id)),"""


def _asof_sql(src: str, closed: str) -> str:
    """``written``: slots of two models, judged by the version in force at the window's end, after clears and within the horizon."""
    return _versions_sql() + f"""
in_epochs AS (
  SELECT c.id, c.modify_time, v.span, c.history_days, c.clear_history, d.k_min % 4 <> 0 AS is_on,
         CAST(sum(CAST(c.dimension_changed AS INTEGER)) OVER (PARTITION BY c.id ORDER BY c.modify_time) AS INTEGER) AS epoch
  FROM changes c JOIN versions v USING (id, modify_time) JOIN daily d USING (id, modify_time)),""" + _levels_sql(
        src, model=True, exact=True) + f"""
asof_bounds AS (
  SELECT b.*, v.span, v.epoch, v.history_days FROM bounds b
  ASOF JOIN in_epochs v ON b.modeling_params_id = v.id AND b.w2_end_local >= v.modify_time WHERE v.is_on AND {closed}),""" + _slots_sql(
        "asof_", span="span", model_id=None, more=", epoch, history_days") + f"""
clears AS (
  SELECT id, epoch, max(modify_time) AS cleared FROM in_epochs
  WHERE clear_history AND {closed.replace('w2_end_local', 'modify_time').replace('w2_end_ts', 'modify_time - INTERVAL 8 HOUR')} GROUP BY ALL),
uncleared AS (
  SELECT s.* FROM asof_slots s LEFT JOIN clears c ON c.id = s.modeling_params_id AND c.epoch = s.epoch
  WHERE cleared IS NULL OR time >= cleared),
written AS (
  SELECT * FROM (SELECT *, min(time) OVER (PARTITION BY modeling_params_id, epoch) AS first_time FROM uncleared)
  WHERE time <= first_time + to_days(CAST(2 * history_days AS INTEGER))),"""


_TWO_MODELS = _assets_sql("model_assets", "(SELECT * FROM modeling_params WHERE id IN ('msf_base', 'msf_prev'))")


def _epoch_results_sql() -> str:
    out = _results_sql("written").replace("modeling_params_id, src_id, protocol, up_down", "modeling_params_id, epoch, src_id, protocol, up_down")
    return out.replace(" AS id, modeling_params_id", " AS id, epoch, modeling_params_id")


def oracle_sql() -> dict[str, str]:
    k = "event_id % 100"
    src_o01 = "'ast_' || CAST(user_id AS VARCHAR)"
    blanks = " ".join(
        f"WHEN {k} = {code} THEN {'NULL' if v is None else 'E' + repr(v)}" for code, v in EDGE_BLANK_SOURCE.items())
    o01 = f"""
SELECT event_id, src_id FROM (
  SELECT event_id, CASE {blanks} ELSE {src_o01} END AS src_id FROM events)
WHERE NOT {_blank_sql('src_id')}"""
    blank_codes = ", ".join(str(c) for c in EDGE_BLANK_SOURCE)
    o02 = _with(FLOWS_SQL.replace("ts, event_id\n  FROM events)", "ts, event_id % 100 AS k\n  FROM events)")) + f"""
SELECT src_id, src_ip, src_port, area_id, protocol,
       CASE WHEN k = {EDGE_NO_INFLOW} THEN CAST(0 AS BIGINT) ELSE in_flow END AS in_flow, out_flow, r_time
FROM flows
WHERE k NOT IN ({EDGE_NOT_JSON}, {EDGE_NO_RTIME}, {EDGE_BAD_NUMBER}, {blank_codes})"""
    o02_rejects = f"""
SELECT reject_reason, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 100 = {EDGE_NOT_JSON} THEN 'not_json'
              WHEN event_id % 100 IN ({blank_codes}) THEN 'no_source_asset'
              WHEN event_id % 100 = {EDGE_BAD_NUMBER} THEN 'bad_number'
              WHEN event_id % 100 = {EDGE_NO_RTIME} THEN 'no_event_time' END AS reject_reason
  FROM events)
WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""
    o05 = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept")) + f"""
SELECT src_id, src_ip, area_id, protocol, {_us_text(f'(b1 + 1) * {W1_US}')} AS w1_end, direction, flow_size,
       total_count
FROM l1d"""
    o07 = _with(FLOWS_SQL, KEPT_SQL) + """
SELECT a.id AS model_id, a.model_result_span AS result_span, a.model_confidence_interval AS confidence,
       coalesce(a.model_history_data_span, 1) AS history_days,
       (SELECT count(*) FROM assets) AS n_assets,
       (SELECT count(*) FROM flows f JOIN assets s ON f.src_id = s.entity_id) AS n_flows
FROM active a"""
    o08 = _with(FLOWS_SQL, _assets_sql("assets", "actives")) + "SELECT model_id, entity_id FROM assets"
    o08_parity = _with(FLOWS_SQL) + """
SELECT DISTINCT p.id AS model_id, m.entity_id
FROM actives p JOIN members m
  ON contains(json_extract_string(p.model_alt_params, '$.model_entity_group'), m.group_id)
WHERE m.entity_id IS NOT NULL"""
    o09 = _with(FLOWS_SQL, KEPT_SQL) + """
SELECT src_id, src_ip, src_port, area_id, protocol, in_flow, out_flow, r_time FROM kept"""
    o11 = _with(FLOWS_SQL, _levels_sql("flows")) + f"""
SELECT src_id, src_ip, area_id, protocol, {_us_text(f'b1 * {W1_US}')} AS w1_start,
       {_us_text(f'(b1 + 1) * {W1_US}')} AS w1_end, in_sum, out_sum, total_count
FROM l1"""
    o12 = _with(FLOWS_SQL, _levels_sql("flows")) + f"""
SELECT src_id, src_ip, area_id, protocol, direction, {_us_text(f'b2 * {W2_US}')} AS w2_start,
       {_us_text(f'(b2 + 1) * {W2_US}')} AS w2_end, sum_flow, sum_count, n_windows, {_r2('sd_flow')} AS sd_flow
FROM l2"""
    o13 = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept")) + _bounds_select()
    o13_parity = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept", parity=True)) + _bounds_select()
    slots_full = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept"), _slots_sql(""))
    o10_o19 = _profile_sql()
    o20 = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept"), _slots_sql(""), _results_sql("slots")) + RESULT_SELECT
    kept_parity = """
kept AS (
  SELECT * FROM flows WHERE src_id IN (
    SELECT m.entity_id FROM actives p JOIN members m
      ON contains(json_extract_string(p.model_alt_params, '$.model_entity_group'), m.group_id))),"""
    o20_parity = _with(FLOWS_SQL, kept_parity, _levels_sql("kept", parity=True), _slots_sql(""), """
slot_values AS (
  SELECT modeling_params_id, src_id, protocol, name, min(b2) AS first_b2,
         CAST(arg_max(lo, (b2, up_down)) AS VARCHAR) || '-' || CAST(arg_max(hi, (b2, up_down)) AS VARCHAR) AS value
  FROM slots GROUP BY ALL),
profiles AS (
  SELECT modeling_params_id, src_id, protocol, string_agg(name || '=' || value, ',' ORDER BY first_b2) AS profile
  FROM slot_values GROUP BY ALL),
firsts AS (
  SELECT modeling_params_id, src_id, protocol,
         arg_min(src_ip, (b2, up_down)) AS src_ip, arg_min(in_out, (b2, up_down)) AS in_out,
         arg_min(up_down, (b2, up_down)) AS up_down, min(time) AS time, CAST(count(DISTINCT name) AS INTEGER) AS n_slots
  FROM slots GROUP BY ALL),""") + """
SELECT """ + _id_sql("modeling_params_id", "src_id", "coalesce(protocol, '')") + """ AS id, src_id, src_ip, protocol,
       up_down, in_out, strftime(time, '%Y-%m-%d %H:%M:%S') AS time_local, n_slots, profile
FROM firsts JOIN profiles USING (modeling_params_id, src_id, protocol)"""
    o21 = _with(FLOWS_SQL, _assets_sql("cand_assets", "candidates"), """
tagged AS (
  SELECT a.model_id AS modeling_params_id, f.* FROM flows f JOIN cand_assets a ON f.src_id = a.entity_id),""",
                _levels_sql("tagged", model=True), """
spanned AS (
  SELECT b.*, c.model_result_span AS span FROM bounds b JOIN candidates c ON b.modeling_params_id = c.id),""",
                _slots_sql("", span="span", model_id=None).replace("FROM bounds", "FROM spanned"), """
gated AS (SELECT * FROM slots WHERE modeling_params_id IN (SELECT id FROM actives)),""") + _slot_select("gated")
    o22 = slots_full.rstrip() + ",\n" + """
limits AS (
  SELECT s.modeling_params_id, min(s.time) + to_days(CAST(2 * max(coalesce(a.model_history_data_span, 1)) AS INTEGER))
         AS until
  FROM slots s JOIN actives a ON a.id = s.modeling_params_id GROUP BY s.modeling_params_id),
kept_slots AS (
  SELECT s.* FROM slots s JOIN limits l USING (modeling_params_id) WHERE s.time <= l.until)
""" + _slot_select("kept_slots")
    o23 = _with(_versions_sql()) + """
SELECT id, strftime(modify_time, '%Y-%m-%d %H:%M:%S') AS modify_time, dimension_changed, update_changed,
       clear_history, history_changed, history_days
FROM changes"""
    o23_parity = _with(_versions_sql()) + """
SELECT id, strftime(modify_time, '%Y-%m-%d %H:%M:%S') AS modify_time, dimension_changed_parity AS dimension_changed
FROM changes"""
    split_us = _split_us()
    o24 = _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept"), _slots_sql(""), _versions_sql(), f"""
cleared AS (
  SELECT max(modify_time) AS cleared_at FROM changes
  WHERE clear_history AND id = 'msf_base' AND modify_time < make_timestamp({split_us})),
first_half AS (
  SELECT modeling_params_id, src_id, protocol, up_down, min(time) AS t1
  FROM slots WHERE (b2 + 1) * {W2_US} <= {split_us} GROUP BY ALL),
survivors AS (
  SELECT * FROM first_half WHERE (SELECT cleared_at FROM cleared) IS NULL OR t1 >= (SELECT cleared_at FROM cleared)),
contributing AS (
  SELECT s.* FROM slots s
  WHERE (s.b2 + 1) * {W2_US} > {split_us}
     OR EXISTS (SELECT 1 FROM survivors v WHERE v.modeling_params_id = s.modeling_params_id
                AND v.src_id = s.src_id AND v.protocol = s.protocol AND v.up_down = s.up_down)),""",
                _results_sql("contributing")) + RESULT_SELECT
    a, b = _blank_sql("a"), _blank_sql("b")
    f01 = f"""
SELECT event_id, {a} AS a_blank,
       CASE WHEN {a} AND {b} THEN true WHEN {a} OR {b} THEN false ELSE a = b END AS same,
       CASE WHEN {a} AND {b} THEN true WHEN {a} OR {b} THEN false ELSE lower(a) = lower(b) END AS same_ci,
       coalesce(a, '') AS a_text
FROM (SELECT event_id,
             CASE event_id % 8 WHEN 6 THEN E'\\t' WHEN 7 THEN E'\\n ' WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'null' WHEN 3 THEN upper(event_type)
                  ELSE event_type END AS a,
             CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS b
      FROM events)"""
    f05 = f"""
SELECT event_id, s,
       CASE WHEN {_blank_sql('s')} THEN NULL
            WHEN contains({_trim_sql('s')}, '.') THEN CAST(trunc(TRY_CAST({_trim_sql('s')} AS DOUBLE)) AS INTEGER)
            ELSE TRY_CAST({_trim_sql('s')} AS INTEGER) END AS as_int,
       CASE WHEN lower({_trim_sql('w')}) IN ('true', 'yes', '1') THEN true
            WHEN lower({_trim_sql('w')}) IN ('false', 'no', '0') THEN false ELSE false END AS as_bool,
       CASE WHEN lower({_trim_sql('w')}) IN ('true', 'yes', '1') THEN true
            WHEN lower({_trim_sql('w')}) IN ('false', 'no', '0') THEN false ELSE true END AS as_bool_default_true,
       CASE WHEN event_id % 7 = 4 THEN 0.0 ELSE {_r2('value * 1.005')} END AS r2
FROM (SELECT event_id, value,
             CASE event_id % 7 WHEN 0 THEN CAST(value AS VARCHAR)
                  WHEN 1 THEN json_extract_string(props, '$.k')
                  WHEN 2 THEN E' \\t' || json_extract_string(props, '$.k') || E'\\n'
                  WHEN 3 THEN 'abc' WHEN 4 THEN '' WHEN 5 THEN 'null'
                  ELSE '-' || CAST(value AS VARCHAR) END AS s,
             (['TRUE', 'yes', '1', 'False', 'no', '0', E'\\tyes', ' Yes '])[event_id % 8 + 1] AS w
      FROM events)"""
    f08 = _with(FLOWS_SQL) + """
SELECT r_time, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date_local,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS ts_local,
       strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS date_minus5
FROM flows"""
    ip = """CASE event_id % 8
        WHEN 0 THEN '172.' || CAST(user_id % 40 AS VARCHAR) || '.0.1'
        WHEN 1 THEN '192.' || CAST(user_id % 200 + 100 AS VARCHAR) || '.1.1'
        WHEN 2 THEN '10.' || CAST(user_id % 256 AS VARCHAR) || '.2.3'
        WHEN 3 THEN '11.0.0.' || CAST(user_id % 256 AS VARCHAR)
        WHEN 4 THEN CAST(user_id % 300 AS VARCHAR) || '.1.1.1'
        WHEN 5 THEN 'not-an-ip'
        WHEN 6 THEN '172.168.' || CAST(user_id % 256 AS VARCHAR) || '.9'
        ELSE '8.8.8.' || CAST(user_id % 256 AS VARCHAR) END"""
    f09 = f"""
SELECT event_id, ip, {_internal_sql('ip')} AS in_out, {_internal_sql('ip', parity=True)} AS in_out_parity
FROM (SELECT event_id, {ip} AS ip FROM events)"""
    f10 = _with(FLOWS_SQL) + """
SELECT r_time, CAST(hour(ts + INTERVAL 8 HOUR) AS VARCHAR) AS slot_hour,
       CAST(isodow(ts + INTERVAL 8 HOUR) AS VARCHAR) AS slot_weekday,
       CAST(month(ts + INTERVAL 8 HOUR) AS VARCHAR) AS slot_month,
       CAST(month(ts + INTERVAL 8 HOUR) AS VARCHAR) AS slot_month_year
FROM flows"""
    lo_b = "(value * 100.0 - CAST(json_extract_string(props, '$.k') AS DOUBLE) * 37.0)"
    hi_b = "(value * 100.0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) * 37.0)"
    f11 = f"""
SELECT event_id,
       CASE WHEN {_r2(lo_b)} < 0 THEN 0.0 ELSE {_r2(_r2(lo_b) + ' / 1024')} END AS lo,
       {_r2(_r2(hi_b) + ' / 1024')} AS hi
FROM events"""
    f12 = f"""
SELECT event_id, CAST(lo AS VARCHAR) || '-' || CAST(hi AS VARCHAR) AS value FROM (
  SELECT event_id,
         CASE WHEN {_r2(lo_b)} < 0 THEN 0.0 ELSE {_r2(_r2(lo_b) + ' / 1024')} END AS lo,
         {_r2(_r2(hi_b) + ' / 1024')} AS hi
  FROM events)"""
    f15 = _with(FLOWS_SQL) + """
SELECT src_id, protocol,
       """ + _id_sql("'msf_base'", "src_id", "coalesce(protocol, '')", "'0'") + """ AS id
FROM (SELECT DISTINCT src_id, protocol FROM flows)"""
    return {
        "o01_has_source_asset": o01,
        "o02_parse_flows": o02,
        "o02_parse_rejects": o02_rejects,
        "o05_direction_rows": o05,
        "o07_active_model": o07,
        "o08_resolve_assets": o08,
        "o08_resolve_assets_parity": o08_parity,
        "o09_known_assets": o09,
        "o11_level1_sums": o11,
        "o12_level2_stats": o12,
        "o13_interval_bounds": o13,
        "o13_interval_bounds_parity": o13_parity,
        "o10_o19_merge_profiles": o10_o19,
        "o20_upsert": o20,
        "o20_upsert_parity": o20_parity,
        "o21_gate": o21,
        "o22_horizon": o22,
        "o23_param_changes": o23,
        "o23_param_changes_parity": o23_parity,
        "o24_clear_history": o24,
        "f01_f04_text": f01,
        "f05_f07_conversions": f05,
        "f08_zone_date": f08,
        "f09_internal_ip": f09,
        "f10_slot_key": f10,
        "f11_normalised": f11,
        "f15_result_id": f15,
        "o04_sql_entry": o13,
        "f12_interval_text": f12,
        "o14_o18_stream_baseline": _stream_sql(),
        "o14_o18_stream_large_assets": _stream_sql(),
        "o20_o22_stream_sink": _stream_sink_sql(),
        "o12_o19_cut_windows": _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept", exact=True)) + _bounds_select(),
        "o19_o20_cut_batches": _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept", exact=True), _slots_sql(""), _horizon_sql("slots"),
                                     _results_sql("written")) + RESULT_SELECT,
        "s01_o02_live_messages": _live_sql(_known_sql("read_flows"), _message_flows_sql()),
        "o18_dropped_records": _live_dropped_sql(o02_rejects),
        "o09_live_membership": _live_sql(_known_sql(assets=_DATED_ASSETS, inside=" AND f.ts >= a.valid_from AND f.ts < a.valid_to")),
        "o14_o16_idle_source": _live_sql(_known_sql(), closed="true"),
        "o07_o22_asof_parameters": _with(FLOWS_SQL, _known_sql(assets=_TWO_MODELS), _asof_sql("known", "true")) + _slot_select("written").replace(
            "\nFROM", ", epoch\nFROM"),
        "o23_o24_live_epochs": _with(FLOWS_SQL, _known_sql(assets=_TWO_MODELS), _asof_sql("on_time", "w2_end_ts <= (SELECT t FROM reached)"),
                                     _epoch_results_sql()) + RESULT_SELECT.replace("\nFROM", ", epoch\nFROM"),
        "s02_s03_control_tables": o08,
        "s04_initial_results": o20,
        "o06_output_records": _with(FLOWS_SQL, KEPT_SQL, _levels_sql("kept")) + f"""
SELECT direction, src_id, src_ip, area_id, protocol, {_r2('min_flow')} AS min_flow, {_r2('max_flow')} AS max_flow,
       'srcId,srcIp,areaId,protocol,min,max' AS keys
FROM bounds""",
        "o08_union_of_models_parity": _with(FLOWS_SQL) + """
SELECT DISTINCT m.entity_id FROM actives p JOIN members m
  ON contains(json_extract_string(p.model_alt_params, '$.model_entity_group'), m.group_id)""",
    }

"""The live job, batch by batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from netbaseline.operators.asof import in_force, version_intervals
from netbaseline.operators.membership import tag_known_assets
from netbaseline.schema import MODELING_PARAMS_SCHEMA
from netbaseline.sources.control import local_table
from netbaseline.streaming import IdleCloser, LiveJob, ResultStore

T0 = dt.datetime(2024, 1, 1)
FLOW = "src_id string, src_ip string, src_port int, area_id int, protocol string, in_flow long, out_flow long, r_time long, ts timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def flows(spark, *rows):
    """Rows of (asset, minutes after T0, bytes in)."""
    made = [(a, "10.0.0.1", 1, 1, "TCP", n, 2 * n, int((at(m) - dt.datetime(1970, 1, 1)).total_seconds() * 1000), at(m)) for a, m, n in rows]
    return spark.createDataFrame(made, FLOW).withColumn("ts", F.timestamp_millis("r_time"))


def params(spark, *rows):
    """Versions of (model, modified, span, switch, mode, groups), hours after T0 in the model zone."""
    made = [(i, 1, 1, "mm", 5, span, None, 0.95, 7, mode, on, 1, f'{{"model_entity_group": "{g}"}}', "running",
             T0 + dt.timedelta(hours=8 + h)) for i, h, span, on, mode, g in rows]
    return local_table(spark, made, MODELING_PARAMS_SCHEMA)


def members(spark, *pairs):
    return spark.createDataFrame(list(pairs), "group_id string, entity_id string")


def job_of(spark, scratch, versions, people, **options):
    return LiveJob(ResultStore(spark, f"{scratch}/results", buckets=2), lambda: versions, lambda: people, "", **options)


def profiles(job):
    return {(r["modeling_params_id"], r["src_id"], r["up_down"]): [tuple(x) for x in r["flow"]] for r in job.store.latest().collect()}


def dropped(job):
    table = job.store.dropped()
    return {} if table is None else {(r["reason"], r["window_start"] and r["window_start"].replace(tzinfo=None)): r["n"] for r in table.collect()}


def test_windows_carry_over_late_flows_are_kept_aside_and_replays_change_nothing(spark, scratch):
    job = job_of(spark, scratch, params(spark, ("m", -1, 1, 1, 1, "g")), members(spark, ("g", "a")))
    batches = [[("a", 1, 100), ("x", 50, 1)], [("a", 4, 50), ("a", 7, 30), ("a", 12, 1)], [("a", 2, 999), ("a", 13, 5), ("a", 21, 7)],
               [("a", 3, 1), ("a", 40, 9)]]
    for k, rows in enumerate(batches):
        job.step(flows(spark, *rows), "q", k)
    first = job.store.manifest()
    assert job.step(flows(spark, *batches[-1]), "q", 3) == first == job.store.manifest()
    # The window of minutes 0-10 holds 150 and 30, and not what came after it had closed.
    one = ResultStore(spark, f"{scratch}/one", buckets=2)
    whole = LiveJob(one, job.versions, job.members, "")
    whole.step(flows(spark, *batches[0], *batches[1], ("a", 13, 5), ("a", 21, 7), ("a", 40, 9)), "q", 0)
    assert profiles(job) == profiles(whole) and len(profiles(job)[("m", "a", 0)]) == 1
    assert dropped(job) == {("late", at(0)): 2}


def test_unreadable_messages_are_counted_once(spark, scratch):
    job = job_of(spark, scratch, params(spark, ("m", -1, 1, 1, 1, "g")), members(spark, ("g", "a")))
    lines = ["no json", '{"SrcID": " ", "rTime": 1}', '{"SrcID": "a"}', '{"SrcID": "a", "rTime": 1704067260000, "InFlow": "x"}',
             '{"SrcID": "a", "rTime": 1704067260000, "InFlow": 5}', "no json either"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    for _ in range(2):
        job.on_messages(df, "q", 0)
    want = {("not_json", None): 2, ("no_source_asset", None): 1, ("no_event_time", None): 1, ("bad_number", None): 1}
    assert dropped(job) == want
    empty = job_of(spark, f"{scratch}/none", params(spark, ("m", -1, 1, 1, 1, "g")), members(spark, ("other", "a")))
    empty.on_messages(df, "q", 0)
    assert dropped(empty) == want


def test_assets_come_and_go(spark, scratch):
    """Members without dates count from the batch that first reads them; dated ones by the time of the flow."""
    people = [members(spark, ("g", "a")), members(spark, ("g", "b"))]
    job = LiveJob(ResultStore(spark, f"{scratch}/results", buckets=2), lambda: params(spark, ("m", -1, 1, 1, 1, "g")), lambda: people[0], "")
    job.step(flows(spark, ("a", 1, 10), ("b", 1, 10)), "q", 0)
    people.pop(0)
    job.step(flows(spark, ("a", 11, 10), ("b", 11, 10)), "q", 1)
    job.step(flows(spark, ("a", 31, 10), ("b", 31, 10)), "q", 2)
    assert {k[1] for k in profiles(job)} == {"a", "b"}
    assert job.store.open_windows(job.store.manifest()).level1.select("src_id").distinct().count() == 1
    assets = spark.createDataFrame([("m", "a", at(0), at(10)), ("m", "a", at(5), at(20)), ("m", "b", None, at(3)), ("n", "a", at(15), None)],
                                   "model_id string, entity_id string, valid_from timestamp, valid_to timestamp")
    some = flows(spark, ("a", 0, 1), ("a", 7, 2), ("a", 10, 3), ("a", 19, 4), ("a", 20, 5), ("b", 2, 6), ("b", 3, 7), ("c", 1, 8))
    for bound in (100, 0):
        got = sorted((r["modeling_params_id"], r["in_flow"]) for r in tag_known_assets(some, assets, bound).collect())
        assert got == [("m", 1), ("m", 2), ("m", 3), ("m", 4), ("m", 6), ("n", 4), ("n", 5)]


def test_idle_source_closes_its_windows(spark, scratch):
    job = job_of(spark, scratch, params(spark, ("m", -1, 1, 1, 1, "g")), members(spark, ("g", "a")))
    job.step(flows(spark, ("a", 1, 10), ("a", 6, 20)), "q", 0)
    assert profiles(job) == {}
    now = job.store.manifest().at
    assert job.close_idle(300, now + 299) is None and profiles(job) == {}
    IdleCloser(job, 0).onQueryIdle(None)
    assert {k[:2] for k in profiles(job)} == {("m", "a")} and job.close_idle(0) is None
    job.step(flows(spark, ("a", 9, 5), ("a", 11, 5)), "q", 1)
    assert dropped(job) == {("late", at(5)): 1}


def test_models_switch_off_and_over_and_change_dimension(spark, scratch):
    """Windows are judged by the version in force at their end; a changed span closes the profile of the old one."""
    versions = params(spark, ("m", -1, 1, 1, 1, "g"), ("m", 2, 1, 0, 1, "g"), ("m", 3, 2, 1, 1, "g"), ("n", -1, 1, 0, 1, "h"), ("n", 1, 1, 1, 1, "h"))
    job = job_of(spark, scratch, versions, members(spark, ("g", "a"), ("h", "b")))
    for k, hour in enumerate((0, 1, 2, 3, 4)):
        job.step(flows(spark, ("a", 60 * hour + 1, 10), ("b", 60 * hour + 1, 10), ("a", 60 * hour + 30, 1), ("b", 60 * hour + 30, 1)), "q", k)
    job.close_idle()
    live = profiles(job)
    assert [x[0] for x in live[("m", "a", 0)]] == ["1"]                      # weekday of the windows from 3 h on
    assert [x[0] for x in live[("n", "b", 0)]] == ["9", "10", "11", "12"]    # hours from 1 h on, in +08:00
    closed = job.store.closed().where("up_down = 0").collect()
    assert [(r["src_id"], [x[0] for x in r["flow"]], r["dimension"].split("|")[1]) for r in closed] == [("a", ["8", "9"], "1")]


def test_clears_drop_what_is_stored(spark, scratch):
    versions = params(spark, ("m", -1, 1, 1, 1, "g"), ("m", 2, 1, 1, 0, "g"))
    job = job_of(spark, scratch, versions, members(spark, ("g", "a")))
    for k, hour in enumerate((0, 1, 2, 3)):
        job.step(flows(spark, ("a", 60 * hour + 1, 10), ("a", 60 * hour + 30, 1)), "q", k)
    job.close_idle()
    assert [x[0] for x in profiles(job)[("m", "a", 0)]] == ["10", "11"]
    assert job.store.closed() is None


def test_versions_in_force_by_broadcast_and_by_day(spark, monkeypatch):
    from netbaseline.operators import asof
    versions = params(spark, *(("m", 24 * k, 1 + k % 2, 1, 1, "g") for k in range(6)))
    intervals = version_intervals(versions)
    rows = spark.createDataFrame([("m", T0 + dt.timedelta(hours=8 + h)) for h in (-1, 0, 5, 24, 47, 48, 130, 4000)],
                                 "modeling_params_id string, t timestamp").select(
        "modeling_params_id", F.col("t").cast("timestamp_ntz").alias("t"))
    want = sorted((r["t"], r["epoch"], r["span"]) for r in in_force(rows, intervals, "t").collect())
    monkeypatch.setattr(asof, "is_small", lambda df: False)
    assert sorted((r["t"], r["epoch"], r["span"]) for r in in_force(rows, intervals, "t").collect()) == want
    assert [x[1] for x in want] == [0, 0, 1, 1, 2, 5, 5]


def test_open_windows_of_other_lengths_are_refused(spark, scratch):
    job = job_of(spark, scratch, params(spark, ("m", -1, 1, 1, 1, "g")), members(spark, ("g", "a")))
    job.step(flows(spark, ("a", 1, 10)), "q", 0)
    job.interval = "1h"
    with pytest.raises(ValueError, match="are open"):
        job.step(flows(spark, ("a", 2, 10)), "q", 1)

import datetime as dt
import time

from pyspark.sql import functions as F

from netbaseline.operators import resolve_assets, active_model
from netbaseline.plans.baseline import baseline_bounds, batch_baseline
from netbaseline.sources import flows_from_events, group_members_from_events, modeling_params_fixture
from netbaseline.sources.control import TEST_INTERVAL
from netbaseline.streaming import ResultStore, make_batch_sink, start_stream_baseline
from tests.conftest import SF_SMALL

BOUND_COLS = ["src_id", "src_ip", "area_id", "protocol", "direction", "sum_flow", "sum_count", "n_windows"]


def write_parts(spark, events, folder, n=4):
    """Events as n files in time order, then a far-future sentinel row for a modelled asset."""
    # events are sorted by ts with rising event_id, so id ranges are time ranges
    top = events.agg(F.max("event_id")).first()[0] + 1
    for i in range(n):
        part = events.where((F.col("event_id") >= top * i // n) & (F.col("event_id") < top * (i + 1) // n))
        part.coalesce(1).write.parquet(f"{folder}/part{i}")
        time.sleep(0.05)
    sentinel = events.where("user_id = 0").limit(1).withColumn(
        "ts", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    sentinel.coalesce(1).write.parquet(f"{folder}/part{n}")


def stream_of(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{folder}/part*"))


def test_stream_equals_batch(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    write_parts(spark, events, f"{scratch}/in")
    params = modeling_params_fixture(spark)
    assets = resolve_assets(active_model(params), group_members_from_events(events))
    stream = flows_from_events(stream_of(spark, f"{scratch}/in", events.schema))
    q = (baseline_bounds(stream, assets, TEST_INTERVAL).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(f"{scratch}/out"))
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out").select(*BOUND_COLS, F.col("w2.end").alias("end"))
    want = baseline_bounds(flows_from_events(events), assets, TEST_INTERVAL).select(
        *BOUND_COLS, F.col("w2.end").alias("end"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_late_rows_are_dropped(spark, scratch):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    t = dt.datetime(2024, 1, 1, 0, 0, 0)

    def ev(i, seconds, value):
        return (i, t + dt.timedelta(seconds=seconds), 0, "click", value, '{"k": 1}')

    files = [
        [ev(1, 10, 1.0), ev(2, 200, 2.0), ev(3, 1200, 4.0)],          # max 00:20:00
        [ev(4, 1500, 8.0)],                                             # watermark -> 00:24:55
        [ev(5, 1560, 0.25)],                                            # one batch between; -> 00:25:55
        [ev(6, 1194, 16.0), ev(7, 900, 32.0),                           # windows already closed: dropped
         ev(8, 1554, 0.5)],                                             # 6 s behind, window open: kept
        [ev(9, 10 ** 8, 64.0)],                                         # sentinel closes the rest
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/part{i}")
        time.sleep(0.05)
    stream = flows_from_events(stream_of(spark, f"{scratch}/in", schema))
    q = (baseline_bounds(stream, None, "").writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(f"{scratch}/out"))
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out").where("direction = 0")
    total = got.agg(F.sum("sum_flow")).first()[0]
    # bytes = value * 100; the late 1600 and 3200 are not counted, the open-window 50 is
    assert total == 100 + 200 + 400 + 800 + 25 + 50


def test_stream_job_matches_batch_and_replay_is_idempotent(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    write_parts(spark, events, f"{scratch}/in")
    params = modeling_params_fixture(spark)
    members = group_members_from_events(events)
    stream = flows_from_events(stream_of(spark, f"{scratch}/in", events.schema))
    q = start_stream_baseline(stream, lambda: modeling_params_fixture(spark), members, TEST_INTERVAL,
                              f"{scratch}/results", f"{scratch}/ckpt", trigger={"availableNow": True}, keep_versions=100)
    q.awaitTermination()
    store = ResultStore(spark, f"{scratch}/results")
    versions = store.versions()
    assert [v.number for v in versions] == list(range(len(versions))) and len(versions) >= 2
    got = store.latest()
    want = batch_baseline(flows_from_events(events), params, members, TEST_INTERVAL)
    cols = ["id", "modeling_params_id", "src_id", "src_ip", "protocol", "flow", "up_down", "in_out", "time"]
    assert got.count() == want.count() > 0
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0

    # Replaying the last batch writes nothing and leaves the table as it is.
    last = versions[-1]
    sink = make_batch_sink(store, lambda: modeling_params_fixture(spark), query_id=lambda: last.query_id)
    sink(baseline_bounds(flows_from_events(events), None, TEST_INTERVAL), last.batch_id)
    assert store.versions() == versions
    store.expire(1)
    assert [v.number for v in store.versions()] == [last.number]


def modelled_bounds(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assets = resolve_assets(active_model(modeling_params_fixture(spark)), group_members_from_events(events))
    return baseline_bounds(flows_from_events(events), assets, TEST_INTERVAL).cache()


def slots_of(df):
    return sorted((r["src_id"], r["protocol"], r["up_down"], x["name"], x["value"]) for r in df.collect() for x in r["flow"])


def halves(bounds):
    split = F.lit(dt.datetime(2024, 1, 8)).cast("timestamp")  # within the write horizon of 14 days
    return bounds.where(F.col("w2.end") <= split), bounds.where(F.col("w2.end") > split)


def versions_of(spark, *times_and_modes):
    schema = ("id string, modify_time timestamp_ntz, model_result_span int, model_rate_timeunit string, "
              "model_rate_timeunit_num int, model_update int, model_history_data_span int")
    return spark.createDataFrame([("msf_base", t, 1, "mm", 360, m, 7) for t, m in times_and_modes], schema)


def test_a_new_checkpoint_continues_an_old_store(spark, scratch):
    """Batch ids start at 0 again, yet nothing is taken for a replay and nothing is lost."""
    first, second = halves(modelled_bounds(spark))
    params, store = (lambda: modeling_params_fixture(spark)), ResultStore(spark, f"{scratch}/results")
    make_batch_sink(store, params, query_id=lambda: "one")(first, 0)
    make_batch_sink(store, params, query_id=lambda: "two")(second, 0)
    assert [(v.number, v.query_id, v.batch_id) for v in store.versions()] == [(0, "one", 0), (1, "two", 0)]
    other = ResultStore(spark, f"{scratch}/other")
    sink = make_batch_sink(other, params, query_id=lambda: "one")
    sink(first, 0)
    sink(second, 1)
    assert slots_of(store.latest()) == slots_of(other.latest()) != slots_of(store.read(0))


def test_sink_applies_each_history_clear_once(spark, scratch):
    first, second = halves(modelled_bounds(spark))
    params = lambda: modeling_params_fixture(spark)
    plain = ResultStore(spark, f"{scratch}/plain")
    for k, part in enumerate((first, second)):
        make_batch_sink(plain, params)(part, k)
    # A clear that is there from the start, dated after all data, is the baseline: nothing is dropped.
    late = versions_of(spark, (dt.datetime(2023, 12, 1), 1), (dt.datetime(2025, 1, 1), 0))
    kept = ResultStore(spark, f"{scratch}/kept")
    for k, part in enumerate((first, second)):
        make_batch_sink(kept, params, lambda: late)(part, k)
    assert slots_of(kept.latest()) == slots_of(plain.latest())
    # A clear that appears between two batches drops what is stored, once.
    start = versions_of(spark, (dt.datetime(2023, 12, 1), 1))
    cleared = ResultStore(spark, f"{scratch}/cleared")
    make_batch_sink(cleared, params, lambda: start)(first, 0)
    make_batch_sink(cleared, params, lambda: late)(second, 1)
    only_second = ResultStore(spark, f"{scratch}/second")
    make_batch_sink(only_second, params)(second, 0)
    assert slots_of(cleared.latest()) == slots_of(only_second.latest())
    make_batch_sink(cleared, params, lambda: late)(first, 2)
    assert set(slots_of(cleared.latest())) > set()
    assert {x[:3] for x in slots_of(only_second.latest())} <= {x[:3] for x in slots_of(cleared.latest())}


def test_mirror_is_repeated_after_a_crash(spark, scratch, monkeypatch):
    from netbaseline.streaming import baseline as B, jdbc as S
    done = []
    monkeypatch.setattr(B, "upsert_to_jdbc", lambda rows, options, execute: done.append(rows.count()))
    bounds = modelled_bounds(spark)
    store = ResultStore(spark, f"{scratch}/results")
    sink = make_batch_sink(store, lambda: modeling_params_fixture(spark), jdbc_options={"dbtable": "t"}, query_id=lambda: "q")
    sink(bounds, 0)
    sink(bounds, 0)  # the replay of a batch whose mirror may be missing
    assert len(store.versions()) == 1 and len(done) == 2 and done[0] == done[1] > 0
    text = S.upsert_statement("results", "results_staging")
    assert text.startswith("INSERT INTO results (") and "FROM results_staging" in text
    assert text.endswith("ON DUPLICATE KEY UPDATE `flow` = s.`flow`") and "TRUNCATE" not in text.upper()


def test_sink_stops_when_another_model_comes_into_force(spark, scratch):
    import pytest
    store = ResultStore(spark, f"{scratch}/results")
    sink = make_batch_sink(store, lambda: modeling_params_fixture(spark), model_id="msf_older")
    with pytest.raises(RuntimeError, match="has replaced"):
        sink(modelled_bounds(spark), 0)
    assert store.versions() == []


def test_sink_starts_from_an_existing_table(spark, scratch):
    from netbaseline.sources.control import encode_profiles
    first, second = halves(modelled_bounds(spark))
    params = lambda: modeling_params_fixture(spark)
    whole = ResultStore(spark, f"{scratch}/whole")
    for k, part in enumerate((first, second)):
        make_batch_sink(whole, params)(part, k)
    store = ResultStore(spark, f"{scratch}/results")
    make_batch_sink(store, params, initial=encode_profiles(whole.read(0)))(second, 0)
    assert slots_of(store.latest()) == slots_of(whole.latest())


def test_watermark_follows_modelled_assets_whatever_their_number(spark, scratch):
    """A far-ahead record of an asset outside the model closes no window, with a small and with a large asset set."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    t = dt.datetime(2024, 1, 1)

    def ev(i, seconds, value, user=0):
        return (i, t + dt.timedelta(seconds=seconds), user, "click", value, '{"k": 1}')

    files = [[ev(1, 10, 1.0)], [ev(2, 90_000, 9.0, user=5)], [ev(3, 95_000, 9.0, user=5)], [ev(4, 20, 2.0)], [ev(5, 10 ** 8, 64.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/part{i}")
        time.sleep(0.05)
    assets = spark.createDataFrame([("m", "ast_0")], "model_id string, entity_id string")
    sums = []
    for bound in (1000, 0):
        stream = flows_from_events(stream_of(spark, f"{scratch}/in", schema))
        q = (baseline_bounds(stream, assets, "", max_broadcast_rows=bound).writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{scratch}/ckpt{bound}").trigger(availableNow=True).start(f"{scratch}/out{bound}"))
        q.awaitTermination()
        sums.append(spark.read.parquet(f"{scratch}/out{bound}").where("direction = 0").agg(F.sum("sum_flow")).first()[0])
    assert sums == [300, 300]


def test_text_message_stream_source(spark, scratch):
    """S1 without Kafka: JSON lines read as a file stream, parsed once, same bounds as batch."""
    from netbaseline.sources import messages_from_events, parse_flows, read_flow_messages
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    top = events.agg(F.max("event_id")).first()[0] + 1
    for i in range(2):
        part = events.where((F.col("event_id") >= top * i // 2) & (F.col("event_id") < top * (i + 1) // 2))
        messages_from_events(part).coalesce(1).write.text(f"{scratch}/msgs/part{i}")
        time.sleep(0.05)
    sentinel = messages_from_events(events.where("user_id = 0").limit(1).withColumn(
        "ts", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")), plant_edges=False)
    sentinel.coalesce(1).write.text(f"{scratch}/msgs/part2")
    params = modeling_params_fixture(spark)
    assets = resolve_assets(active_model(params), group_members_from_events(events))
    stream = parse_flows(read_flow_messages(spark, "text", stream=True, options={"maxFilesPerTrigger": 1},
                                            path=f"{scratch}/msgs/part*"))
    q = (baseline_bounds(stream, assets, TEST_INTERVAL).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(f"{scratch}/out"))
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out").select(*BOUND_COLS, F.col("w2.end").alias("end"))
    batch_msgs = read_flow_messages(spark, "text", stream=False, path=f"{scratch}/msgs/part[01]")
    want = baseline_bounds(parse_flows(batch_msgs), assets, TEST_INTERVAL).select(
        *BOUND_COLS, F.col("w2.end").alias("end"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_messages_are_made_after_the_events_are_dealt(spark):
    """A range of ids lies in few blocks of the table: made before the shuffle, its messages were made by few tasks."""
    from netbaseline.streaming.baseline import _dealt
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id < 10")
    plan = _dealt(events, True)._jdf.queryExecution().executedPlan().toString()
    assert "SrcID" in plan.split("Exchange RoundRobin")[0] and "SrcID" not in plan.split("Exchange RoundRobin")[1]
    assert _dealt(events, True).count() == 10 and _dealt(events, False).columns == events.columns


def test_control_tables_of_the_live_queries_are_made_once(spark, scratch, monkeypatch):
    """Every batch reads them anew, but not the whole events to make them again."""
    from netbaseline.plans import catalog
    from netbaseline.sources.control import group_members_from_events, listed_versions_from_events
    from netbaseline.streaming import baseline, live

    class Ended:
        def awaitTermination(self):
            pass

    monkeypatch.setattr(baseline, "events_in_files", lambda *a: None)
    monkeypatch.setattr(live, "start_live", lambda *a, **k: Ended())
    monkeypatch.setattr("netbaseline.session.fresh_folder", lambda _, name: f"{scratch}/{name}")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.limit(1).write.parquet(f"{scratch}/live/in/part0")
    job = catalog._live_job(spark, SF_SMALL, versions=listed_versions_from_events)
    for read, made in ((job.members, group_members_from_events(events)), (job.versions, listed_versions_from_events(events))):
        assert not any("events.parquet" in f for f in read().inputFiles())
        assert read().schema.names == made.schema.names and read().exceptAll(made).isEmpty() and read().count() == made.count()

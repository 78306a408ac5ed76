"""Batches cut anywhere, and the log of changed rows they are written to."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from netbaseline.operators import active_model, resolve_assets
from netbaseline.operators.open_windows import advance
from netbaseline.plans.baseline import batch_baseline
from netbaseline.plans.incremental import advance_bounds, incremental_baseline
from netbaseline.session import written
from netbaseline.sources import flows_from_events, group_members_from_events, modeling_params_fixture
from netbaseline.sources.control import TEST_INTERVAL
from netbaseline.streaming import ResultStore, log_store
from tests.conftest import SF_SMALL

BOUNDS = ["src_id", "src_ip", "area_id", "protocol", "direction", "w2", "sum_flow", "sum_count", "sd_flow", "n_windows",
          "mean_flow", "min_flow", "max_flow"]
# Inside a 6 h window and inside a 30 h window, both off any border.
CUTS = [dt.datetime(2024, 1, 9, 15, 17, 3, 250_000), dt.datetime(2024, 1, 21, 2, 41, 59)]


def inputs(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    params, members = modeling_params_fixture(spark), group_members_from_events(events)
    return events, params, members


def parts_of(events, cuts):
    edges = [dt.datetime(2000, 1, 1), *cuts, dt.datetime(2100, 1, 1)]
    return [events.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
            for a, b in zip(edges, edges[1:])]


def profiles(df):
    return sorted(str((r["id"], r["src_ip"], r["up_down"], r["in_out"], r["time"], [tuple(x) for x in r["flow"]])) for r in df.collect())


def micros(t):
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def test_bounds_do_not_depend_on_cuts_or_partitions(spark):
    """Three batches cut inside windows, in other partitions, give the uncut run's numbers to the last bit."""
    events, params, members = inputs(spark)
    assets = resolve_assets(active_model(params), members)
    whole, _ = advance_bounds(flows_from_events(events), assets, TEST_INTERVAL, None, 1 << 62)
    want = whole.select(*BOUNDS)
    got, held = None, None
    for part, until in zip(parts_of(events, CUTS), [*map(micros, CUTS), 1 << 62]):
        bounds, step = advance_bounds(flows_from_events(part.repartition(5)), assets, TEST_INTERVAL, held, until)
        held = step.held
        bounds = bounds.select(*BOUNDS)
        got = bounds if got is None else got.unionByName(bounds)
        assert step.late.isEmpty()
    assert held.level1.isEmpty() and held.level2.isEmpty()
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_month_cut_inside_windows_gives_the_uncut_table(spark, scratch):
    events, params, members = inputs(spark)
    store = ResultStore(spark, f"{scratch}/cut")
    for k, (part, until) in enumerate(zip(parts_of(events, CUTS), [*CUTS, None])):
        run = incremental_baseline(flows_from_events(part), params, members, TEST_INTERVAL, store, until, k)
        assert run.version.number == k and run.late.isEmpty()
    one = ResultStore(spark, f"{scratch}/one")
    incremental_baseline(flows_from_events(events), params, members, TEST_INTERVAL, one, None, 0)
    want = profiles(batch_baseline(flows_from_events(events), params, members, TEST_INTERVAL))
    assert profiles(store.latest()) == profiles(one.latest()) == want and want


def test_a_repeated_run_changes_nothing(spark, scratch):
    events, params, members = inputs(spark)
    first, second, _ = parts_of(events, CUTS)
    store = ResultStore(spark, f"{scratch}/results")
    for k, (part, until) in enumerate(((first, CUTS[0]), (second, CUTS[1]), (second, CUTS[1]))):
        run = incremental_baseline(flows_from_events(part), params, members, TEST_INTERVAL, store, until, min(k, 1))
    assert run.late is None and [m.number for m in store.versions()] == [0, 1]


def test_late_sums_are_handed_back(spark, scratch):
    events, params, members = inputs(spark)
    first, second, _ = parts_of(events, CUTS)
    early = first.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 3)).cast("timestamp_ntz"))
    store = ResultStore(spark, f"{scratch}/results")
    incremental_baseline(flows_from_events(first), params, members, TEST_INTERVAL, store, CUTS[0], 0)
    plain = ResultStore(spark, f"{scratch}/plain")
    incremental_baseline(flows_from_events(first), params, members, TEST_INTERVAL, plain, CUTS[0], 0)
    run = incremental_baseline(flows_from_events(second.unionByName(early)), params, members, TEST_INTERVAL, store, CUTS[1], 1)
    incremental_baseline(flows_from_events(second), params, members, TEST_INTERVAL, plain, CUTS[1], 1)
    assets = resolve_assets(active_model(params), members)
    known = flows_from_events(early).join(assets.select(F.col("entity_id").alias("src_id")), "src_id", "left_semi").count()
    assert run.late.agg(F.sum("total_count")).first()[0] == known > 0
    assert profiles(store.latest()) == profiles(plain.latest())


def test_other_window_lengths_need_closed_windows(spark, scratch):
    events, params, members = inputs(spark)
    first, second, _ = parts_of(events, CUTS)
    store = ResultStore(spark, f"{scratch}/results")
    incremental_baseline(flows_from_events(first), params, members, TEST_INTERVAL, store, CUTS[0], 0)
    with pytest.raises(ValueError, match="are open"):
        incremental_baseline(flows_from_events(second), params, members, "1h", store, CUTS[1], 1)


# ---- the log ----

def table(spark, n, value="1.0-2.0", first=0):
    return spark.range(first, first + n).select(
        F.concat(F.lit("msf_"), "id").alias("id"), F.lit("m").alias("modeling_params_id"),
        F.concat(F.lit("ast_"), "id").alias("src_id"), F.lit("10.0.0.1").alias("src_ip"), F.lit("TCP").alias("protocol"),
        F.array(F.struct(F.lit("1").alias("name"), F.concat(F.lit(value), F.col("id").cast("string")).alias("value"))).alias("flow"),
        F.lit(0).alias("up_down"), F.lit(0).alias("in_out"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("time"))


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def put(store, rows, batch=-1, **options):
    m = store.manifest()
    old = store.touched(m, rows.select(*store.key)) if m is not None else None
    return store.commit(rows, "q", batch, replaced=None if old is None else written(old, "old"), **options)


def values(df):
    return {r["src_id"]: r["flow"][0]["value"] for r in df.collect()}


def test_a_batch_writes_what_it_changes(spark, scratch):
    """One per cent of the keys: about one per cent of the bytes; all keys: no rewrite beside the changes."""
    root = scratch.removeprefix("file:")
    store = ResultStore(spark, scratch, buckets=4)
    put(store, table(spark, 200_000), 0)
    base = size_of(root)
    put(store, table(spark, 2_000, "9.0-9.5", 500), 1)
    assert size_of(root) - base < 0.03 * base
    got = values(store.latest())
    assert len(got) == 200_000 and got["ast_600"] == "9.0-9.5600" and got["ast_5"] == "1.0-2.05"
    assert values(store.read(0))["ast_600"] == "1.0-2.0600"
    before = size_of(root)
    m = put(store, table(spark, 200_000, "3.0-4.0"), 2)
    assert all(len(e) == 1 for e in m.buckets.values()) and size_of(root) - before < 1.2 * base
    assert values(store.latest())["ast_600"] == "3.0-4.0600"
    store.expire(1)
    assert size_of(root) < 1.2 * base and len(store.versions()) == 1 and len(values(store.latest())) == 200_000


def test_buckets_are_rewritten_when_changes_outgrow_them(spark, scratch):
    store = ResultStore(spark, scratch, buckets=2)
    put(store, table(spark, 100), 0)
    for k in range(1, 6):
        m = put(store, table(spark, 10, f"{k}.0-{k}.5", 10 * k), k)
        assert all(sum(x[1] for x in e[1:]) <= log_store.COMPACT_SHARE * e[0][1] for e in m.buckets.values())
    assert sum(m.live.values()) == 100
    got = values(store.latest())
    assert [got[f"ast_{10 * k}"] for k in range(6)] == ["1.0-2.00", *(f"{k}.0-{k}.5{10 * k}" for k in range(1, 6))]
    m = put(store, table(spark, 50, "7.0-7.5", 80), 6)
    assert sum(m.live.values()) == 130 == store.latest().count()


def test_a_crashed_commit_leaves_the_version_before(spark, scratch, monkeypatch):
    store = ResultStore(spark, scratch)
    put(store, table(spark, 50), 0)

    def crash(self, m):
        raise OSError("gone")
    with monkeypatch.context() as patch:
        patch.setattr(ResultStore, "_publish", crash)
        with pytest.raises(OSError):
            put(store, table(spark, 50, "8.0-8.5"), 1)
    assert store.find("q", 1) is None and values(store.latest())["ast_1"] == "1.0-2.01"
    put(store, table(spark, 50, "5.0-5.5"), 1)
    assert store.find("q", 1) is not None and values(store.latest())["ast_1"] == "5.0-5.51"
    with pytest.raises(RuntimeError, match="another writer"):
        store._publish(store.manifest())


def test_first_write_and_closed_epochs_come_from_the_manifest(spark, scratch):
    store = ResultStore(spark, scratch)
    put(store, table(spark, 5), 0, dimensions={"m": "1||6"})
    assert store.manifest().first_write == {"m": "2024-01-01 00:00:00.000000"}
    store.commit(table(spark, 2, "2.0-3.0"), "q", 1, close={"m": "1||6"}, dimensions={"m": "2||6"})
    assert values(store.latest()) == {"ast_0": "2.0-3.00", "ast_1": "2.0-3.01"}
    old = store.closed()
    assert old.count() == 5 and {(r["epoch"], r["dimension"]) for r in old.collect()} == {(0, "1||6")}
    store.commit(table(spark, 1, "4.0-4.5", 9), "q", 2, drop_models=["m"])
    assert values(store.latest()) == {"ast_9": "4.0-4.59"} and store.closed().count() == 5
    assert store.open_windows(store.manifest()) is None


def test_a_batch_writes_again_only_sums_up_to_the_last_held_window(spark):
    """Later sums are whole as they come: they are neither merged nor written twice, and moments take one shuffle."""
    d1, d2 = 60, 300
    sums = lambda rows: spark.createDataFrame(
        [("a", "i", 1, "TCP", m * 60_000_000, n, 2 * n, *(count or [1])) for m, n, *count in rows],
        "src_id string, src_ip string, area_id int, protocol string, w1 long, in_sum long, out_sum long, total_count long")
    kept = {}

    def keep(df, name):
        kept[name] = (df.count(), df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return written(df, name)

    first = advance(sums([(0, 5), (3, 7)]), None, 3 * 60_000_000, d1, d2, False, keep)
    assert first.held.level1.count() == 1
    step = advance(sums([(1, 9), (3, 1), *((m, m) for m in range(4, 40))]), first.held, 39 * 60_000_000, d1, d2, False, keep)
    assert kept["level1-sums"][0] == 1 and kept["level2-moments"][1] == 1
    assert [r["total_count"] for r in step.late.collect()] == [1]
    assert [(r["w1"], r["in_sum"]) for r in step.held.level1.collect()] == [(39 * 60_000_000, 39)]
    whole = advance(sums([(0, 5), (3, 8, 2), *((m, m) for m in range(4, 40))]), None, 39 * 60_000_000, d1, d2, False, written)
    both = [sorted(map(tuple, x.select(sorted(x.columns)).collect()), key=str) for s in (step, whole) for x in (s.closed, s.held.level2)]
    assert both[:2] == both[2:] and both[0]

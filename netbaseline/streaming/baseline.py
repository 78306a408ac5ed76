"""The baseline job as a Structured Streaming query.

``flows`` (any streaming DataFrame of flow records, e.g. Kafka -> parse_flows)
-> known assets (stream-static semi join) -> level 1 -> directions -> level 2
-> bounds runs as one append-mode query with two stateful window aggregates
and a 5-second watermark.  Each micro-batch of finished level-2 windows goes
to ``foreachBatch``, which reads the control tables afresh, applies gate,
horizon and history clears, and writes the changed rows of the result table.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from netbaseline.functions.time import MODEL_ZONE
from netbaseline.operators.params import diff_params
from netbaseline.operators.open_windows import OpenWindows
from netbaseline.operators.profile import RESULT_COLUMNS, gate, horizon, key_columns, slot_rows, upsert_results
from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS
from netbaseline.plans.baseline import baseline_bounds, model_assets, model_config
from netbaseline.session import fresh_folder, scratch_root, written
from netbaseline.sources.control import decode_profiles, local_table
from netbaseline.sources.flows import messages_from_events
from netbaseline.streaming.jdbc import upsert_to_jdbc
from netbaseline.streaming.log_store import Manifest, ResultStore

KEEP_VERSIONS = 4  # of the result table, by a running query


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """Set the shuffle width only while a streaming query starts.

    A stateful query fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` at its first start (kept in the
    checkpoint afterwards); size it to the stream, not to the session default.
    """
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def newest_clears(versions: DataFrame, parity: bool = False) -> dict[str, str]:
    """Per model the time of its newest history clear (one entry per model of the control table)."""
    rows = (diff_params(versions, parity).where("clear_history").groupBy("id")
            .agg(F.date_format(F.max("modify_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).collect())
    return {r["id"]: r["t"] for r in rows}


def first_writes(spark: SparkSession, m: Manifest | None) -> DataFrame | None:
    """``(modeling_params_id, time)``: the first write of every model, from the manifest alone."""
    if m is None or not m.first_write:
        return None
    schema = StructType([StructField("modeling_params_id", StringType()), StructField("time", StringType())])
    rows = local_table(spark, sorted(m.first_write.items()), schema)
    return rows.select("modeling_params_id", F.col("time").cast("timestamp_ntz").alias("time"))


def dimension(cfg) -> str:
    """What a model's slots mean; a profile holds slots of one dimension only."""
    return f"{cfg.result_span}|{cfg.rate_unit}|{cfg.rate_number}"


def merge_slots(store: ResultStore, slots: DataFrame, params: DataFrame, cfg, query_id: str, batch_id: int,
                clears: dict[str, str] | None = None, parity: bool = False, initial: DataFrame | None = None,
                held: OpenWindows | None = None, lengths: tuple[int, int] | None = None) -> Manifest:
    """Gate, horizon and keyed merge of one batch's slot rows: only rows of their keys are read back and written.

    Each history clear drops its model's rows once, when it is first seen;
    those that are there when a table begins are its baseline.  When the
    dimension of the model in force has changed, its rows are closed as an
    epoch of their own (:meth:`ResultStore.closed`) and its profiles start anew.
    """
    m, gone = store.manifest(), []
    if m is None and initial is not None:
        m = store.commit(decode_profiles(initial).select(*RESULT_COLUMNS), clears=clears)
    clears = clears or {}
    close = {}
    if m is not None:
        gone = [model for model, t in clears.items() if t > m.clears.get(model, "")]
        before = m.dimensions.get(cfg.model_id)
        if before is not None and before != dimension(cfg):
            close = {cfg.model_id: before}
    fresh = {*gone, *close}
    firsts = first_writes(store.spark, m)
    if firsts is not None and fresh:
        firsts = firsts.where(~F.col("modeling_params_id").isin(list(fresh)))
    slots = horizon(gate(slots, params, model_id=cfg.model_id), firsts, params, model_id=cfg.model_id)
    replaced = store.touched(m, slots.select(*store.key).distinct()) if m is not None else None
    if replaced is not None:
        replaced = written(replaced.where(~F.col("modeling_params_id").isin(list(fresh))) if fresh else replaced, "replaced-rows")
    return store.commit(upsert_results(replaced, slots, parity), query_id, batch_id, clears, gone, replaced, held, lengths,
                        close, {cfg.model_id: dimension(cfg)})


def make_batch_sink(store: ResultStore, params_reader: Callable[[], DataFrame],
                    versions_reader: Callable[[], DataFrame] | None = None,
                    parity: bool = False, zone: str = MODEL_ZONE, jdbc_options: dict | None = None,
                    query_id: Callable[[], str] = lambda: "", model_id: str | None = None,
                    initial: DataFrame | None = None, jdbc_execute=None, keep_versions: int | None = None):
    """The ``foreachBatch`` function: bounds of one micro-batch -> new version of the result table.

    A micro-batch in which no window finished writes nothing (the control
    checks, like the reference's, run when results arrive).  A batch that
    ``query_id()`` has already written is not written again.  History clears
    and changed dimensions: see :func:`merge_slots`.  ``initial`` is the
    table to start from (profiles as JSON text or arrays) while the store is
    empty.  With ``model_id`` the sink stops the query when another model
    comes into force, as its windows were computed for that one.  With
    ``jdbc_options`` the rows of the touched keys are merged into a JDBC table
    after each write, and again on a replay.  With ``keep_versions`` older
    versions are removed after each write.
    """

    def mirror(m: Manifest, bounds: DataFrame, cfg) -> None:
        if jdbc_options:
            keys = slot_rows(bounds, cfg.model_id, cfg.result_span, zone, parity).select(*key_columns(parity)).distinct()
            rows = store.touched(m, keys)
            if rows is not None:
                upsert_to_jdbc(rows, jdbc_options, jdbc_execute)

    def sink(bounds: DataFrame, batch_id: int) -> None:
        bounds = bounds.persist()
        try:
            if bounds.isEmpty():
                return  # no window finished: the table is unchanged, nothing is rewritten
            params = params_reader()
            cfg = model_config(params, parity)
            if cfg is None:
                return  # no model switched on: nothing is written
            if model_id is not None and cfg.model_id != model_id:
                raise RuntimeError(f"model {cfg.model_id} has replaced {model_id}: start a new query for it")
            done = store.find(query_id(), batch_id)
            if done is not None:
                mirror(done, bounds, cfg)  # the run before may have ended in between
                return
            clears = newest_clears(versions_reader(), parity) if versions_reader is not None else {}
            slots = slot_rows(bounds, cfg.model_id, cfg.result_span, zone, parity)
            m = merge_slots(store, slots, params, cfg, query_id(), batch_id, clears, parity, initial)
            mirror(m, bounds, cfg)
            if keep_versions:
                store.expire(keep_versions)
        finally:
            bounds.unpersist()

    return sink


def start_stream_baseline(flows: DataFrame, params_reader: Callable[[], DataFrame], members: DataFrame,
                          interval: str | None, store_root: str, checkpoint: str,
                          versions_reader: Callable[[], DataFrame] | None = None,
                          parity: bool = False, zone: str = MODEL_ZONE, trigger: dict | None = None,
                          jdbc_options: dict | None = None, state_partitions: int | None = None,
                          initial: DataFrame | None = None,
                          max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, keep_versions: int | None = KEEP_VERSIONS):
    """Start the streaming job; returns the ``StreamingQuery``.

    The result table keeps its newest ``keep_versions`` versions.  The asset set is resolved from the control tables at start and
    checkpointed; restart the query (e.g. ``availableNow`` on a schedule) to
    pick up new group members.  ``initial`` is an existing result table to
    continue while the store is empty.
    """
    params = params_reader()
    cfg = model_config(params, parity)
    if cfg is None:
        raise ValueError("no model is switched on")
    spark = flows.sparkSession
    # Resolve the asset set once and keep it in the shared checkpoint folder: the
    # stream-static join then neither re-reads membership every micro-batch nor
    # outgrows the broadcast bound checked here, and it survives executor loss.
    scratch_root(spark)
    assets = model_assets(params, members, cfg, parity).distinct().checkpoint()
    bounds = baseline_bounds(flows, assets, interval, cfg.z, parity, zone, max_broadcast_rows)
    store = ResultStore(spark, store_root, key=key_columns(parity))
    started, name = threading.Event(), []

    def query_id() -> str:
        started.wait()  # the first micro-batch may run before start() has returned
        return name[0]

    writer = (bounds.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(make_batch_sink(store, params_reader, versions_reader, parity, zone, jdbc_options,
                                            query_id, cfg.model_id, initial, keep_versions=keep_versions)))
    writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
    with _state_partitions(flows.sparkSession, state_partitions):
        query = writer.start()
    name.append(query.id)  # kept in the checkpoint: a new checkpoint is a new query
    started.set()
    return query


def events_in_files(spark: SparkSession, sf_dir: str, folder: str, as_messages: bool = False) -> None:
    """The test ``events`` as ``STREAM_FILES`` folders by ranges of ``event_id`` (they rise with time).

    A folder has one file per core, which one micro-batch takes together; with
    ``as_messages`` of JSON lines with planted edge cases, else Parquet.

    Every ``LATE_EVERY``-th record of the first range comes with the last one
    instead, long after its window has closed.
    """
    from netbaseline.plans.catalog import LATE_EVERY, STREAM_FILES
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    top = events.agg(F.max("event_id")).first()[0] + 1
    place = F.floor(F.col("event_id") * STREAM_FILES / F.lit(top))
    late = (place == 0) & (F.col("event_id") % LATE_EVERY == 0)
    placed = events.withColumn("__file", F.when(late, F.lit(STREAM_FILES - 1)).otherwise(place))
    for k in range(STREAM_FILES):  # one after the other: a file stream goes by modification time
        part = _dealt(placed.where(F.col("__file") == k).drop("__file"), as_messages)
        part.write.format("text" if as_messages else "parquet").save(f"{folder}/part{k}")


def _dealt(events: DataFrame, as_messages: bool) -> DataFrame:
    """A range of the events over all cores; messages are made after that, as a range lies in few blocks of the table."""
    events = events.repartition(events.sparkSession.sparkContext.defaultParallelism)
    return messages_from_events(events) if as_messages else events


def _file_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    events_in_files(spark, sf_dir, folder)
    schema = spark.read.parquet(f"{folder}/part0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).parquet(f"{folder}/part*")


def stream_bounds_from_files(spark: SparkSession, sf_dir: str, interval: str | None = None,
                             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Run the streaming bounds over the test events in files (``availableNow``) and read what it emitted.

    Windows are emitted once the watermark (latest event time of a modelled
    asset - 5 s) passes their end, so the last, still-open windows are not in
    the output, and neither are the late records.
    """
    from netbaseline.sources.control import TEST_INTERVAL, group_members_from_events, modeling_params_fixture
    from netbaseline.sources.flows import flows_from_events
    from netbaseline.operators.params import active_model, resolve_assets

    out = fresh_folder(spark, "stream-bounds")
    events = _file_stream(spark, sf_dir, f"{out}/in")
    static = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    scratch_root(spark)
    assets = resolve_assets(active_model(modeling_params_fixture(spark)), group_members_from_events(static)).checkpoint()
    bounds = baseline_bounds(flows_from_events(events), assets, interval or TEST_INTERVAL, z=1.96,
                             max_broadcast_rows=max_broadcast_rows)
    with _state_partitions(spark, spark.sparkContext.defaultParallelism):
        q = (bounds.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True)
             .start(f"{out}/data"))
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data")


def stream_results_from_files(spark: SparkSession, sf_dir: str, interval: str | None = None) -> DataFrame:
    """Run the whole streaming job over the test events in files and read the final result table.

    The job resolves its asset set, runs the two window levels as an
    append-mode query and merges each micro-batch of finished windows in
    ``foreachBatch`` (gate, horizon, upsert) into a snapshot store.
    """
    from netbaseline.operators.profile import empty_results
    from netbaseline.sources.control import TEST_INTERVAL, group_members_from_events, modeling_params_fixture
    from netbaseline.sources.flows import flows_from_events

    out = fresh_folder(spark, "stream-results")
    events = _file_stream(spark, sf_dir, f"{out}/in")
    static = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    q = start_stream_baseline(flows_from_events(events), lambda: modeling_params_fixture(spark),
                              group_members_from_events(static), interval or TEST_INTERVAL,
                              f"{out}/results", f"{out}/_checkpoint", trigger={"availableNow": True},
                              state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    latest = ResultStore(spark, f"{out}/results").latest()
    return empty_results(spark) if latest is None else latest

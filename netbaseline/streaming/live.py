"""The live job: every micro-batch reads the control tables afresh and carries its open windows itself.

Messages -> parse -> memberships by event time -> level-1 sums -> open windows
of both levels -> finished windows judged by the parameters in force at their
end -> log of changed rows.  Open windows, result rows, dropped records and
the batch's number are one version of the store, so a batch counts once,
whatever fails.  Nothing is fixed at the start: assets come and go, models are
switched on, off and over, and dimensions change while the query runs.

Windows close as under a watermark: up to the latest event time of a modelled
asset's flow less a delay; sums of windows closed before are late and are kept
as dropped records, as are messages that can not be read.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from netbaseline.functions.time import MODEL_ZONE, local_ntz, window_lengths
from netbaseline.operators.aggregate import MODEL_KEY
from netbaseline.operators.asof import after_clears, asof_slots, version_intervals, within_horizon
from netbaseline.operators.membership import tag_known_assets
from netbaseline.operators.open_windows import OpenWindows, advance, window_stats, window_sums
from netbaseline.operators.params import MODEL_CHILD_TYPE, MODEL_TYPE, resolve_assets
from netbaseline.operators.profile import upsert_results
from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS
from netbaseline.session import written
from netbaseline.sources.flows import BAD_NUMBER, NO_SOURCE, NO_TIME, NOT_JSON, parse_flows
from netbaseline.streaming.baseline import KEEP_VERSIONS, first_writes
from netbaseline.streaming.log_store import Manifest, ResultStore

LATE = "late"
DELAY_SECONDS = 5
REASONS = (NOT_JSON, NO_SOURCE, NO_TIME, BAD_NUMBER)


def dated_assets(versions: DataFrame, members: DataFrame) -> DataFrame:
    """``(model_id, entity_id[, valid_from, valid_to])`` of the newest group list of every model of this kind, on or off.

    ``members(group_id, entity_id)`` may carry ``valid_from`` and ``valid_to``.
    """
    versions = versions.where((F.col("model_type") == MODEL_TYPE) & (F.col("model_child_type") == MODEL_CHILD_TYPE))
    newest = versions.groupBy(F.col("id").alias("n_id")).agg(F.max_by("model_alt_params", "modify_time").alias("model_alt_params"))
    lists = newest.select(F.col("n_id").alias("id"), "model_alt_params")
    if "valid_from" not in members.columns:
        return resolve_assets(lists, members)
    groups = resolve_assets(lists, members.select("group_id", F.col("group_id").alias("entity_id")).distinct())
    return (members.join(groups.select("model_id", F.col("entity_id").alias("g")), F.col("group_id") == F.col("g"))
            .select("model_id", "entity_id", "valid_from", "valid_to"))


@dataclass
class LiveJob:
    """One running job over a store; :meth:`step` takes a batch of flows, :meth:`on_messages` one of messages."""
    store: ResultStore
    versions: Callable[[], DataFrame]      # parameter versions, read anew at every batch
    members: Callable[[], DataFrame]       # group members, read anew at every batch
    interval: str | None
    parity: bool = False
    zone: str = MODEL_ZONE
    delay_seconds: int = DELAY_SECONDS
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    keep_versions: int | None = KEEP_VERSIONS

    def __post_init__(self):
        self.lock = threading.Lock()       # a batch and the idle timer of one driver

    def on_messages(self, messages: DataFrame, query_id: str, batch_id: int) -> Manifest | None:
        """A batch of ``value`` messages; those that can not be read are counted by reason while they are parsed."""
        seen = Observation()

        def rejects(parsed: bool) -> dict:
            if parsed:
                return seen.get
            rows = parse_flows(messages, keep_rejects=True).groupBy("reject_reason").count().collect()
            return {r["reject_reason"]: r["count"] for r in rows}

        return self.step(parse_flows(messages, observation=seen), query_id, batch_id, rejects)

    def step(self, flows: DataFrame, query_id: str, batch_id: int, rejects: Callable[[bool], dict] = lambda parsed: {},
             until: int | None = None) -> Manifest | None:
        """One batch; ``until`` (microseconds) closes windows up to a time whatever the flows say.

        ``rejects(parsed)`` tells the records left out, by reason; ``parsed``: the flows have been read.
        """
        with self.lock:
            done = self.store.find(query_id, batch_id)
            if done is not None:
                return done
            versions = self.versions()
            d1, d2 = window_lengths(self.interval)
            old = self.store.manifest()
            held = self.store.open_windows(old)
            if held is not None and tuple(old.open_windows["lengths"]) != (d1, d2):
                raise ValueError(f"windows of {old.open_windows['lengths']} s are open in {self.store.root}")
            assets = written(dated_assets(versions, self.members()), "live-assets")
            known = tag_known_assets(flows, assets, self.max_broadcast_rows)
            sums = written(window_sums(known, d1, last=True), "live-sums")
            last = sums.agg(F.max("last_us")).first()[0]
            if until is None:
                until = max([x for x in (last and last - self.delay_seconds * 1_000_000, held and held.until) if x is not None],
                            default=None)
            # Without a single asset the flows need not be read, and are not.
            counts = {r: n for r, n in rejects(not assets.isEmpty()).items() if r in REASONS and n}
            if until is None and not counts:
                return old                  # nothing of a modelled asset has ever come
            step = advance(sums.drop("last_us"), held, until if until is not None else 0, d1, d2, self.parity, written, is_kept=True)
            return self._merge(step, old, versions, counts, query_id, batch_id, (d1, d2))

    def _merge(self, step, old: Manifest | None, versions: DataFrame, counts: dict, query_id: str, batch_id: int,
               lengths: tuple[int, int]) -> Manifest:
        spark = self.store.spark
        # The versions that hold by the time reached: later ones have not happened yet.
        reached = local_ntz(F.timestamp_micros(F.lit(step.held.until)), self.zone)
        intervals = written(version_intervals(versions, self.parity).where(F.col("v_from") <= reached), "live-versions")
        slots = asof_slots(window_stats(step.closed, lengths[1]), intervals, self.parity, self.zone)
        slots = written(after_clears(slots, intervals), "live-slots")
        clears = intervals.where("clear_at is not null").groupBy("v_id", "epoch").agg(
            F.date_format(F.max("clear_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).collect()
        newest: dict[str, str] = {}
        for r in clears:
            newest[r["v_id"]] = max(r["t"], newest.get(r["v_id"], ""))
        before = old.clears if old is not None else {}
        held_epoch = {m: int(d.partition("|")[0]) for m, d in (old.dimensions if old is not None else {}).items()}
        gone = [r["v_id"] for r in clears if r["t"] > before.get(r["v_id"], "") and held_epoch.get(r["v_id"]) == r["epoch"]]
        # One commit per epoch of a model that ends in this batch: nearly always one.
        epochs: dict[str, list[tuple[int, str]]] = {}
        for r in sorted(slots.select(MODEL_KEY, "epoch", "dimension").distinct().collect()):
            epochs.setdefault(r[0], []).append((r[1], r[2]))
        rounds = [{m: e[k] for m, e in epochs.items() if k < len(e)} for k in range(max(map(len, epochs.values()), default=1))] or [{}]
        rows = [f"('{r}', {int(n)}L)" for r, n in sorted(counts.items())]
        dropped = step.late.groupBy(F.timestamp_micros("w1").alias("window_start")).agg(F.sum("total_count").cast("long").alias("n")).select(
            F.lit(LATE).alias("reason"), "window_start", "n")
        if rows:
            dropped = dropped.unionByName(spark.sql(f"SELECT c1 AS reason, CAST(NULL AS TIMESTAMP) AS window_start, c2 AS n FROM VALUES {', '.join(rows)} AS t(c1, c2)"))
        left_out = bool(rows) or not step.late.isEmpty()
        m = old
        for k, now in enumerate(rounds):
            is_last = k == len(rounds) - 1
            m = self._round(m, slots, now, gone if k == 0 else [], newest, query_id, batch_id, is_last,
                            step.held if is_last else None, lengths, dropped if is_last and left_out else None)
        if self.keep_versions:
            self.store.expire(self.keep_versions)
        return m

    def _round(self, m, slots, now, gone, clears, query_id, batch_id, is_last, held, lengths, dropped) -> Manifest:
        """Merge one epoch per model: a model whose rows are of another epoch has them closed first."""
        if not now:                         # no window of a model that is on has ended
            return self.store.commit(None, query_id, batch_id, clears, gone, None, held, lengths, dropped=dropped, last=is_last)
        mine = F.lit(False)
        for model, (epoch, _) in now.items():
            mine |= (F.col(MODEL_KEY) == model) & (F.col("epoch") == epoch)
        slots = slots.where(mine)
        known = m.dimensions if m is not None else {}
        close = {model: known[model] for model, (_, dim) in now.items() if known.get(model, dim) != dim and model not in gone}
        fresh = {*gone, *close}
        firsts = first_writes(self.store.spark, m)
        if firsts is not None:
            of = F.lit(None).cast("int")
            for model, (epoch, _) in now.items():
                if model not in fresh:
                    of = F.when(F.col(MODEL_KEY) == model, F.lit(epoch)).otherwise(of)
            firsts = firsts.withColumn("epoch", of).where("epoch is not null")
        slots = within_horizon(slots, firsts).drop("epoch", "dimension", "history_days")
        replaced = self.store.touched(m, slots.select(*self.store.key).distinct()) if m is not None else None
        if replaced is not None:
            replaced = written(replaced.where(~F.col(MODEL_KEY).isin(list(fresh))) if fresh else replaced, "replaced-rows")
        return self.store.commit(upsert_results(replaced, slots, self.parity), query_id, batch_id, clears, gone, replaced, held, lengths,
                                 close, {model: dim for model, (_, dim) in now.items()}, dropped, is_last)

    def close_idle(self, idle_seconds: float = 0.0, now: float | None = None) -> Manifest | None:
        """Close all open windows if no batch has come for ``idle_seconds``; flows of them that come later are late."""
        m = self.store.manifest()
        if m is None or m.open_windows is None or (now or time.time()) - m.at < idle_seconds:
            return None
        d1, d2 = (x * 1_000_000 for x in m.open_windows["lengths"])
        held: OpenWindows = self.store.open_windows(m)
        ends = [held.level2.agg(F.max(F.col("w2") + d2)).first()[0],
                held.level1.agg(F.max(F.col("w1") + d1 - 1 - F.pmod(F.col("w1") + d1 - 1, F.lit(d2)) + d2)).first()[0]]
        ends = [e for e in ends if e is not None]
        if not ends:
            return None
        nothing = held.level1.limit(0).select(*(F.lit(None).cast(t).alias(c) for c, t in FLOW_TYPES))
        return self.step(nothing, "idle", m.number, until=max(ends))


FLOW_TYPES = (("src_id", "string"), ("src_ip", "string"), ("src_port", "int"), ("area_id", "int"), ("protocol", "string"),
              ("in_flow", "bigint"), ("out_flow", "bigint"), ("r_time", "bigint"), ("ts", "timestamp"))


class IdleCloser(StreamingQueryListener):
    """Calls :meth:`LiveJob.close_idle` while a query waits for data: ``spark.streams.addListener(IdleCloser(job, 300))``."""

    def __init__(self, job: LiveJob, idle_seconds: float):
        self.job, self.idle_seconds = job, idle_seconds

    def onQueryIdle(self, event):
        self.job.close_idle(self.idle_seconds)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def start_live(messages: DataFrame, job: LiveJob, checkpoint: str, trigger: dict | None = None, parsed: bool = False):
    """Start the live job over a stream of ``value`` messages (of flow records with ``parsed``); returns the query."""
    started, name = threading.Event(), []

    def sink(batch: DataFrame, batch_id: int) -> None:
        started.wait()   # the first micro-batch may run before start() has returned
        (job.step if parsed else job.on_messages)(batch, name[0], batch_id)

    query = (messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
             .trigger(**(trigger or {"processingTime": "30 seconds"})).start())
    name.append(query.id)
    started.set()
    return query

"""Flow records: read JSON messages, parse them, or map the test ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from netbaseline.functions.text import is_blank, trimmed
from netbaseline.functions.time import instant_from_ntz
from netbaseline.schema import CORRUPT, FLOW_COLUMNS, WIRE_FIELDS, WIRE_TEXT_SCHEMA


def read_flow_messages(spark: SparkSession, fmt: str = "kafka", stream: bool = True,
                       options: dict | None = None, path: str | None = None) -> DataFrame:
    """Flow messages as a DataFrame with one ``value STRING`` column.

    ``fmt="kafka"`` needs the Kafka connector on the class path (options such
    as ``kafka.bootstrap.servers`` and ``subscribe`` are passed through);
    ``fmt="text"`` reads one JSON message per line from files, batch or stream.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


# Reject reasons, in the order in which they are tested.
NOT_JSON, NO_SOURCE, NO_TIME, BAD_NUMBER = "not_json", "no_source_asset", "no_event_time", "bad_number"


def _number(text, kind):
    """``(value, is_bad)`` of a JSON value bound to a whole number.

    Quoted numbers count as numbers and decimals lose their fraction; blank is
    absent; any other text, and what is out of range, is bad.
    """
    value = F.coalesce(text.try_cast(kind), trimmed(text).try_cast("double").try_cast(kind))
    return value, value.isNull() & ~is_blank(text)


def parse_flows(df: DataFrame, value_col: str = "value", keep_rejects: bool = False,
                observation: Observation | str | None = None) -> DataFrame:
    """JSON messages to typed flow records (the message is parsed once).

    Kept: messages with a non-blank ``SrcID`` and an ``rTime`` whose numbers
    can be read.  Byte counts and port default to 0 when absent.  Other rows
    (``not_json``, ``no_source_asset``, ``no_event_time``, ``bad_number``) are
    dropped, or with ``keep_rejects=True`` kept with a ``reject_reason``.  With
    an ``observation`` (batch) or its name (a stream: see the query's progress)
    the rejects of every run are counted on the way.
    """
    # One parse, and one reading of every number: without the generators, of exactly one row each, the
    # optimiser would push the filter on the rejects below them and write them out again at every use.
    message = F.from_json(F.col(value_col), WIRE_TEXT_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = df.select(F.explode(F.array(message)).alias("m"))
    cols, bad = [], F.lit(False)
    for key, kind, name in WIRE_FIELDS:
        c = F.col(f"m.{key}")
        if kind.typeName() != "string":
            c, odd = _number(c, kind.simpleString())
            bad = bad | odd
        if name in ("in_flow", "out_flow", "src_port"):
            c = F.coalesce(c, F.lit(0).cast(kind))
        cols.append(c.alias(name))
    broken = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    flows = parsed.select(F.inline(F.array(F.struct(*cols, broken.alias("__broken"), F.coalesce(bad, F.lit(False)).alias("__bad")))))
    time_is_bad = F.col("r_time").isNull() & F.col("__bad")
    reason = (F.when(F.col("__broken"), F.lit(NOT_JSON))
              .when(is_blank("src_id"), F.lit(NO_SOURCE))
              .when(F.col("r_time").isNull() & ~time_is_bad, F.lit(NO_TIME))
              .when(F.col("__bad"), F.lit(BAD_NUMBER)))
    flows = (flows.withColumn("ts", F.timestamp_millis("r_time")).withColumn("reject_reason", reason)
             .drop("__broken", "__bad"))
    if observation is not None:
        counts = [F.count(F.when(F.col("reject_reason") == r, 1)).alias(r) for r in (NOT_JSON, NO_SOURCE, NO_TIME, BAD_NUMBER)]
        flows = flows.observe(observation, F.count(F.lit(1)).alias("messages"), *counts)
    if keep_rejects:
        return flows
    return flows.where(F.col("reject_reason").isNull()).select(*FLOW_COLUMNS)


# How the driver's ``events`` table stands in for flow records.
#   src_id   = 'ast_' || user_id
#   src_ip   = by user_id % 4: 10.0.0.x, 172.20.0.x, 192.168.1.x, 8.8.4.x with x = user_id % 250
#   src_port = event_id % 65536
#   area_id  = user_id % 7
#   protocol = click, view -> TCP; purchase, signup -> UDP; error -> ICMP
#   in_flow  = round(value * 100) bytes;  out_flow = props.k * 100 bytes
#   r_time   = ts (UTC wall clock) in epoch milliseconds
IP_PREFIXES = ["10.0.0.", "172.20.0.", "192.168.1.", "8.8.4."]
PROTOCOL_OF_EVENT = {"click": "TCP", "view": "TCP", "purchase": "UDP", "signup": "UDP", "error": "ICMP"}


def _event_protocol() -> F.Column:
    expr = None
    for event_type, proto in PROTOCOL_OF_EVENT.items():
        cond = F.col("event_type") == event_type
        expr = F.when(cond, proto) if expr is None else expr.when(cond, proto)
    return expr


def flows_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed flow records from the test ``events`` table (mapping above).

    Columns named in ``keep`` are carried along after the flow columns.
    """
    ip_prefix = F.element_at(F.array(*[F.lit(p) for p in IP_PREFIXES]), (F.col("user_id") % 4 + 1).cast("int"))
    ts = instant_from_ntz("ts", "UTC")
    return events.select(
        F.concat(F.lit("ast_"), F.col("user_id").cast("string")).alias("src_id"),
        F.concat(ip_prefix, (F.col("user_id") % 250).cast("string")).alias("src_ip"),
        (F.col("event_id") % 65536).cast("int").alias("src_port"),
        (F.col("user_id") % 7).cast("int").alias("area_id"),
        _event_protocol().alias("protocol"),
        F.round(F.col("value") * 100).cast("bigint").alias("in_flow"),
        (F.get_json_object("props", "$.k").cast("bigint") * 100).alias("out_flow"),
        F.unix_millis(ts).alias("r_time"),
        # event time is r_time, as for parsed messages (whole milliseconds)
        F.timestamp_millis(F.unix_millis(ts)).alias("ts"),
        *[F.col(c) for c in keep],
    )


# Edge messages planted among those built from ``events``,
# chosen by event_id % 100.
EDGE_NOT_JSON = 13
EDGE_NO_INFLOW = 7
EDGE_NO_RTIME = 29
EDGE_BLANK_SOURCE = {41: None, 42: "", 43: "  ", 44: "null", 45: "\t\n"}
EDGE_QUOTED = 51      # "InFlow":"1950", and likewise rTime and AreaID
EDGE_DECIMAL = 52     # "OutFlow":1350.75
EDGE_BAD_NUMBER = 53  # "InFlow":"12x"


def messages_from_events(events: DataFrame, plant_edges: bool = True) -> DataFrame:
    """Wire-format JSON messages (column ``value``) built from ``events``.

    With ``plant_edges`` some rows become edge cases: not JSON, no ``InFlow``,
    no ``rTime``, a blank ``SrcID``, quoted, decimal and bad numbers; an extra ignored key is always present.
    """
    f = flows_from_events(events.withColumn("_k", F.col("event_id") % 100), keep=("_k",))
    src = F.col("src_id")
    in_flow = F.col("in_flow")
    r_time = F.col("r_time")
    k = F.col("_k")
    if plant_edges:
        for code, blank in EDGE_BLANK_SOURCE.items():
            src = F.when(k == code, F.lit(blank).cast("string")).otherwise(src)
        in_flow = F.when(k == EDGE_NO_INFLOW, F.lit(None).cast("bigint")).otherwise(in_flow)
        r_time = F.when(k == EDGE_NO_RTIME, F.lit(None).cast("bigint")).otherwise(r_time)
    msg = F.to_json(F.struct(
        src.alias("SrcID"), F.col("src_ip").alias("SrcIP"), F.col("src_port").alias("SrcPort"),
        F.col("area_id").alias("AreaID"), F.col("protocol").alias("L4P"), in_flow.alias("InFlow"),
        F.col("out_flow").alias("OutFlow"), r_time.alias("rTime"), F.lit("tls").alias("L7P"),
    ))
    if plant_edges:
        msg = (F.when(k == EDGE_QUOTED, F.regexp_replace(msg, r'"(InFlow|rTime|AreaID)":([0-9]+)', r'"$1":"$2"'))
               .when(k == EDGE_DECIMAL, F.regexp_replace(msg, r'"OutFlow":([0-9]+)', r'"OutFlow":$1.75'))
               .when(k == EDGE_BAD_NUMBER, F.regexp_replace(msg, r'"InFlow":([0-9]+)', r'"InFlow":"$1x"'))
               .otherwise(msg))
        msg = F.when(k == EDGE_NOT_JSON, F.concat(F.lit("not json "), F.col("src_id"))).otherwise(msg)
    return f.select(msg.alias("value"))

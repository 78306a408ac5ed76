"""Control tables: model parameters, group membership, stored results.

Readers take Parquet paths or JDBC options.  For the test data set, the
control tables are derived from ``events`` (group membership, parameter
versions) or are a handful of literal parameter rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from netbaseline.functions.time import instant_from_ntz
from netbaseline.schema import MODELING_PARAMS_SCHEMA, PROFILE_TYPE


def read_control_table(spark: SparkSession, name: str, fmt: str = "parquet", path: str | None = None,
                       options: dict | None = None) -> DataFrame:
    """Read a control table, e.g. ``fmt="jdbc"`` with ``url``/``dbtable``/``user``/``password`` options.

    Read again at every use (each micro-batch) so edits are seen.
    """
    reader = spark.read.format(fmt)
    opts = dict(options or {})
    if fmt == "jdbc":
        opts.setdefault("dbtable", name)
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def decode_profiles(results: DataFrame, col: str = "flow") -> DataFrame:
    """Stored results whose profile is JSON text, with the profile as an array of structs."""
    if dict(results.dtypes)[col] == "string":
        results = results.withColumn(col, F.from_json(F.col(col), PROFILE_TYPE))
    return results


def output_records(bounds: DataFrame) -> DataFrame:
    """``(direction, record)``: the interval of each level-2 result as a JSON record.

    Keys ``srcId``, ``srcIp``, ``areaId``, ``protocol``, ``min``, ``max``
    (bytes); absent values are left out.
    """
    record = F.to_json(F.struct(F.col("src_id").alias("srcId"), F.col("src_ip").alias("srcIp"),
                                F.col("area_id").alias("areaId"), "protocol", F.col("min_flow").alias("min"),
                                F.col("max_flow").alias("max")))
    return bounds.select("direction", record.alias("record"))


def encode_profiles(results: DataFrame, col: str = "flow") -> DataFrame:
    """The profile as JSON text, for stores that keep text (e.g. a JDBC table)."""
    return results.withColumn(col, F.to_json(F.col(col)))


# The test mapping of asset groups, 'grp_' || user_id % 13.
GROUP_COUNT = 13


def group_members_from_events(events: DataFrame) -> DataFrame:
    """``(group_id, entity_id)`` for every user of ``events``."""
    return (events.select(
        F.concat(F.lit("grp_"), (F.col("user_id") % GROUP_COUNT).cast("string")).alias("group_id"),
        F.concat(F.lit("ast_"), F.col("user_id").cast("string")).alias("entity_id"))
        .distinct())


# The dated memberships of the test set: user u of its group from day u % 11 of January 2024
# for 9 days, and again from day 20 on for u % 3 = 0 (UTC).
MEMBER_DAYS, MEMBER_LENGTH, MEMBER_AGAIN = 11, 9, 20


def dated_members_from_events(events: DataFrame) -> DataFrame:
    """``(group_id, entity_id, valid_from, valid_to)``: memberships that begin and end within the test month."""
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    users = events.select("user_id").distinct().withColumn("first", (F.col("user_id") % MEMBER_DAYS).cast("int"))
    spans = F.array(F.struct(F.col("first").alias("a"), (F.col("first") + MEMBER_LENGTH).alias("b")),
                    F.when(F.col("user_id") % 3 == 0, F.struct(F.lit(MEMBER_AGAIN).alias("a"), F.lit(None).cast("int").alias("b"))))
    day = lambda c: instant_from_ntz(F.timestamp_add("DAY", F.col(c), start), "UTC")
    return (users.select("user_id", F.explode(F.filter(spans, lambda s: s.isNotNull())).alias("s")).select("user_id", "s.*")
            .select(F.concat(F.lit("grp_"), (F.col("user_id") % GROUP_COUNT).cast("string")).alias("group_id"),
                    F.concat(F.lit("ast_"), F.col("user_id").cast("string")).alias("entity_id"),
                    day("a").alias("valid_from"), day("b").alias("valid_to")))


# Literal parameter rows of the test set.  One is the model in
# force (msf_base), one an older version also switched on, one switched off,
# one of another model type.  Columns follow MODELING_PARAMS_SCHEMA.
MODELING_PARAMS_ROWS = [
    ("msf_base", 1, 1, "mm", 360, 1, None, 0.95, 7, 1, 1, 1,
     '{"model_entity_group": "grp_0,grp_12, grp_3,grp_5,grp_7,grp_9"}', "running", dt.datetime(2024, 1, 1, 0, 0, 0)),
    ("msf_prev", 1, 1, "hh", 1, 2, None, 0.99, 1, 1, 1, 1,
     '{"model_entity_group": "grp_2,grp_11"}', "stop", dt.datetime(2023, 12, 1, 0, 0, 0)),
    ("msf_off", 1, 1, "mm", 5, 1, None, 0.95, 1, 0, 0, 1,
     '{"model_entity_group": "grp_4"}', "failed", dt.datetime(2024, 1, 2, 0, 0, 0)),
    ("msf_scan", 2, 0, "mm", 5, 1, None, 0.90, 1, 1, 1, 1,
     '{"model_entity_group": "grp_0,grp_1,grp_2,grp_3,grp_4,grp_6"}', "running", dt.datetime(2024, 1, 3, 0, 0, 0)),
]
# The ``interval`` option the test set runs with: 360 minutes, so 6 h and 30 h windows.
TEST_INTERVAL = "360m"


def local_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """Literal rows as a SQL ``VALUES`` relation (evaluated in the JVM, no Python workers)."""
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if isinstance(v, dt.datetime):
            return f"TIMESTAMP_NTZ '{v:%Y-%m-%d %H:%M:%S}'"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"CAST({v!r} AS {t})"
    types = [f.dataType.simpleString() for f in schema.fields]
    values = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    names = [f.name for f in schema.fields]
    cols = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(zip(names, types)))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")


def modeling_params_fixture(spark: SparkSession) -> DataFrame:
    return local_table(spark, MODELING_PARAMS_ROWS, MODELING_PARAMS_SCHEMA)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    return repr(v)


def modeling_params_sql() -> str:
    """The literal parameter rows as a SQL ``VALUES`` relation named ``modeling_params``."""
    cols = ", ".join(f.name for f in MODELING_PARAMS_SCHEMA.fields)
    casts = {"model_type": "INTEGER", "model_child_type": "INTEGER", "model_rate_timeunit_num": "INTEGER",
             "model_result_span": "INTEGER", "model_result_template": "VARCHAR",
             "model_confidence_interval": "DOUBLE", "model_history_data_span": "INTEGER",
             "model_update": "INTEGER", "model_switch": "INTEGER", "model_switch_2": "INTEGER"}
    rows = []
    for r in MODELING_PARAMS_ROWS:
        vals = []
        for f, v in zip(MODELING_PARAMS_SCHEMA.fields, r):
            lit = _sql_literal(v)
            vals.append(f"CAST({lit} AS {casts[f.name]})" if f.name in casts else lit)
        rows.append("(" + ", ".join(vals) + ")")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t({cols}))"


def param_versions_from_events(events: DataFrame) -> DataFrame:
    """A parameter change log derived from ``events``: one version per model and day.

    Model ``msf_base`` takes even users, ``msf_prev`` odd ones; each day's
    parameters are functions of that day's records, so dimensions, update
    mode, history days and switches change now and then, with some NULLs.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    day = F.to_date(F.col("ts"))
    daily = (events
             .select(F.when(F.col("user_id") % 2 == 0, F.lit("msf_base")).otherwise(F.lit("msf_prev")).alias("id"),
                     day.alias("day"), F.col("ts"), k.alias("k"), "event_id")
             .groupBy("id", "day")
             .agg(F.max("ts").alias("modify_time"), F.count(F.lit(1)).alias("n"),
                  F.max("k").alias("k_max"), F.min("k").alias("k_min"), F.sum("k").alias("k_sum")))
    dom = F.dayofmonth("day")
    return daily.select(
        "id",
        F.lit(1).alias("model_type"), F.lit(1).alias("model_child_type"),
        F.when(F.col("k_max") % 3 == 0, F.lit("hh")).otherwise(F.lit("mm")).alias("model_rate_timeunit"),
        (F.lit(1) + (F.col("k_min") + F.floor(dom / 2)) % 2).cast("int").alias("model_rate_timeunit_num"),
        (F.lit(1) + F.col("n") % 2).cast("int").alias("model_result_span"),
        F.lit(None).cast("string").alias("model_result_template"),
        F.lit(0.95).alias("model_confidence_interval"),
        F.when(dom % 7 == 3, F.lit(None)).otherwise(F.lit(1) + F.col("k_sum") % 3).cast("int")
        .alias("model_history_data_span"),
        F.when(dom % 5 == 0, F.lit(None)).otherwise((F.col("k_max") + dom) % 2).cast("int").alias("model_update"),
        F.when(F.col("k_min") % 4 == 0, F.lit(0)).otherwise(F.lit(1)).cast("int").alias("model_switch"),
        F.lit(1).alias("model_switch_2"),
        F.lit(None).cast("string").alias("model_alt_params"),
        F.lit("running").alias("model_task_status"),
        F.col("modify_time"),
    )


def listed_versions_from_events(events: DataFrame) -> DataFrame:
    """:func:`param_versions_from_events` with the group lists of the literal rows."""
    lists = {r[0]: r[12] for r in MODELING_PARAMS_ROWS}
    alt = F.lit(None).cast("string")
    for model, text in lists.items():
        alt = F.when(F.col("id") == model, F.lit(text)).otherwise(alt)
    return param_versions_from_events(events).withColumn("model_alt_params", alt)

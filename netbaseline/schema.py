"""Schemas of the wire format, the flow record and the control / result tables."""

from pyspark.sql import types as T

# JSON keys of a flow message as they appear on the wire (the
# parser is case-sensitive on keys), paired with the engine's column names.
WIRE_FIELDS = [
    ("SrcID", T.StringType(), "src_id"),
    ("SrcIP", T.StringType(), "src_ip"),
    ("SrcPort", T.IntegerType(), "src_port"),
    ("AreaID", T.IntegerType(), "area_id"),
    ("L4P", T.StringType(), "protocol"),
    ("InFlow", T.LongType(), "in_flow"),
    ("OutFlow", T.LongType(), "out_flow"),
    ("rTime", T.LongType(), "r_time"),
]

# Values are read as text first: a sender may quote its numbers or give them decimals.
CORRUPT = "_not_json"
WIRE_TEXT_SCHEMA = T.StructType([T.StructField(k, T.StringType(), True) for k, _, _ in WIRE_FIELDS]
                                + [T.StructField(CORRUPT, T.StringType(), True)])

FLOW_COLUMNS = [name for _, _, name in WIRE_FIELDS] + ["ts"]

# Key of one traffic series: asset, its address and area, and the protocol.
SERIES_KEYS = ["src_id", "src_ip", "area_id", "protocol"]

PROFILE_TYPE = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
]))

MODELING_PARAMS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("model_type", T.IntegerType(), True),
    T.StructField("model_child_type", T.IntegerType(), True),
    T.StructField("model_rate_timeunit", T.StringType(), True),
    T.StructField("model_rate_timeunit_num", T.IntegerType(), True),
    T.StructField("model_result_span", T.IntegerType(), True),
    T.StructField("model_result_template", T.StringType(), True),
    T.StructField("model_confidence_interval", T.DoubleType(), True),
    T.StructField("model_history_data_span", T.IntegerType(), True),
    T.StructField("model_update", T.IntegerType(), True),
    T.StructField("model_switch", T.IntegerType(), True),
    T.StructField("model_switch_2", T.IntegerType(), True),
    T.StructField("model_alt_params", T.StringType(), True),
    T.StructField("model_task_status", T.StringType(), True),
    T.StructField("modify_time", T.TimestampNTZType(), True),
])

GROUP_MEMBERS_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType(), True),
    T.StructField("entity_id", T.StringType(), True),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("modeling_params_id", T.StringType(), False),
    T.StructField("src_id", T.StringType(), False),
    T.StructField("src_ip", T.StringType(), True),
    T.StructField("protocol", T.StringType(), True),
    T.StructField("flow", PROFILE_TYPE, True),
    T.StructField("up_down", T.IntegerType(), True),
    T.StructField("in_out", T.IntegerType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
])

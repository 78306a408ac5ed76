import datetime as dt
import math

from pyspark.sql import functions as F

from netbaseline.functions import (
    blank_aware_equals, blank_aware_equals_ci, internal_flag, interval_text, is_blank, kib_bounds, result_id,
    round2, slot_key, to_boolean, to_int, to_int_or_zero, to_text, window_lengths, z_for_confidence, zone_date,
)


def one(spark, expr, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_is_blank(spark):
    rows = [(None,), ("",), ("   ",), ("null",), ("NULL",), ("x",), (" a ",)]
    got = [r["b"] for r in spark.createDataFrame(rows, "x string").select(is_blank("x").alias("b")).collect()]
    assert got == [True, True, True, True, False, False, False]


def test_blank_aware_equality(spark):
    rows = [(None, ""), ("null", " "), ("a", None), ("a", "a"), ("a", "A"), ("Ab", "aB")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(blank_aware_equals("a", "b").alias("e"), blank_aware_equals_ci("a", "b").alias("ci")).collect()
    assert [r["e"] for r in got] == [True, True, False, True, False, False]
    assert [r["ci"] for r in got] == [True, True, False, True, True, True]


def test_to_text(spark):
    assert one(spark, to_text("x"), None) == ""
    assert one(spark, to_text("x"), "v") == "v"


def test_to_int(spark):
    rows = [(" 12 ",), ("12.7",), ("-3.9",), ("",), ("null",), ("abc",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    got = [r[0] for r in df.select(to_int("x")).collect()]
    assert got == [12, 12, -3, None, None, None, None]
    assert [r[0] for r in df.select(to_int_or_zero("x")).collect()] == [12, 12, -3, 0, 0, 0, 0]


def test_to_boolean(spark):
    rows = [("TRUE",), (" yes ",), ("1",), ("False",), ("no",), ("0",), ("maybe",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    assert [r[0] for r in df.select(to_boolean("x")).collect()] == [True, True, True, False, False, False, False,
                                                                      False]
    assert [r[0] for r in df.select(to_boolean("x", True)).collect()][-2:] == [True, True]


def test_round2_is_arithmetic_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-1.235,), (13818.354,)], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    # Same as Java's Math.round(v * 100) / 100: binary products decide, not the decimal text
    # (1.005 is 1.00499... in binary, so 1.0; F.round would give 1.01).
    assert got == [math.floor(x * 100 + 0.5) / 100 for x in [1.005, 2.675, 0.125, -1.235, 13818.354]]
    assert got[0] == 1.0 and got[-1] == 13818.35


def test_window_lengths_rule():
    assert window_lengths(None) == (300, 600)
    assert window_lengths("") == (300, 600)
    assert window_lengths("1m") == (60, 300)
    assert window_lengths("360m") == (21600, 108000)
    assert window_lengths("6H") == (21600, 43200)
    assert window_lengths("2d") == (172800, 172800)
    # any other suffix: the text without its last character counts days
    assert window_lengths("30") == (3 * 86400, 3 * 86400)


def test_z_for_confidence():
    assert z_for_confidence(0.95) == 1.96
    assert z_for_confidence(0.99) == 2.576
    assert z_for_confidence(None) == 1.96
    assert abs(z_for_confidence(0.80) - 1.2816) < 1e-3


def test_zone_date_and_slots(spark):
    # 2023-12-31 20:30 UTC is 2024-01-01 04:30 at +08:00 (a Monday)
    t = dt.datetime(2023, 12, 31, 20, 30)
    df = spark.createDataFrame([(t,)], "t timestamp")
    r = df.select(zone_date("t").alias("d"), zone_date("t", "yyyy-MM-dd HH:mm").alias("dt"),
                  zone_date("t", "yyyy-MM-dd", "UTC").alias("u"),
                  slot_key("t", 1).alias("h"), slot_key("t", 2).alias("wd"), slot_key("t", 3).alias("m"),
                  slot_key("t", 4).alias("m4")).first()
    assert (r["d"], r["dt"], r["u"]) == ("2024-01-01", "2024-01-01 04:30", "2023-12-31")
    assert (r["h"], r["wd"], r["m"], r["m4"]) == ("4", "1", "1", "1")


def test_zone_functions_ignore_session_zone(spark):
    t = dt.datetime(2024, 1, 7, 23, 0)  # a Sunday 23:00 UTC, Monday 07:00 at +08:00
    df = spark.createDataFrame([(t,)], "t timestamp")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = df.select(zone_date("t", "yyyy-MM-dd HH:mm").alias("d"), slot_key("t", 2).alias("wd")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r["d"], r["wd"]) == ("2024-01-08 07:00", "1")


def test_slot_key_rejects_unknown_span(spark):
    import pytest
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp")
    with pytest.raises(Exception, match="unsupported model_result_span"):
        df.select(slot_key("t", 9)).collect()


def test_internal_flag_and_parity(spark):
    ips = ["10.1.2.3", "172.16.0.1", "172.31.255.255", "172.32.0.1", "172.168.1.1", "192.168.9.9",
           "192.169.0.1", "198.51.100.7", "256.1.1.1", "1.2.3", "abc", None]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    got = df.select(internal_flag("ip").alias("f"), internal_flag("ip", parity=True).alias("p")).collect()
    assert [r["f"] for r in got] == [0, 0, 0, 1, 1, 0, 1, 1, None, None, None, None]
    # Q7: with parity, 172.168.x.x counts as internal
    assert [r["p"] for r in got] == [0, 0, 0, 1, 0, 0, 1, 1, None, None, None, None]


def test_kib_bounds_and_text_golden(spark):
    df = spark.createDataFrame([(-5.0, 14149990.0), (1023.994, 2048.0), (0.0, 0.0)], "lo double, hi double")
    lo, hi = kib_bounds(F.col("lo"), F.col("hi"))
    got = df.select(lo.alias("lo"), hi.alias("hi"), interval_text(lo, hi).alias("t")).collect()
    assert [(r["lo"], r["hi"]) for r in got] == [(0.0, 13818.35), (1.0, 2.0), (0.0, 0.0)]
    # golden text of a stored profile value
    assert got[0]["t"] == "0.0-13818.35"
    assert got[2]["t"] == "0.0-0.0"


def test_result_id_is_stable(spark):
    df = spark.createDataFrame([("m", "ast_1", "TCP", 0), ("m", "ast_1", "TCP", 0), ("m", "ast_1", "UDP", 0)],
                               "m string, s string, p string, d int")
    ids = [r[0] for r in df.select(result_id("m", "s", "p", "d")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert ids[0].startswith("msf_") and len(ids[0]) == 26


def test_result_id_keeps_parts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ('a","b', "c")], "x string, y string")
    assert len({r[0] for r in df.select(result_id("x", "y")).collect()}) == 3


def test_blanks_are_all_white_space(spark):
    from netbaseline.functions.convert import to_boolean, to_int
    from netbaseline.functions.text import blank_to_empty, is_blank
    df = spark.createDataFrame([(x,) for x in (None, "", " ", "\t", "\n ", "null", "x\t")], "a string")
    assert [r[0] for r in df.select(is_blank("a")).collect()] == [True] * 6 + [False]
    assert [r[0] for r in df.select(blank_to_empty("a")).collect()] == [""] * 6 + ["x\t"]
    df = spark.createDataFrame([("\tyes", "\n12 ")], "b string, i string")
    assert tuple(df.select(to_boolean("b"), to_int("i")).first()) == (True, 12)


def test_confidence_and_interval_are_checked():
    import numpy as np
    import pytest
    from netbaseline.functions.time import window_lengths, z_for_confidence
    assert z_for_confidence(float(np.float32(0.95))) == 1.96 and z_for_confidence(None) == 1.96
    for level in (95.0, 0.0, 1.0):
        with pytest.raises(ValueError):
            z_for_confidence(level)
    for text in ("0m", "1.5m", "m", "-1h"):
        with pytest.raises(ValueError):
            window_lengths(text)
    assert window_lengths("3h") == (10800, 21600) and window_lengths(None) == (300, 600)

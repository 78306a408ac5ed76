from pyspark.sql import functions as F

from netbaseline.sources import parse_flows

# An invented message: the eight bound keys and some others, which are ignored.
SAMPLE = ('{"SrcID":"ast_printer_12","SrcIP":"10.20.30.40","SrcPort":50123,"AreaID":77,"L4P":"UDP","L7P":"dns",'
          '"InFlow":640,"OutFlow":88,"rTime":1700000000123,"DstIP":"10.20.0.53","DstPort":53,"Note":""}')


def msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_golden_sample(spark):
    r = parse_flows(msgs(spark, [SAMPLE])).first()
    assert (r["src_id"], r["src_ip"], r["src_port"], r["area_id"], r["protocol"]) == (
        "ast_printer_12", "10.20.30.40", 50123, 77, "UDP")
    assert (r["in_flow"], r["out_flow"], r["r_time"]) == (640, 88, 1700000000123)
    assert str(r["ts"]) == "2023-11-14 22:13:20.123000"


def test_numbers_are_bound_leniently(spark):
    base = '"SrcID":"a","SrcIP":"10.0.0.1","L4P":"UDP"'
    values = {
        "quoted": "{" + base + ',"InFlow":"1950","OutFlow":" 7 ","AreaID":"5","SrcPort":"80","rTime":"1700000000123"}',
        "decimal": "{" + base + ',"InFlow":1950.9,"OutFlow":"7.5","AreaID":5.0,"SrcPort":80,"rTime":1700000000123}',
        "absent": "{" + base + ',"rTime":1700000000123,"InFlow":null,"OutFlow":""}',
        "bad": "{" + base + ',"InFlow":"12x","rTime":1700000000123}',
        "bad time": "{" + base + ',"rTime":"yesterday"}',
        "too large": "{" + base + ',"AreaID":99999999999,"rTime":1700000000123}',
        "broken": "{" + base + ',"rTime":',
    }
    rows = [parse_flows(msgs(spark, [v]), keep_rejects=True).first() for v in values.values()]
    got = {k: (r["in_flow"], r["out_flow"], r["area_id"], r["src_port"], r["reject_reason"]) for k, r in zip(values, rows)}
    assert got["quoted"] == (1950, 7, 5, 80, None) and got["decimal"] == (1950, 7, 5, 80, None)
    assert got["absent"] == (0, 0, None, 0, None)
    assert [got[k][4] for k in ("bad", "bad time", "too large", "broken")] == ["bad_number"] * 3 + ["not_json"]


def test_rejects_are_counted_on_the_way(spark):
    from pyspark.sql import Observation
    seen = Observation("rejects")
    values = [SAMPLE, "no json", '{"SrcID":"\\t","rTime":1}', '{"SrcID":"a"}', '{"SrcID":"a","rTime":"x"}']
    assert parse_flows(msgs(spark, values), observation=seen).count() == 1
    assert seen.get == {"messages": 5, "not_json": 1, "no_source_asset": 1, "no_event_time": 1, "bad_number": 1}


def test_control_tables_from_parquet(spark, scratch):
    from netbaseline.sources.control import decode_profiles, encode_profiles, modeling_params_fixture, read_control_table
    params = modeling_params_fixture(spark)
    params.write.parquet(f"{scratch}/params")
    got = read_control_table(spark, "modeling_params", path=f"{scratch}/params")
    assert got.exceptAll(params).count() == 0 and got.count() == params.count()
    results = spark.sql("SELECT 'i' AS id, array(named_struct('name', '7', 'value', '0.0-1.5')) AS flow")
    text = encode_profiles(results)
    assert text.first()["flow"] == '[{"name":"7","value":"0.0-1.5"}]'
    assert decode_profiles(text).collect() == results.collect()


def test_parse_edge_rows(spark):
    base = '"SrcIP":"10.0.0.1","L4P":"UDP","InFlow":5,"OutFlow":7,"rTime":1000'
    values = [
        "{" + base + "}",                                   # no SrcID
        '{"SrcID":"",' + base + "}",
        '{"SrcID":"  ",' + base + "}",
        '{"SrcID":"null",' + base + "}",
        '{"SrcID":"a","SrcIP":"10.0.0.1","L4P":"UDP","OutFlow":7,"rTime":2000}',   # no InFlow -> 0
        '{"SrcID":"b","SrcIP":"10.0.0.1","L4P":"UDP","InFlow":5,"OutFlow":7}',     # no rTime -> dropped
        '{"SrcID":"c","AreaID":null,' + base + "}",                               # null AreaID kept
        "this is not json",
        '{"srcid":"d",' + base + "}",                                             # wrong key case
    ]
    kept = parse_flows(msgs(spark, values)).orderBy("src_id").collect()
    assert [r["src_id"] for r in kept] == ["a", "c"]
    assert kept[0]["in_flow"] == 0 and kept[0]["src_port"] == 0
    assert kept[1]["area_id"] is None
    reasons = (parse_flows(msgs(spark, values), keep_rejects=True)
               .groupBy("reject_reason").count().collect())
    counts = {r["reject_reason"]: r["count"] for r in reasons}
    assert counts == {None: 2, "no_source_asset": 5, "no_event_time": 1, "not_json": 1}


def test_flows_from_events_mapping(spark):
    from netbaseline.sources import flows_from_events
    import datetime as dt
    ev = spark.createDataFrame(
        [(7, dt.datetime(2024, 1, 1, 0, 0, 1, 500000), 6, "purchase", 12.34, '{"k": 5}')],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    r = flows_from_events(ev).first()
    assert (r["src_id"], r["src_ip"], r["src_port"], r["area_id"], r["protocol"]) == (
        "ast_6", "192.168.1.6", 7, 6, "UDP")
    assert (r["in_flow"], r["out_flow"], r["r_time"]) == (1234, 500, 1704067201500)


def test_messages_round_trip(spark):
    from netbaseline.sources import flows_from_events, messages_from_events
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    parsed = parse_flows(messages_from_events(ev, plant_edges=False))
    direct = flows_from_events(ev)
    assert parsed.exceptAll(direct).count() == 0 and direct.exceptAll(parsed).count() == 0
    assert F is not None

"""The keyed merge against a row-at-a-time model of the reference's sink."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from netbaseline.operators import upsert_results

T0 = dt.datetime(2024, 1, 1)
SLOT_SCHEMA = ("modeling_params_id string, src_id string, src_ip string, area_id int, protocol string, "
               "up_down int, window_end timestamp, name string, lo double, hi double, value string, in_out int, "
               "time timestamp_ntz")

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b"]),            # asset
              st.integers(min_value=0, max_value=40),   # window index (hours)
              st.sampled_from(["0", "6", "12", "18"]),  # slot
              st.integers(min_value=0, max_value=500)),  # value
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]))


def model(rows):
    """Apply rows one at a time in window order: replace the slot in place or append it."""
    out = {}
    for asset, w, name, v in sorted(rows, key=lambda r: r[1]):
        prof = out.setdefault(asset, {"first": w, "flow": []})
        text = f"{float(v)}-{float(v + 1)}"
        for s in prof["flow"]:
            if s[0] == name:
                s[1] = text
                break
        else:
            prof["flow"].append([name, text])
    return {a: ([tuple(s) for s in p["flow"]], T0 + dt.timedelta(hours=p["first"] + 8)) for a, p in out.items()}


def as_slots(spark, rows):
    data = []
    for asset, w, name, v in rows:
        t = T0 + dt.timedelta(hours=w)
        data.append(("m", asset, "10.0.0.1", 1, "TCP", 0, t, name, float(v), float(v + 1),
                     f"{float(v)}-{float(v + 1)}", 0, t + dt.timedelta(hours=8)))
    return spark.createDataFrame(data, SLOT_SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, cut=st.integers(min_value=0, max_value=41))
def test_merge_matches_row_at_a_time_model(spark, rows, cut):
    first = [r for r in rows if r[1] < cut]
    second = [r for r in rows if r[1] >= cut]
    stored = upsert_results(None, as_slots(spark, first)) if first else None
    result = upsert_results(stored, as_slots(spark, second)) if second else stored
    got = {r["src_id"]: ([(s["name"], s["value"]) for s in r["flow"]], r["time"]) for r in result.collect()}
    assert got == model(rows)

"""The SQL entry: the same two-level statistics as SQL text over temporary views.

Flows are registered as a view; level 1, the direction split, level 2 and
the bounds are SQL statements whose window lengths come from the
``interval`` option, as when the job is written as SQL.  The DataFrame and
the SQL entry give the same logical plan, so Catalyst treats them alike;
this works on batch and streaming views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from netbaseline.functions.time import WATERMARK_DELAY, duration, window_lengths


def sql_bounds(flows: DataFrame, interval: str | None, z: float = 1.96, prefix: str = "nb") -> DataFrame:
    """Level-2 bounds per series, direction and window, via ``spark.sql`` over views."""
    spark = flows.sparkSession
    d1, d2 = window_lengths(interval)
    if flows.isStreaming:
        flows = flows.withWatermark("ts", WATERMARK_DELAY)
    flows.createOrReplaceTempView(f"{prefix}_flows")
    spark.sql(f"""
        SELECT src_id, src_ip, area_id, protocol, window(ts, '{duration(d1)}') AS w1,
               sum(in_flow) AS in_sum, sum(out_flow) AS out_sum, count(1) AS total_count
        FROM {prefix}_flows
        GROUP BY src_id, src_ip, area_id, protocol, window(ts, '{duration(d1)}')
    """).createOrReplaceTempView(f"{prefix}_level1")
    spark.sql(f"""
        SELECT src_id, src_ip, area_id, protocol, w1,
               stack(2, 0, in_sum, total_count, 1, out_sum, total_count) AS (direction, flow_size, total_count)
        FROM {prefix}_level1
    """).createOrReplaceTempView(f"{prefix}_directions")
    return spark.sql(f"""
        SELECT src_id, src_ip, area_id, protocol, direction, w2, sum_flow, sum_count, sd_flow, n_windows,
               sum_flow / sum_count AS mean_flow,
               sum_flow / sum_count + {float(z)} * sd_flow / sqrt(sum_count) AS max_flow,
               sum_flow / sum_count - {float(z)} * sd_flow / sqrt(sum_count) AS min_flow
        FROM (
          SELECT src_id, src_ip, area_id, protocol, direction,
                 window(window_time(w1), '{duration(d2)}') AS w2,
                 sum(flow_size) AS sum_flow, sum(total_count) AS sum_count,
                 stddev_pop(flow_size) AS sd_flow, count(1) AS n_windows
          FROM {prefix}_directions
          GROUP BY src_id, src_ip, area_id, protocol, direction, window(window_time(w1), '{duration(d2)}')
        )
    """)

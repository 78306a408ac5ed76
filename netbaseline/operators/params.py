"""Control tables: the active model, its assets, parameter changes, history clears."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netbaseline.functions.convert import to_boolean, to_int
from netbaseline.functions.text import blank_aware_equals
from netbaseline.operators.sizing import broadcast_if, is_small

# The model this job computes is type 1, child type 1, and it
# runs only while both switches are 1.
MODEL_TYPE = 1
MODEL_CHILD_TYPE = 1
GROUP_LIST_PATH = "$.model_entity_group"


def ACTIVE_PREDICATE() -> Column:  # noqa: N802  (reads like the constant it stands for)
    return ((F.col("model_type") == MODEL_TYPE) & (F.col("model_child_type") == MODEL_CHILD_TYPE)
            & (F.col("model_switch") == 1) & (F.col("model_switch_2") == 1))


def active_models(params: DataFrame) -> DataFrame:
    """All parameter rows of this model that are switched on."""
    return params.where(ACTIVE_PREDICATE())


def active_model(params: DataFrame) -> DataFrame:
    """The one parameter row in force: switched on, newest ``modify_time`` (then id)."""
    row = F.struct(*[F.col(c) for c in params.columns])
    return (active_models(params)
            .agg(F.max_by(row, F.struct(F.col("modify_time"), F.col("id"))).alias("p"))
            .where(F.col("p").isNotNull())
            .select("p.*"))


def resolve_assets(params: DataFrame, members: DataFrame, parity: bool = False,
                   model_ids: list[str] | None = None, distinct: bool = True) -> DataFrame:
    """``(model_id, entity_id)`` for the asset groups listed in each model's parameters.

    The group list is the comma-separated text at ``$.model_entity_group`` of
    ``model_alt_params``; groups match exactly.  ``parity=True`` matches a
    group when its id is a substring of the list (so ``grp_1`` matches
    ``grp_12``): every list is cut into its substrings of the lengths that
    group ids have, so that this too is an equi-join.  ``model_ids`` restricts the models resolved.  With
    ``distinct=False`` a pair may repeat (an asset in two listed groups),
    which a semi join ignores; this saves a shuffle.
    """
    groups = F.get_json_object(F.col("model_alt_params"), GROUP_LIST_PATH)
    small = is_small(params)
    if model_ids is not None:
        params = params.where(F.col("id").isin(list(model_ids)))
    if not parity:
        wanted = (params.select(F.col("id").alias("model_id"),
                                F.explode(F.split(groups, ",")).alias("group_id"))
                  .select("model_id", F.trim("group_id").alias("group_id"))
                  .where(F.col("group_id") != ""))
        # one row per (model, listed group): bounded by the checked parameter table
        pairs = members.join(broadcast_if(wanted, small), "group_id")
    else:
        # As many numbers as group ids have different lengths.
        lengths = [r[0] for r in members.select(F.length("group_id")).distinct().collect() if r[0]]
        lists = params.select(F.col("id").alias("model_id"), groups.alias("group_list")).where("group_list is not null")
        cuts = lists.select("model_id", "group_list", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("k"))
        cuts = cuts.where(F.length("group_list") >= F.col("k")).select(
            "model_id", F.explode(F.expr("transform(sequence(1, length(group_list) - k + 1), p -> substring(group_list, p, k))"))
            .alias("group_id")).distinct()
        pairs = members.join(cuts, "group_id")
    pairs = pairs.select("model_id", "entity_id").where(F.col("entity_id").isNotNull())
    return pairs.distinct() if distinct else pairs


def _changed(new: Column, old: Column) -> Column:
    """A value changed: the new one is present and differs (NULL-safe) from the old."""
    return new.isNotNull() & ~new.eqNullSafe(old)


def diff_params(versions: DataFrame, parity: bool = False) -> DataFrame:
    """Classify each parameter version against the one before it (same ``id``).

    Output per version: ``dimension_changed`` (result span, rate unit or rate
    number changed), ``update_changed`` (update mode changed), ``clear_history``
    (update mode changed to a false value: history is dropped),
    ``history_changed`` and the ``history_days`` in force.  The first version
    of a model is the baseline and changes nothing.  ``parity=True`` uses the
    reference's dimension test: span changed AND unit unchanged AND number changed.
    """
    w = Window.partitionBy("id").orderBy("modify_time")
    span, unit, num = to_int("model_result_span"), F.col("model_rate_timeunit"), to_int("model_rate_timeunit_num")
    upd, hist = to_int("model_update"), to_int("model_history_data_span")
    v = versions.select(
        "id", "modify_time",
        span.alias("span"), unit.cast("string").alias("unit"), num.alias("num"),
        upd.alias("upd"), hist.alias("hist"), F.col("model_update").alias("upd_raw"),
    )
    prev = {c: F.lag(c).over(w) for c in ("span", "unit", "num", "upd", "hist")}
    is_first = F.row_number().over(w) == 1
    span_ch = _changed(F.col("span"), prev["span"])
    num_ch = _changed(F.col("num"), prev["num"])
    if parity:
        dim = span_ch & blank_aware_equals(F.col("unit"), prev["unit"]) & num_ch
    else:
        unit_ch = F.col("unit").isNotNull() & ~blank_aware_equals(F.col("unit"), prev["unit"])
        dim = span_ch | unit_ch | num_ch
    upd_ch = _changed(F.col("upd"), prev["upd"])
    hist_ch = _changed(F.col("hist"), prev["hist"])
    out = v.select(
        "id", "modify_time",
        F.when(is_first, False).otherwise(dim).alias("dimension_changed"),
        F.when(is_first, False).otherwise(upd_ch).alias("update_changed"),
        F.when(is_first, False).otherwise(upd_ch & ~to_boolean(F.col("upd_raw"))).alias("clear_history"),
        F.when(is_first, False).otherwise(hist_ch).alias("history_changed"),
        F.col("hist").alias("hist"),
    )
    # Days of history in force: the last non-null value so far, 1 before any.
    wc = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("history_days", F.coalesce(F.last("hist", ignorenulls=True).over(wc), F.lit(1))).drop("hist")


def clear_history(results: DataFrame, changes: DataFrame, time_col: str = "time") -> DataFrame:
    """Result rows that survive the history clears: none written before a clear of their model."""
    clears = (changes.where("clear_history").groupBy(F.col("id").alias("__mid"))
              .agg(F.max("modify_time").alias("__cleared_at")))
    # one row per model id of the (checked) versions table
    side = broadcast_if(clears, is_small(changes))
    cond = (F.col("modeling_params_id") == F.col("__mid")) & (F.col("__cleared_at") > F.col(time_col))
    return results.join(side, cond, "left_anti")

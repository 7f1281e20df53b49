"""Log-mean target encodings at several key levels (global, client, ...).

Each statistic is one ``groupBy`` with a decomposable aggregate
(sum and count of log1p(y)), so Spark combines map-side before the shuffle
and a hot key costs one row per map task. Previous-period statistics shift the
period key by +1 and are joined on equality: a missing previous period gives
NULL (not the last earlier period).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.expressions import log_mean

# Statistic name -> key columns, for the levels the feature job joins.
LEVELS = {
    "lm_client": ["client_id"],
    "lm_client_product": ["client_id", "product_id"],
    "lm_depot_product": ["depot_id", "product_id"],
    "lm_client_product_depot": ["client_id", "product_id", "depot_id"],
    "lm_depot": ["depot_id"],
}
PREV_LEVELS = {
    "lm_prev_depot": ["period", "depot_id"],
    "lm_prev_depot_product": ["period", "depot_id", "product_id"],
    "lm_prev_client_depot_product": ["period", "client_id", "depot_id", "product_id"],
}


def global_log_mean(rows: DataFrame, value: str = "demand", name: str = "lm_global") -> DataFrame:
    """One row: the log-mean of the whole column."""
    return rows.agg(log_mean(value).alias(name))


def target_mean(rows: DataFrame, keys: Sequence[str], name: str, value: str = "demand",
                shift: int = 0, period_col: str = "period") -> DataFrame:
    """Log-mean of ``value`` per key; NULL keys dropped. ``shift`` adds to the period key."""
    keys = list(keys)
    base = rows.select(*keys, value)
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    out = base.groupBy(*keys).agg(log_mean(value).alias(name))
    if shift:
        out = out.withColumn(period_col, (F.col(period_col) + F.lit(shift)).cast("int"))
    return out


def level_mean(rows: DataFrame, name: str, value: str = "demand") -> DataFrame:
    if name in LEVELS:
        return target_mean(rows, LEVELS[name], name, value)
    return target_mean(rows, PREV_LEVELS[name], name, value, shift=1)


def prev_period_window_mean(rows: DataFrame, keys: Sequence[str], name: str,
                            value: str = "demand", period_col: str = "period") -> DataFrame:
    """Train-side equivalent of the shifted join, as a range window.

    Rows are first reduced to (key, period) sums and counts of log1p(value)
    (map-side partial aggregation), so the window partition of a key holds at
    most one row per period however hot the key is. The window takes exactly
    the previous period (range 1 preceding .. 1 preceding); the result is
    joined back to the rows on (key, period).
    """
    keys = list(keys)
    lv = F.log1p(F.col(value).cast("double"))
    per = rows.groupBy(*keys, period_col).agg(F.sum(lv).alias("_s"), F.count(lv).alias("_c"))
    w = (Window.partitionBy(*keys).orderBy(F.col(period_col).cast("long"))
         .rangeBetween(-1, -1))
    per = per.select(*keys, period_col,
                     F.expm1(F.sum("_s").over(w) / F.sum("_c").over(w)).alias(name))
    return rows.join(per, keys + [period_col], "left")


@dataclass
class MeanStats:
    """Statistics computed on training rows only, joined to train and test rows."""
    global_mean: DataFrame
    client: DataFrame
    client_product: DataFrame
    depot_product: DataFrame
    client_product_depot: DataFrame
    prev_depot_product: DataFrame
    prev_client_depot_product: DataFrame


def mean_stats(train: DataFrame, value: str = "demand") -> MeanStats:
    return MeanStats(
        global_mean=global_log_mean(train, value),
        client=level_mean(train, "lm_client", value),
        client_product=level_mean(train, "lm_client_product", value),
        depot_product=level_mean(train, "lm_depot_product", value),
        client_product_depot=level_mean(train, "lm_client_product_depot", value),
        prev_depot_product=level_mean(train, "lm_prev_depot_product", value),
        prev_client_depot_product=level_mean(train, "lm_prev_client_depot_product", value),
    )


# Keys of the finest aggregation state: every statistic of the feature job groups by some of them.
STATE_KEYS = ["period", "channel_id", "client_id", "depot_id", "product_id"]


def mean_state(rows: DataFrame, value: str = "demand") -> DataFrame:
    """The finest aggregation state: per key of STATE_KEYS (NULL is a key here) the
    sum and the count of log1p(value). Distinct counts need only its keys."""
    lv = F.log1p(F.col(value).cast("double"))
    return rows.groupBy(*STATE_KEYS).agg(F.sum(lv).alias("log_sum"), F.count(lv).alias("log_n"))


def merge_state(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of coarser keys: sums of sums and of counts."""
    return state.groupBy(*keys).agg(F.sum("log_sum").alias("log_sum"), F.sum("log_n").alias("log_n"))


def state_mean(state: DataFrame, keys: Sequence[str], name: str, shift: int = 0,
               period_col: str = "period") -> DataFrame:
    """Log-mean per key from a state of these keys; NULL keys dropped, NULL where no value counted."""
    out = state
    for k in keys:
        out = out.where(F.col(k).isNotNull())
    out = out.select(*keys, F.expm1(F.when(F.col("log_n") > 0, F.col("log_sum") / F.col("log_n"))).alias(name))
    if shift:
        out = out.withColumn(period_col, (F.col(period_col) + F.lit(shift)).cast("int"))
    return out


def mean_stats_from_state(state: DataFrame, written=lambda df, name: df) -> MeanStats:
    """The statistics of ``mean_stats``, each merged from the next finer state
    instead of from the rows. ``written(df, name)`` may cut the lineage between
    the steps, so that no state is merged twice."""
    def step(finer: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        return written(merge_state(finer, keys), f"state-{name}")

    prev_cdp = step(state, "prev_client_depot_product", PREV_LEVELS["lm_prev_client_depot_product"])
    prev_dp = step(prev_cdp, "prev_depot_product", PREV_LEVELS["lm_prev_depot_product"])
    cpd = step(prev_cdp, "client_product_depot", LEVELS["lm_client_product_depot"])
    dp = step(prev_dp, "depot_product", LEVELS["lm_depot_product"])
    cp = step(cpd, "client_product", LEVELS["lm_client_product"])
    c = step(cp, "client", LEVELS["lm_client"])
    return MeanStats(
        global_mean=state_mean(step(c, "global", []), [], "lm_global"),
        client=state_mean(c, LEVELS["lm_client"], "lm_client"),
        client_product=state_mean(cp, LEVELS["lm_client_product"], "lm_client_product"),
        depot_product=state_mean(dp, LEVELS["lm_depot_product"], "lm_depot_product"),
        client_product_depot=state_mean(cpd, LEVELS["lm_client_product_depot"], "lm_client_product_depot"),
        prev_depot_product=state_mean(prev_dp, PREV_LEVELS["lm_prev_depot_product"],
                                      "lm_prev_depot_product", shift=1),
        prev_client_depot_product=state_mean(prev_cdp, PREV_LEVELS["lm_prev_client_depot_product"],
                                             "lm_prev_client_depot_product", shift=1),
    )

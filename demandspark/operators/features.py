"""Feature assembly: dimension joins, log-mean joins and the fallback chain.

Fallback chain (each value is the log-mean at that key, in this order)::

    g    = global
    c    = coalesce(client,                         g)
    cp   = coalesce(client_product,                 c)
    ap   = coalesce(depot_product,                  g)
    cpa  = coalesce(client_product_depot,           cp)
    wap  = coalesce(prev-period depot_product,      ap)
    wcap = coalesce(prev-period client_depot_product, wap)

Plan shape: the global mean is a scalar subquery; product and location sides
are inner and the six statistic tables left equi-joins on non-null id keys. No
side is hinted: the planner broadcasts one when its bytes are few, and AQE
splits skewed partitions of the row side when one key is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from demandspark.operators.joins import left_attach, with_constants, written_dimension
from demandspark.session import materialize
from demandspark.operators.target_means import MeanStats, global_log_mean, level_mean, mean_stats
from demandspark.operators.unique_counts import UNIQUE_SPECS, count_medians, unique_counts
from demandspark.sources.schemas import (EXTRA_MEAN_FEATURES, KEY_COLUMNS, LOCATION_FEATURES,
                                         MEAN_FEATURES, PRODUCT_FEATURES)

CHAIN = ["lm_global", "lm_client", "lm_client_product", "lm_depot_product",
         "lm_client_product_depot", "lm_prev_depot_product", "lm_prev_client_depot_product"]


def attach_means(rows: DataFrame, stats: MeanStats) -> DataFrame:
    """Left-join every statistic and resolve the fallback chain (no NULL left)."""
    df = with_constants(rows, stats.global_mean)
    df = left_attach(df, stats.client, ["client_id"])
    df = left_attach(df, stats.client_product, ["client_id", "product_id"])
    df = left_attach(df, stats.depot_product, ["depot_id", "product_id"])
    df = left_attach(df, stats.client_product_depot, ["client_id", "product_id", "depot_id"])
    df = left_attach(df, stats.prev_depot_product, ["period", "depot_id", "product_id"])
    df = left_attach(df, stats.prev_client_depot_product,
                     ["period", "client_id", "depot_id", "product_id"])
    return resolve_chain(df)


def resolve_chain(df: DataFrame) -> DataFrame:
    """Replace each statistic by its fallback-chain value."""
    g = F.col("lm_global")
    c = F.coalesce(F.col("lm_client"), g)
    cp = F.coalesce(F.col("lm_client_product"), c)
    ap = F.coalesce(F.col("lm_depot_product"), g)
    cpa = F.coalesce(F.col("lm_client_product_depot"), cp)
    wap = F.coalesce(F.col("lm_prev_depot_product"), ap)
    wcap = F.coalesce(F.col("lm_prev_client_depot_product"), wap)
    resolved = {"lm_client": c, "lm_client_product": cp, "lm_depot_product": ap,
                "lm_client_product_depot": cpa, "lm_prev_depot_product": wap,
                "lm_prev_client_depot_product": wcap}
    return df.withColumns(resolved)


def attach_dimensions(rows: DataFrame, product_feats: DataFrame | None,
                      location_feats: DataFrame | None, keep_unmatched: bool = False) -> DataFrame:
    """Inner joins by default: rows with an unknown product or depot are dropped
    (test rows included); ``keep_unmatched`` keeps them with NULL attributes."""
    how = "left" if keep_unmatched else "inner"
    df = rows
    if product_feats is not None:
        df = df.join(product_feats, "product_id", how)
    if location_feats is not None:
        df = df.join(location_feats, "depot_id", how)
    return df


def combine(rows: DataFrame, product_feats: DataFrame | None, location_feats: DataFrame | None,
            stats: MeanStats, keep_unmatched: bool = False) -> DataFrame:
    return attach_means(attach_dimensions(rows, product_feats, location_feats, keep_unmatched), stats)


def fallback_chain(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Minimal slice: the chain g -> c -> cp on ``rows`` from ``train`` statistics."""
    stats = mean_stats(train)
    df = with_constants(rows, stats.global_mean)
    df = left_attach(df, stats.client, ["client_id"])
    df = left_attach(df, stats.client_product, ["client_id", "product_id"])
    c = F.coalesce(F.col("lm_client"), F.col("lm_global"))
    return df.withColumns({"lm_client": c,
                           "lm_client_product": F.coalesce(F.col("lm_client_product"), c)})


def feature_columns(product_feats: DataFrame | None, location_feats: DataFrame | None) -> list[str]:
    cols = list(KEY_COLUMNS) + MEAN_FEATURES + EXTRA_MEAN_FEATURES + \
        [n for spec in UNIQUE_SPECS.values() for n in spec]
    if product_feats is not None:
        cols += PRODUCT_FEATURES + [c for c in ("product_group",) if c in product_feats.columns]
    if location_feats is not None:
        cols += LOCATION_FEATURES
    return sorted(cols)


def build_features(train: DataFrame, test: DataFrame, product_feats: DataFrame | None,
                   location_feats: DataFrame | None, keep_unmatched: bool = False,
                   label: str = "demand", materialize_stats: bool = False
                   ) -> tuple[DataFrame, DataFrame]:
    """Train and test feature tables; every statistic comes from ``train`` only.

    Train rows keep ``row_id`` and the label; test rows keep ``id``. On train
    rows the statistics include the row itself (as in the source pipeline);
    only the previous-period ones exclude it.

    Tables keyed alike are merged before they meet the rows, so the row side
    is joined once per key set: per-product distinct counts ride on the
    product dimension, per-depot counts on the location dimension (both
    written once, so the planner knows their bytes), per-client counts on the
    client log-mean table.

    ``materialize_stats`` (for jobs that need both sides) writes the client table
    and the medians for both outputs, and takes the five log-means that hold the
    product as windows over the rows themselves (``product_means``): the rows are
    dealt once for all of them, and no table of statistics is joined or written.
    """
    cols = feature_columns(product_feats, location_feats)
    counts = {key: unique_counts(train, key) for key in UNIQUE_SPECS}
    if materialize_stats:
        counts = {k: materialize(c, f"counts-{k}") for k, c in counts.items()}
        stats, global_mean = None, materialize(global_log_mean(train, label), "global-mean")
        client = level_mean(train, "lm_client", label)
    else:
        stats = mean_stats(train, label)
        global_mean, client = stats.global_mean, stats.client
    medians = count_medians([(counts[k], list(spec)) for k, spec in UNIQUE_SPECS.items()])
    client_side = client.join(counts["client_id"], "client_id", "full")
    if materialize_stats:
        medians = materialize(medians, "count-medians")
        client_side = materialize(client_side, "client-features")
    how = "left" if keep_unmatched else "inner"

    def keyed(dim: DataFrame | None, key: str) -> tuple[DataFrame, str]:
        if dim is None:
            return counts[key], "left"
        return written_dimension(dim.join(counts[key], key, "left")), how

    prod_side, prod_how = keyed(product_feats, "product_id")
    depot_side, depot_how = keyed(location_feats, "depot_id")

    def with_dimensions(rows: DataFrame) -> DataFrame:
        return rows.join(prod_side, "product_id", prod_how).join(depot_side, "depot_id", depot_how)

    def joined(rows: DataFrame) -> DataFrame:
        df = left_attach(with_dimensions(rows), client_side, ["client_id"])
        df = left_attach(df, stats.client_product, ["client_id", "product_id"])
        df = left_attach(df, stats.depot_product, ["depot_id", "product_id"])
        df = left_attach(df, stats.client_product_depot, ["client_id", "product_id", "depot_id"])
        df = left_attach(df, stats.prev_depot_product, ["period", "depot_id", "product_id"])
        return left_attach(df, stats.prev_client_depot_product,
                           ["period", "client_id", "depot_id", "product_id"])

    def windowed(rows: DataFrame, others: DataFrame | None) -> DataFrame:
        df = left_attach(rows, client_side, ["client_id"])   # while the rows are narrow
        if prod_how == "inner":     # rows without a product are lost to its join and in no mean
            known = F.col("product_id").isNotNull()
            df, others = df.where(known), None if others is None else others.where(known)
        # the dimensions come last: rows they drop or repeat still count once in the means
        return with_dimensions(product_means(df, label, others))

    def assemble(rows: DataFrame, others: DataFrame | None = None) -> DataFrame:
        df = windowed(rows, others) if materialize_stats else joined(rows)
        df = with_constants(with_constants(df, global_mean), medians)
        names = [n for spec in UNIQUE_SPECS.values() for n in spec]
        df = df.withColumns({n: F.coalesce(F.col(n).cast("double"), F.col(f"_med_{n}"))
                             for n in names})
        return resolve_chain(df)

    train_id = [c for c in ("row_id",) if c in train.columns]
    return (assemble(train).select(*train_id, *cols, label),
            assemble(test, train).select("id", *cols))


def product_means(rows: DataFrame, label: str = "demand", others: DataFrame | None = None) -> DataFrame:
    """``rows`` with the log-means of every level that holds the product: NULL for a NULL key or
    where no training row has the key (in the period before, for the previous-period ones).

    Training rows are ``rows`` themselves or, for rows without a label, ``others``, which join the
    windows and are dropped behind them. The rows are dealt by product once, which serves all
    windows; a window sorts and spills, so no group is held in memory."""
    lv = F.log1p(F.col(label).cast("double"))
    keys = ["period", "client_id", "depot_id", "product_id"]
    if others is None:
        df = rows.withColumn("_lv", lv)
    else:
        df = (rows.withColumns({"_asked": F.lit(True), "_lv": F.lit(None).cast("double")})
              .unionByName(others.select(*keys, F.lit(False).alias("_asked"), lv.alias("_lv")), allowMissingColumns=True))
    df = df.repartition("product_id")

    def mean(by: list[str], w: WindowSpec) -> Column:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
        return F.when(known, F.expm1(F.avg("_lv").over(w)))

    def ordered(by: list[str]) -> WindowSpec:
        return Window.partitionBy("product_id", *by).orderBy(F.col("period").cast("long"))

    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    client, depot, both = ["client_id"], ["depot_id"], ["client_id", "depot_id"]
    df = df.withColumn("lm_client_product", mean([*client, "product_id"], Window.partitionBy("product_id", *client)))
    # the mean over all periods shares the order of the one before, so a level is sorted once
    for by, every, before in ((both, "lm_client_product_depot", "lm_prev_client_depot_product"),
                              (depot, "lm_depot_product", "lm_prev_depot_product")):
        df = df.withColumns({every: mean([*by, "product_id"], ordered(by).rangeBetween(*whole)),
                             before: mean([*by, "product_id", "period"], ordered(by).rangeBetween(-1, -1))})
    if others is not None:
        df = df.where("_asked").drop("_asked")
    return df.drop("_lv")

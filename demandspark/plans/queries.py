"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) whole;
nothing is capped or sampled unless sampling is the operator itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators import features as FE
from demandspark.operators import products as PR
from demandspark.operators import target_means as TM
from demandspark.operators import unique_counts as UC
from demandspark.operators.joins import with_constants
from demandspark.plans.common import round_doubles
from demandspark.session import materialize, shared_dir
from demandspark.sources import fixtures as FX
from demandspark.sources import io as IO

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_FEATURE_MEMO: dict = {}


def fitted_query(name: str):
    """Register a query that fits a model. Its result is written once a session,
    so that the query that states facts about it doesn't fit the model again."""
    def deco(fn):
        def q(spark, sf):
            key = (name, spark.sparkContext.applicationId, sf)
            if key not in _FEATURE_MEMO:
                _FEATURE_MEMO[key] = materialize(fn(spark, sf), name)
            return _FEATURE_MEMO[key]
        QUERIES[name] = q
        return q
    return deco


# ---------------------------------------------------------------- scans

@register("demand_scan")
def demand_scan(spark: SparkSession, sf: str) -> DataFrame:
    return FX.demand(spark, sf)


@register("test_scan")
def test_scan(spark: SparkSession, sf: str) -> DataFrame:
    return FX.train_test(spark, sf)[1]


@register("pruned_scan")
def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    return FX.demand(spark, sf, with_row_id=False).select("client_id", "product_id", "demand")


@register("head_rows")
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return IO.first_rows(FX.demand(spark, sf), 20, ["row_id"])


# ---------------------------------------------------------------- log-means

def _train(spark, sf, dense=False, with_row_id=False):
    return FX.train_test(spark, sf, dense=dense, with_row_id=with_row_id)[0]


@register("log_mean_global")
def log_mean_global(spark, sf):
    return round_doubles(TM.global_log_mean(_train(spark, sf)))


def _level_query(name):
    def q(spark, sf):
        return round_doubles(TM.level_mean(_train(spark, sf), name))
    return q


for _key, _name in [("log_mean_client", "lm_client"),
                    ("log_mean_client_product", "lm_client_product"),
                    ("log_mean_agency_product", "lm_depot_product"),
                    ("log_mean_client_product_agency", "lm_client_product_depot"),
                    ("log_mean_agency", "lm_depot"),
                    ("prev_period_agency", "lm_prev_depot"),
                    ("prev_period_agency_product", "lm_prev_depot_product"),
                    ("prev_period_client_agency_product", "lm_prev_client_depot_product")]:
    register(_key)(_level_query(_name))


@register("lag_join")
def lag_join(spark, sf):
    """Train rows (dense keys) with the previous-period depot x product log-mean (NULL if none)."""
    train = _train(spark, sf, dense=True, with_row_id=True)
    prev = TM.level_mean(train, "lm_prev_depot_product")
    out = train.join(prev, ["period", "depot_id", "product_id"], "left")
    return round_doubles(out.select("row_id", "lm_prev_depot_product"))


@register("lag_window_equiv")
def lag_window_equiv(spark, sf):
    """Same values as lag_join from a range window (train rows only)."""
    train = _train(spark, sf, dense=True, with_row_id=True)
    out = TM.prev_period_window_mean(train, ["depot_id", "product_id"], "lm_prev_depot_product")
    return round_doubles(out.select("row_id", "lm_prev_depot_product"))


# ---------------------------------------------------------------- unique counts

def _unique_query(key):
    def q(spark, sf):
        return UC.unique_counts(_train(spark, sf), key, with_extra=True)
    return q


for _key, _col in [("unique_counts_agency", "depot_id"), ("unique_counts_client", "client_id"),
                   ("unique_counts_product", "product_id")]:
    register(_key)(_unique_query(_col))


@register("unique_counts_filled")
def unique_counts_filled(spark, sf):
    train, test = FX.train_test(spark, sf)
    return round_doubles(UC.add_unique_features(test, train))


# ---------------------------------------------------------------- feature job

@register("fallback_chain")
def fallback_chain(spark, sf):
    """Flagship: every test row with the full log-mean fallback chain."""
    train, test = FX.train_test(spark, sf)
    train = train.drop("row_id")
    out = FE.attach_means(test, TM.mean_stats(train))
    return round_doubles(out.select("id", *FE.CHAIN))


def _features(spark, sf):
    """Both feature tables over statistics that are merged and written once for the two queries."""
    key = ("plain features", spark.sparkContext.applicationId, sf)
    if key not in _FEATURE_MEMO:
        train, test = FX.train_test(spark, sf)
        prods = PR.product_features(PR.prepare_products(FX.products(spark, sf)))
        locs = PR.location_features(PR.prepare_locations(FX.locations(spark, sf)))
        _FEATURE_MEMO[key] = FE.build_features(train, test, prods, locs, materialize_stats=True)
    return _FEATURE_MEMO[key]


@register("build_features_train")
def build_features_train(spark, sf):
    return round_doubles(_features(spark, sf)[0])


@register("build_features_test")
def build_features_test(spark, sf):
    return round_doubles(_features(spark, sf)[1])


# ---------------------------------------------------------------- products / locations

@register("products_prepared")
def products_prepared(spark, sf):
    return round_doubles(PR.prepare_products(FX.products(spark, sf)))


@register("location_encoded")
def location_encoded(spark, sf):
    return PR.prepare_locations(FX.locations(spark, sf))


# ---------------------------------------------------------------- scans and sinks

from demandspark.functions import expressions as X  # noqa: E402
from demandspark.functions.text import drop_stop_words, processed_name, stemmed, tokens  # noqa: E402
from demandspark.operators import metrics as ME  # noqa: E402
from demandspark.operators import models as M  # noqa: E402
from demandspark.operators import profile as PF  # noqa: E402
from demandspark.operators import boosting as BO  # noqa: E402
from demandspark.operators import splits as SP  # noqa: E402
from demandspark.operators import stacking as ST  # noqa: E402
from demandspark.operators.words import document_frequency, word_counts  # noqa: E402
from demandspark.plans import jobs as J  # noqa: E402
from demandspark.sources.schemas import DEMAND_SCHEMA, model_features  # noqa: E402

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("file_inventory")
def file_inventory(spark, sf):
    return IO.file_inventory(spark, [f"{sf}/{t}.parquet" for t in TABLE_NAMES])


@register("csv_roundtrip")
def csv_roundtrip(spark, sf):
    path = IO.write_csv(FX.demand(spark, sf), shared_dir(spark, "demand-csv"))
    return IO.read_csv(spark, path, DEMAND_SCHEMA)


@register("parquet_cache")
def parquet_cache(spark, sf):
    """Prepared products from their cache: the first call builds it, the second reads it."""
    path, prods = shared_dir(spark, "products-cache"), FX.products(spark, sf)
    for _ in range(2):
        built = IO.cached_table(spark, path, lambda: PR.prepare_products(prods), inputs=[prods])
    return round_doubles(built)


@register("partitioned_roundtrip")
def partitioned_roundtrip(spark, sf):
    rows = SP.chunk_ids(FX.demand(spark, sf), 8)
    path = IO.write_parquet(rows, shared_dir(spark, "demand-chunks"), ["chunk_id"])
    return spark.read.parquet(path).withColumn("chunk_id", F.col("chunk_id").cast("int"))


# ---------------------------------------------------------------- dormant mean joins

@register("returns_style_mean")
def returns_style_mean(spark, sf):
    """Log-mean of returned units per client on train, joined to test rows,
    unknown clients filled with the global returns log-mean."""
    rows = FX.demand(spark, sf, with_returns=True)
    train = rows.where(F.col("period") < FX.SPLIT_PERIOD)
    test = rows.where(F.col("period") >= FX.SPLIT_PERIOD).withColumnRenamed("row_id", "id")
    by_client = TM.target_mean(train, ["client_id"], "lm_returns_client", value="returns")
    g = TM.global_log_mean(train, "returns", "lm_returns_global")
    out = with_constants(test.join(by_client, "client_id", "left"), g)
    return round_doubles(out.select(
        "id", F.coalesce("lm_returns_client", "lm_returns_global").alias("lm_returns_client")))


@register("client_period_product_mean")
def client_period_product_mean(spark, sf):
    """Log-mean per (client, period, product) on train joined to test rows,
    falling back to the client x product chain value."""
    train, test = FX.train_test(spark, sf)
    cwp = TM.target_mean(train, ["client_id", "period", "product_id"], "lm_client_period_product")
    chained = FE.fallback_chain(train, test)
    out = chained.join(cwp, ["client_id", "period", "product_id"], "left")
    return round_doubles(out.select("id", F.coalesce("lm_client_period_product", "lm_client_product")
                                    .alias("lm_client_period_product")))


@register("agency_means_joined")
def agency_means_joined(spark, sf):
    """Depot log-mean (filled with the global) and previous-period depot
    log-mean (filled with the depot value) on test rows."""
    train, test = FX.train_test(spark, sf)
    g = TM.global_log_mean(train)
    d = TM.level_mean(train, "lm_depot")
    wd = TM.level_mean(train, "lm_prev_depot")
    out = (with_constants(test, g).join(d, "depot_id", "left")
           .join(wd, ["period", "depot_id"], "left"))
    dep = F.coalesce("lm_depot", "lm_global")
    return round_doubles(out.select("id", dep.alias("lm_depot"),
                                    F.coalesce(F.col("lm_prev_depot"), dep).alias("lm_prev_depot")))


# ---------------------------------------------------------------- products and text

@register("product_attributes")
def product_attributes(spark, sf):
    return round_doubles(PR.product_attributes(FX.products(spark, sf)))


@register("inner_join_unmatched")
def inner_join_unmatched(spark, sf):
    """The dimension join that loses rows: train rows meet the products whose
    brand is known, so rows of unbranded products drop out."""
    branded = PR.product_attributes(FX.products(spark, sf)).where(F.col("brand").isNotNull())
    rows = FE.attach_dimensions(_train(spark, sf, with_row_id=True),
                                branded.select("product_id", "brand"), None)
    return rows.select("row_id", "product_id", "brand", "demand")


@register("label_encode")
def label_encode(spark, sf):
    return PR.with_codes(FX.products(spark, sf)).select(
        "product_id", "short_name", "short_name_code", "brand", "brand_code")


@register("brand_mean_weight")
def brand_mean_weight(spark, sf):
    return round_doubles(PR.brand_mean(PR.with_codes(FX.products(spark, sf)), "weight",
                                       "avg_brand_weight"))


@register("brand_mean_pieces")
def brand_mean_pieces(spark, sf):
    return round_doubles(PR.brand_mean(PR.with_codes(FX.products(spark, sf)), "pieces",
                                       "avg_brand_pieces"))


@register("product_imputed")
def product_imputed(spark, sf):
    p = PR.prepare_products(FX.products(spark, sf))
    return round_doubles(p.select("product_id", "weight", "pieces", "avg_brand_weight"))


@register("name_tokens")
def name_tokens(spark, sf):
    attrs = PR.product_attributes(FX.products(spark, sf))
    return attrs.select("product_id", processed_name("short_name").alias("short_name_processed"))


@register("bag_of_words")
def bag_of_words(spark, sf):
    return document_frequency(_named_products(spark, sf), "short_name_processed")


def _named_products(spark, sf):
    return PR.named_products(FX.products(spark, sf))


@register("bag_of_words_counts")
def bag_of_words_counts(spark, sf):
    """The bag of words itself: (product, word number, word, count)."""
    return word_counts(_named_products(spark, sf), "short_name_processed")


@register("document_words")
def document_words(spark, sf):
    """Whole Spanish documents: word tokens, stop words dropped, stemmed;
    (token, doc_freq) for tokens in at least two documents."""
    docs = FX.spanish_documents(spark, sf).select("doc_id", tokens("text").alias("_tokens"))
    kept = drop_stop_words(docs, "_tokens", "_kept")
    t = kept.select("doc_id", F.explode(F.array_distinct(stemmed(F.col("_kept")))).alias("token"))
    return (t.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))
            .where(F.col("doc_freq") >= 2))


@fitted_query("product_group_gmm")
def product_group_gmm(spark, sf):
    attrs = PR.named_products(FX.products(spark, sf))
    return PR.product_groups(attrs, "gmm")


@fitted_query("product_group_kmeans")
def product_group_kmeans(spark, sf):
    attrs = PR.named_products(FX.products(spark, sf))
    return PR.product_groups(attrs, "kmeans")


# ---------------------------------------------------------------- profiling

@register("product_period_stats")
def product_period_stats(spark, sf):
    return round_doubles(PF.grouped_stats(_train(spark, sf), ["period", "product_id"],
                                          ["demand", "channel_id"]))


@register("median_join_back")
def median_join_back(spark, sf):
    train = _train(spark, sf, with_row_id=True)
    out = PF.median_join_back(train, ["client_id", "product_id"])
    return round_doubles(out.select("row_id", "client_id", "product_id", "demand", "median_demand"))


@register("median_vs_log_mean")
def median_vs_log_mean(spark, sf):
    return round_doubles(PF.median_and_log_mean(_train(spark, sf), ["depot_id"]))


@register("describe_numeric")
def describe_numeric(spark, sf):
    return round_doubles(PF.describe(_train(spark, sf)))


@register("describe_test")
def describe_test(spark, sf):
    return round_doubles(PF.describe(FX.train_test(spark, sf)[1]))


@register("describe_unique_counts")
def describe_unique_counts(spark, sf):
    """Description of the distinct counts per depot, client and product."""
    train = _train(spark, sf)
    parts = []
    for key in ("depot_id", "client_id", "product_id"):
        # a row per key, written once: the moments and the quantiles read it, not the count of the whole table twice
        counts = materialize(UC.unique_counts(train, key, with_extra=True), "unique-counts")
        parts.append(PF.describe(counts.drop(key)).select(F.lit(key).alias("key"), "*"))
    return round_doubles(SP.union_parts(parts))


@register("table_shape")
def table_shape(spark, sf):
    train, test = FX.train_test(spark, sf)
    return PF.table_shape({"train": train, "test": test})


@register("null_counts")
def null_counts(spark, sf):
    return PF.null_counts(PR.product_attributes(FX.products(spark, sf)))


@register("top_values")
def top_values(spark, sf):
    return PF.top_values(_train(spark, sf), "demand", 10)


@register("distinct_values")
def distinct_values(spark, sf):
    cols = ["period", "depot_id", "channel_id", "route_id", "client_id", "product_id"]
    return _train(spark, sf).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


@register("natural_self_join")
def natural_self_join(spark, sf):
    return PF.self_join_counts(FX.clients(spark, sf))


@register("unseen_products")
def unseen_products(spark, sf):
    train, test = FX.train_test(spark, sf, with_row_id=False)
    return PF.unseen(test, train)


@register("distinct_products")
def distinct_products(spark, sf):
    train, test = FX.train_test(spark, sf, with_row_id=False)
    return PF.coverage(test, train)


# ---------------------------------------------------------------- metrics

def _chain_scored(spark, sf):
    train, test = FX.train_test(spark, sf)
    chained = FE.attach_means(test, TM.mean_stats(train.drop("row_id")))
    labels = FX.demand(spark, sf).select(F.col("row_id").alias("id"), "demand")
    return chained.join(labels, "id")


@register("rmsle_strict")
def rmsle_strict(spark, sf):
    return round_doubles(ME.score(_chain_scored(spark, sf), "lm_prev_client_depot_product",
                                  "demand", clamp=False))


@register("rmsle_clamped")
def rmsle_clamped(spark, sf):
    return round_doubles(ME.score(_chain_scored(spark, sf), "lm_prev_client_depot_product",
                                  "demand", clamp=True))


@register("constant_baselines")
def constant_baselines(spark, sf):
    return round_doubles(ME.constant_baselines(_train(spark, sf)))


@register("cap_label")
def cap_label_q(spark, sf):
    t = _train(spark, sf, with_row_id=True)
    return t.select("row_id", "demand", X.cap_label("demand").alias("demand_capped"))


@register("floor_prediction")
def floor_prediction(spark, sf):
    t = _train(spark, sf, with_row_id=True)
    return t.select("row_id", X.floor_zero(F.col("demand") - 25).alias("floored"))


@register("binarise_label")
def binarise_label(spark, sf):
    t = _train(spark, sf, with_row_id=True)
    return t.select("row_id", X.binarise(F.col("demand") / 50.0).alias("label"))


# ---------------------------------------------------------------- splits

@register("kfold_exact")
def kfold_exact(spark, sf):
    t = _train(spark, sf, with_row_id=True)
    return SP.exact_folds(t, 10, order=[F.col("row_id")]).select("row_id", "fold")


@register("kfold_hash")
def kfold_hash(spark, sf):
    """Per fold: whether its ids are unique and its size is a fifth within a fifth."""
    t = _train(spark, sf, with_row_id=True)
    folds = SP.hash_folds(t, 5).groupBy("fold").agg(F.count(F.lit(1)).alias("_n"),
                                                    F.count_distinct("row_id").alias("_ids"))
    total = t.agg(F.count(F.lit(1)).alias("_t"))
    return with_constants(folds, total).select(
        "fold", (F.col("_n") == F.col("_ids")).alias("unique_ids"),
        (F.abs(5 * F.col("_n") / F.col("_t") - 1) < 0.2).alias("balanced"))


@register("chunk_ids")
def chunk_ids_q(spark, sf):
    return SP.chunk_ids(_train(spark, sf, with_row_id=True), 8).select("row_id", "chunk_id")


@register("split_union")
def split_union(spark, sf):
    """Eight consecutive parts, each a table of its own, and their union."""
    return SP.union_parts(SP.split_parts(_train(spark, sf, with_row_id=True), 8))


@register("holdout_split")
def holdout_split(spark, sf):
    """Rows, distinct ids over both sides, ids on both sides, and whether a fifth is held out."""
    t = _train(spark, sf, with_row_id=True)
    a, b = SP.holdout_split(t)
    sides = (a.select("row_id", F.lit(0).alias("_held")).unionByName(b.select("row_id", F.lit(1).alias("_held")))
             .groupBy("row_id").agg(F.min("_held").alias("_lo"), F.max("_held").alias("_hi")))
    return sides.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.sum((F.col("_lo") != F.col("_hi")).cast("long")).alias("n_on_both"),
        F.avg("_hi").between(0.15, 0.25).alias("fifth_held_out"))


@register("shuffle_rows")
def shuffle_rows_q(spark, sf):
    s = SP.shuffle_rows(_train(spark, sf, with_row_id=True))
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("shuffled_pos").alias("n_positions"),
                 F.min("shuffled_pos").alias("min_pos"), F.max("shuffled_pos").alias("max_pos"),
                 F.sum("row_id").alias("sum_ids"),
                 (F.abs(F.corr("row_id", "shuffled_pos")) < 0.2).alias("order_is_new"))


SAMPLE_ROWS = 2_000_000


@register("exact_sample")
def exact_sample_q(spark, sf):
    """Half of the train rows: their number, distinct ids, and whether they lie
    all over the id range (the mean id is near that of all rows)."""
    t = _train(spark, sf, with_row_id=True)
    all_rows = t.agg(F.count(F.lit(1)).alias("n"), F.avg("row_id").alias("mean_id")).first()
    s = SP.exact_sample(t, all_rows["n"] // 2)
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"),
                 F.coalesce(F.abs(F.avg("row_id") / all_rows["mean_id"] - 1) < 0.1, F.lit(True)).alias("spread"))


# ---------------------------------------------------------------- scaling and models

SCALE_COLS = ["period", "channel_id", "route_id"]


@register("standard_scale")
def standard_scale(spark, sf):
    train, test = FX.train_test(spark, sf)
    return round_doubles(M.standard_scale(train, test, SCALE_COLS, "_scaled")
                         .select("id", *[f"{c}_scaled" for c in SCALE_COLS]))


@register("impute_mean")
def impute_mean_q(spark, sf):
    attrs = PR.product_attributes(FX.products(spark, sf))
    return round_doubles(M.impute_mean(attrs, ["weight", "pieces"])
                         .select("product_id", "weight", "pieces"))


@register("ols_one_feature")
def ols_one_feature(spark, sf):
    return round_doubles(M.ols_line(_train(spark, sf), "period", "demand"))


def _grouped_products(spark, sf):
    """Prepared products with their group, written once for all models."""
    key = ("products", spark.sparkContext.applicationId, sf)
    if key not in _FEATURE_MEMO:
        _FEATURE_MEMO[key] = materialize(PR.prepare_products(FX.products(spark, sf), cluster="gmm"), "grouped-products")
    return _FEATURE_MEMO[key]


def _feature_tables(spark, sf):
    """Train and test features with the product group, written once for all models."""
    key = ("features", spark.sparkContext.applicationId, sf)
    if key not in _FEATURE_MEMO:
        train, test = FX.train_test(spark, sf)
        prods = PR.product_features(_grouped_products(spark, sf))
        locs = PR.location_features(PR.prepare_locations(FX.locations(spark, sf)))
        tr, te = FE.build_features(train, test, prods, locs, materialize_stats=True)
        _FEATURE_MEMO[key] = (materialize(tr, "train-features"), materialize(te, "test-features"))
    return _FEATURE_MEMO[key]


@fitted_query("ols_predict")
def ols_predict(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    return M.predict_imputed(M.fit_imputed(M.ols(), tr, cols, cap=M.LABEL_CAP), te, cols)


def _gbt_model(spark, sf, train, cols):
    """The booster at its full number of rounds, fitted once for prediction and importance."""
    key = ("gbt", spark.sparkContext.applicationId, sf)
    if key not in _FEATURE_MEMO:
        _FEATURE_MEMO[key] = M.fit(M.gbt_regressor(), train, cols)
    return _FEATURE_MEMO[key]


@fitted_query("gbt_predict")
def gbt_predict(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    return M.predict(_gbt_model(spark, sf, tr, cols), te, cols)


@fitted_query("gbt_early_stop")
def gbt_early_stop(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    flagged = SP.hash_folds(tr, 5).withColumn("is_valid", F.col("fold") == 1)
    return BO.fit_early_stop(flagged, cols).predict(te, cols)


@fitted_query("gbt_with_words")
def gbt_with_words(spark, sf):
    """Boosting on the features plus the product bag-of-words vector."""
    tr, te = _feature_tables(spark, sf)
    attrs = PR.named_products(FX.products(spark, sf))
    _, vec = PR.bag_of_words(attrs)
    words = vec.select("product_id", "words")
    cols = model_features(with_groups=True) + ["words"]
    model = M.fit(M.gbt_regressor(), tr.join(words, "product_id"), cols)
    return M.predict(model, te.join(words, "product_id"), cols)


@fitted_query("linear_booster_predict")
def linear_booster_predict(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    return M.predict_imputed(M.fit_imputed(M.linear_booster(), tr, cols), te, cols)


@fitted_query("forest_predict")
def forest_predict(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    return M.predict(M.fit(M.random_forest(), tr, cols), te, cols)


@fitted_query("binary_classify")
def binary_classify(spark, sf):
    tr, te = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    model = M.fit_binary(tr.withColumn("label", F.col("demand") / 50.0), cols)
    return M.predict_binary(model, te, cols)


@fitted_query("feature_importance")
def feature_importance(spark, sf):
    tr, _ = _feature_tables(spark, sf)
    cols = model_features(with_groups=True)
    return BO.split_importance(_gbt_model(spark, sf, tr, cols), cols)


@register("importance_share")
def importance_share(spark, sf):
    """Share of total and ascending order of a count table (rows per channel)."""
    from pyspark.sql import Window
    counts = _train(spark, sf).groupBy("channel_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return (with_constants(counts, total)
            .select(F.col("channel_id").alias("feature"), (F.col("n") / F.col("_t")).alias("fscore"))
            .withColumn("rank", F.row_number().over(Window.orderBy("fscore", "feature")).cast("int")))


# ---------------------------------------------------------------- stacking

OOF_MODELS = {"client": ["client_id"], "product": ["product_id"], "depot": ["depot_id"]}
OOF_FOLDS = 5


def _folded_train(spark, sf):
    """Train rows with exact folds, written once: every fold model reads it."""
    t = _train(spark, sf, with_row_id=True)
    return materialize(SP.exact_folds(t, OOF_FOLDS, order=[F.col("row_id")]), "folds")


@register("oof_group_mean")
def oof_group_mean(spark, sf):
    return round_doubles(ST.oof_group_mean(_folded_train(spark, sf), ["client_id"], OOF_FOLDS,
                                           "client"))


@register("test_fold_mean")
def test_fold_mean(spark, sf):
    _, test = FX.train_test(spark, sf)
    return round_doubles(ST.test_fold_mean(_folded_train(spark, sf), test, ["client_id"],
                                           OOF_FOLDS, "client"))


@register("blend_pivot")
def blend_pivot(spark, sf):
    folded = _folded_train(spark, sf)
    parts = [ST.oof_group_mean(folded, keys, OOF_FOLDS, name) for name, keys in OOF_MODELS.items()]
    return round_doubles(ST.blend_pivot(SP.union_parts(parts), list(OOF_MODELS)))


def _stack(spark, sf):
    key = ("stack", spark.sparkContext.applicationId, sf)
    if key not in _FEATURE_MEMO:
        tr, te = _feature_tables(spark, sf)
        cols = model_features(with_groups=True)
        est = ST.base_models()
        oof, tst = J.stack_phase_one(tr, te, cols, estimators=est)
        _FEATURE_MEMO[key] = (oof, tst, tr, list(est))
    return _FEATURE_MEMO[key]


@fitted_query("stack_oof")
def stack_oof(spark, sf):
    return _stack(spark, sf)[0]


@fitted_query("stack_test_mean")
def stack_test_mean(spark, sf):
    return ST.mean_over(_stack(spark, sf)[1], ["id", "model"])


@fitted_query("stack_submission")
def stack_submission(spark, sf):
    oof, tst, tr, models = _stack(spark, sf)
    return J.stack_phase_two(oof, tst, tr, models)


@fitted_query("cv_evaluate")
def cv_evaluate(spark, sf):
    """The fold evaluation on all rows: the sample has as many rows as the table."""
    rows = FX.demand(spark, sf)
    return J.cv_evaluate(spark, rows, FX.products(spark, sf), FX.locations(spark, sf),
                         n_rows=rows.count(), k=5, prepared=_grouped_products(spark, sf))


@fitted_query("cv_evaluate_linear")
def cv_evaluate_linear(spark, sf):
    """The same fold evaluation with ordinary least squares: labels capped at 10, missing features filled."""
    rows = FX.demand(spark, sf)
    return J.cv_evaluate(spark, rows, FX.products(spark, sf), FX.locations(spark, sf),
                         n_rows=SAMPLE_ROWS, k=5, estimator=M.ols(), cap=M.LABEL_CAP, imputed=True,
                         prepared=_grouped_products(spark, sf))


@register("feature_job")
def feature_job(spark, sf):
    """The feature job end to end: prepared products/locations cached as
    parquet, train/test features written to the shared folder, test features
    read back. Clustering has no SQL: for the product group it says whether the
    row has one in range."""
    train, test = FX.train_test(spark, sf)
    out = J.create_features(spark, train, test, FX.products(spark, sf), FX.locations(spark, sf),
                            cluster="gmm")
    grouped = F.col("product_group").between(0, PR.GMM_COMPONENTS - 1)
    return round_doubles(out.test.withColumn("has_group", F.coalesce(grouped, F.lit(False)))
                         .drop("product_group"))


@register("submission_sink")
def submission_sink(spark, sf):
    """Submission writer: (id, demand >= 0) as CSV, read back with its schema.
    Predictions are the resolved fallback-chain value of each test row."""
    from demandspark.sources.schemas import SUBMISSION_SCHEMA
    train, test = FX.train_test(spark, sf)
    pred = FE.attach_means(test, TM.mean_stats(train.drop("row_id"))).select(
        "id", F.col("lm_prev_client_depot_product").alias("prediction"))
    path = IO.write_submission(pred, shared_dir(spark, "submission"))
    return round_doubles(IO.read_csv(spark, path, SUBMISSION_SCHEMA))


# ---------------------------------------------------------------- facts of fitted results
# A model's values have no SQL; what must hold of any of its results has.

def _facts(rows, key, value, low, high, group=()):
    """Rows, distinct keys, values that are missing or out of [low, high], and whether values differ."""
    ok = F.coalesce((~F.isnan(F.col(value).cast("double"))) & F.col(value).between(low, high), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids"),
            F.sum(key).cast("long").alias("sum_ids"), F.count_if(~ok).alias("n_wrong"),
            F.coalesce(F.min(value) < F.max(value), F.lit(False)).alias("varied")]
    return rows.groupBy(*group).agg(*aggs) if group else rows.agg(*aggs)


TOP_DEMAND = 50.0        # the greatest demand of the tables; a capped label's is LABEL_CAP
# query -> (key, value, least and greatest value, grouping)
FACTS = {
    "ols_predict": ("id", "prediction", 0.0, 2.0 * M.LABEL_CAP, ()),
    **{name: ("id", "prediction", 0.0, 1.5 * TOP_DEMAND, ()) for name in (
        "gbt_predict", "gbt_early_stop", "gbt_with_words", "linear_booster_predict", "forest_predict")},
    "product_group_gmm": ("product_id", "product_group", 0, PR.GMM_COMPONENTS - 1, ()),
    "product_group_kmeans": ("product_id", "product_group", 0, PR.KMEANS_CLUSTERS - 1, ()),
    "stack_oof": ("row_id", "prediction", -TOP_DEMAND, 2 * TOP_DEMAND, ("model",)),
    "stack_test_mean": ("id", "prediction", -TOP_DEMAND, 2 * TOP_DEMAND, ("model",)),
    "stack_submission": ("id", "demand", 0.0, 1.5 * TOP_DEMAND, ()),
}


def _facts_query(name, spec):
    def q(spark, sf):
        return _facts(QUERIES[name](spark, sf), *spec)
    return q


for _key, _spec in FACTS.items():
    register(f"{_key}_facts")(_facts_query(_key, _spec))


@register("binary_classify_facts")
def binary_classify_facts(spark, sf):
    """As above, with p0 + p1 = 1 and a class that follows the larger probability."""
    rows = QUERIES["binary_classify"](spark, sf)
    ok = (F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9) & (
        F.col("prediction") == (F.col("p1") > F.col("p0")).cast("int"))
    return _facts(rows.withColumn("_p", F.when(ok, F.col("p1"))), "id", "_p", 0.0, 1.0)


@register("feature_importance_facts")
def feature_importance_facts(spark, sf):
    """Shares of splits and of gain each sum to 1, over distinct features of the model."""
    rows = QUERIES["feature_importance"](spark, sf)
    return rows.agg((F.abs(F.sum("fscore") - 1) < 1e-9).alias("shares_sum_to_1"),
                    (F.abs(F.sum("gain") - 1) < 1e-9).alias("gains_sum_to_1"),
                    (F.count(F.lit(1)) == F.count_distinct("feature")).alias("distinct"),
                    F.count_if(~F.col("feature").isin(model_features(with_groups=True))).alias("n_unknown"))


def _cv_facts(name):
    def q(spark, sf):
        return QUERIES[name](spark, sf).select(
            "fold", "n_train", "n_valid", F.col("rmsle").between(0.0, 5.0).alias("rmsle_in_range"))
    return q


for _key in ("cv_evaluate", "cv_evaluate_linear"):
    register(f"{_key}_facts")(_cv_facts(_key))


PLANTED_COLS = ["channel_id", "depot_id", "route_id"]


def planted(rows):
    """Rows with a label that two of the features decide."""
    y = F.col("channel_id") * 3 + F.col("route_id") / 10
    return rows.withColumn("demand", y.cast("double"))


def learnt(scored):
    """Whether the error of (prediction, demand) is below 0.7 of the best constant's, the mean of the logs."""
    off = F.log1p(X.floor_zero(F.col("prediction"))) - F.log1p("demand")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      (F.sqrt(F.avg(off * off)) < 0.7 * F.stddev_pop(F.log1p("demand"))).alias("beats_constant"))


@register("planted_signal_facts")
def planted_signal_facts(spark, sf):
    """Each kind of model learns a planted label on the train rows and predicts it on the test rows."""
    train, test = FX.train_test(spark, sf)
    tr, te = planted(train), planted(test)
    cols, parts = PLANTED_COLS, []
    for name, est, imputed in (("gbt", M.gbt_regressor(), False), ("forest", M.random_forest(5, maxDepth=8), False),
                               ("linear_booster", M.linear_booster(), True), ("ols", M.ols(), True)):
        fit, predict = (M.fit_imputed, M.predict_imputed) if imputed else (M.fit, M.predict)
        pred = predict(fit(est, tr, cols), te, cols)
        parts.append(learnt(pred.join(te.select("id", "demand"), "id")).select(F.lit(name).alias("model"), "*"))
    return SP.union_parts(parts)


@register("ols_two_features")
def ols_two_features(spark, sf):
    """Ordinary least squares of demand on period and channel: one row of coefficients."""
    m = M.fit_ols(_train(spark, sf), ["period", "channel_id"], cap=None)
    row = (float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept))
    return round_doubles(spark.createDataFrame([row], "slope_period double, slope_channel double, intercept double"))


@register("file_inventory_facts")
def file_inventory_facts(spark, sf):
    """Whether every table has a file, and files without a size."""
    rows = QUERIES["file_inventory"](spark, sf)
    return rows.agg((F.count(F.lit(1)) >= len(TABLE_NAMES)).alias("all_listed"),
                    F.count_if(~F.coalesce(F.col("size_mb") >= 0, F.lit(False))).alias("n_unsized"))


@register("feature_product_groups")
def feature_product_groups(spark, sf):
    """Per product of the train features: rows, number of groups, and whether each row has one."""
    tr, _ = _feature_tables(spark, sf)
    return tr.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("product_group").alias("n_groups"),
        (F.count("product_group") == F.count(F.lit(1))).alias("all_grouped"))


# ---------------------------------------------------------------- feature table users

@register("scaled_features")
def scaled_features(spark, sf):
    """Every model feature of the test rows scaled by the train rows' mean and
    deviation; the features count as the feature queries return them, rounded."""
    tr, te = (round_doubles(t) for t in _feature_tables(spark, sf))
    cols = model_features()
    return round_doubles(M.standard_scale(tr, te, cols, "_scaled").select(
        "id", *[F.col(f"{c}_scaled").alias(c) for c in cols]), 5)


@register("shuffled_features")
def shuffled_features(spark, sf):
    """The train features written in a shuffled order, read back with each row's position."""
    tr, _ = _feature_tables(spark, sf)
    path = IO.write_parquet(SP.shuffle_rows(tr), shared_dir(spark, "shuffled-features"))
    return round_doubles(spark.read.parquet(path).drop("shuffled_pos", "product_group"))


@register("evaluator_score")
def evaluator_score(spark, sf):
    """The chain's error by the Spark ML evaluator (a number for tuning, as one row)."""
    e = ME.RmsleEvaluator("lm_prev_client_depot_product", "demand").evaluate(_chain_scored(spark, sf))
    return round_doubles(spark.createDataFrame([(e,)], "rmsle double"))

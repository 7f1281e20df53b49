"""Oracle SQL text per registered query key (DuckDB dialect)."""

from __future__ import annotations

from demandspark.plans.oracle import (DEMAND, DEMAND_NOID, DENSE, LOCATIONS_ALL, PRODUCTS_ALL,
                                      STATS, TEST, TRAIN, UNIQUE, chain_join, dims_join,
                                      feature_select, lm, r6, unique_join, with_)

ORACLE: dict[str, str] = {}

ORACLE["demand_scan"] = with_(DEMAND) + "SELECT * FROM demand"
ORACLE["test_scan"] = with_(DEMAND, TEST) + "SELECT * FROM test"
ORACLE["pruned_scan"] = with_(DEMAND_NOID) + "SELECT client_id, product_id, demand FROM demand"
ORACLE["head_rows"] = with_(DEMAND) + "SELECT * FROM demand ORDER BY row_id LIMIT 20"

ORACLE["log_mean_global"] = with_(DEMAND_NOID, TRAIN) + f"SELECT {r6(lm())} AS lm_global FROM train"


def _level(keys: list[str], name: str, shift: bool = False) -> str:
    k = ", ".join(keys)
    sel = ", ".join(("CAST(period + 1 AS INTEGER) AS period" if (shift and c == "period") else c)
                    for c in keys)
    return with_(DEMAND_NOID, TRAIN) + f"SELECT {sel}, {r6(lm())} AS {name} FROM train GROUP BY {k}"


ORACLE["log_mean_client"] = _level(["client_id"], "lm_client")
ORACLE["log_mean_client_product"] = _level(["client_id", "product_id"], "lm_client_product")
ORACLE["log_mean_agency_product"] = _level(["depot_id", "product_id"], "lm_depot_product")
ORACLE["log_mean_client_product_agency"] = _level(["client_id", "product_id", "depot_id"],
                                                  "lm_client_product_depot")
ORACLE["log_mean_agency"] = _level(["depot_id"], "lm_depot")
ORACLE["prev_period_agency"] = _level(["period", "depot_id"], "lm_prev_depot", True)
ORACLE["prev_period_agency_product"] = _level(["period", "depot_id", "product_id"],
                                              "lm_prev_depot_product", True)
ORACLE["prev_period_client_agency_product"] = _level(
    ["period", "client_id", "depot_id", "product_id"], "lm_prev_client_depot_product", True)

_LAG = with_(DENSE, TRAIN) + f"""SELECT t.row_id, {r6('p.lm')} AS lm_prev_depot_product
FROM train t LEFT JOIN (SELECT CAST(period + 1 AS INTEGER) AS period, depot_id, product_id,
                               {lm()} AS lm FROM train GROUP BY period, depot_id, product_id) p
  ON t.period = p.period AND t.depot_id = p.depot_id AND t.product_id = p.product_id"""
ORACLE["lag_join"] = _LAG
ORACLE["lag_window_equiv"] = _LAG

_U = {"unique_counts_agency": ("depot_id", [("channel_id", "n_channels_per_depot"),
                                             ("product_id", "n_products_per_depot"),
                                             ("client_id", "n_clients_per_depot")]),
      "unique_counts_client": ("client_id", [("channel_id", "n_channels_per_client"),
                                              ("product_id", "n_products_per_client"),
                                              ("depot_id", "n_depots_per_client")]),
      "unique_counts_product": ("product_id", [("client_id", "n_clients_per_product"),
                                                ("depot_id", "n_depots_per_product")])}
for _k, (_key, _cols) in _U.items():
    _sel = ", ".join(f"count(DISTINCT {c}) AS {n}" for c, n in _cols)
    ORACLE[_k] = with_(DEMAND_NOID, TRAIN) + f"SELECT {_key}, {_sel} FROM train WHERE {_key} IS NOT NULL GROUP BY 1"

ORACLE["unique_counts_filled"] = (
    with_(DEMAND, TRAIN, TEST, UNIQUE) + "SELECT id, period, depot_id, channel_id, route_id, "
    "client_id, product_id, n_channels_per_depot, n_products_per_depot, n_channels_per_client, "
    "n_products_per_client, n_clients_per_product, n_depots_per_product FROM ("
    + unique_join("test") + ")")

_CHAIN = ["lm_global", "lm_client", "lm_client_product", "lm_depot_product",
          "lm_client_product_depot", "lm_prev_depot_product", "lm_prev_client_depot_product"]
ORACLE["fallback_chain"] = (
    with_(DEMAND, TRAIN, TEST, STATS) + "SELECT id, "
    + ", ".join(f"{r6(c)} AS {c}" for c in _CHAIN) + " FROM (" + chain_join("test") + ")")

_FEAT_CTES = [DEMAND, TRAIN, TEST] + PRODUCTS_ALL + LOCATIONS_ALL + [STATS, UNIQUE]
ORACLE["build_features_train"] = (
    with_(*_FEAT_CTES, "tu AS (" + unique_join("train") + ")", "td AS (" + dims_join("tu") + ")")
    + f"SELECT {feature_select('row_id', True)} FROM (" + chain_join("td") + ")")
ORACLE["build_features_test"] = (
    with_(*_FEAT_CTES, "tu AS (" + unique_join("test") + ")", "td AS (" + dims_join("tu") + ")")
    + f"SELECT {feature_select('id', False)} FROM (" + chain_join("td") + ")")

ORACLE["products_prepared"] = with_(*PRODUCTS_ALL) + (
    "SELECT product_id, name, short_name, short_name_processed, short_name_code, brand, "
    f"brand_code, {r6('weight')} AS weight, {r6('pieces')} AS pieces, "
    f"{r6('avg_brand_weight')} AS avg_brand_weight FROM prepared")
ORACLE["location_encoded"] = with_(*LOCATIONS_ALL) + "SELECT * FROM loc_prepared"

# ---------------------------------------------------------------- scans and sinks
from demandspark.plans.oracle import CLIENT, STOPS_SQL, stems_sql  # noqa: E402

ORACLE["csv_roundtrip"] = ORACLE["demand_scan"]
ORACLE["parquet_cache"] = ORACLE["products_prepared"]
ORACLE["partitioned_roundtrip"] = with_(DEMAND) + """SELECT d.*,
  CAST(floor((row_id - 1) / ceil(n / 8.0)) AS INTEGER) AS chunk_id
FROM demand d CROSS JOIN (SELECT count(*) AS n FROM demand) c"""

# ---------------------------------------------------------------- dormant mean joins
DEMAND_RET = DEMAND.replace(
    "CAST(l_quantity AS INTEGER) AS demand\n",
    "CAST(l_quantity AS INTEGER) AS demand,\n"
    "         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS returns\n")
ORACLE["returns_style_mean"] = with_(DEMAND_RET, TRAIN, TEST) + f"""SELECT t.id,
  {r6('coalesce(c.lm, g.lm)')} AS lm_returns_client
FROM test t LEFT JOIN (SELECT client_id, {lm('returns')} AS lm FROM train GROUP BY 1) c
  ON t.client_id = c.client_id
CROSS JOIN (SELECT {lm('returns')} AS lm FROM train) g"""

ORACLE["client_period_product_mean"] = with_(DEMAND, TRAIN, TEST, STATS) + f"""SELECT r.id,
  {r6('coalesce(w.lm, r.lm_client_product)')} AS lm_client_period_product
FROM ({chain_join('test')}) r
LEFT JOIN (SELECT client_id, period, product_id, {lm()} AS lm FROM train GROUP BY 1, 2, 3) w
  ON r.client_id = w.client_id AND r.period = w.period AND r.product_id = w.product_id"""

ORACLE["agency_means_joined"] = with_(DEMAND, TRAIN, TEST, STATS) + f"""SELECT t.id,
  {r6('coalesce(d.lm, g.lm_global)')} AS lm_depot,
  {r6('coalesce(wd.lm, d.lm, g.lm_global)')} AS lm_prev_depot
FROM test t CROSS JOIN g
LEFT JOIN (SELECT depot_id, {lm()} AS lm FROM train GROUP BY 1) d ON t.depot_id = d.depot_id
LEFT JOIN (SELECT CAST(period + 1 AS INTEGER) AS period, depot_id, {lm()} AS lm
           FROM train GROUP BY period, depot_id) wd
  ON t.period = wd.period AND t.depot_id = wd.depot_id"""

# ---------------------------------------------------------------- products and text
_P = PRODUCTS_ALL
ORACLE["product_attributes"] = with_(*_P[:2]) + (
    f"SELECT product_id, name, short_name, brand, {r6('weight')} AS weight, "
    f"{r6('pieces')} AS pieces FROM attrs")
ORACLE["inner_join_unmatched"] = with_(DEMAND, TRAIN, *_P[:2]) + (
    "SELECT t.row_id, t.product_id, a.brand, t.demand "
    "FROM train t JOIN attrs a ON t.product_id = a.product_id WHERE a.brand IS NOT NULL")
ORACLE["label_encode"] =with_(*_P[:3]) + (
    "SELECT product_id, short_name, short_name_code, brand, brand_code FROM coded")
ORACLE["brand_mean_weight"] = with_(*_P[:3]) + (
    f"SELECT brand_code, {r6('avg(weight)')} AS avg_brand_weight FROM coded "
    "WHERE weight IS NOT NULL GROUP BY 1")
ORACLE["brand_mean_pieces"] = with_(*_P[:3]) + (
    f"SELECT brand_code, {r6('avg(pieces)')} AS avg_brand_pieces FROM coded "
    "WHERE pieces IS NOT NULL GROUP BY 1")
ORACLE["product_imputed"] = with_(*_P) + (
    f"SELECT product_id, {r6('weight')} AS weight, {r6('pieces')} AS pieces, "
    f"{r6('avg_brand_weight')} AS avg_brand_weight FROM prepared")
ORACLE["name_tokens"] = with_(*_P[:4]) + "SELECT product_id, short_name_processed FROM processed"
ORACLE["bag_of_words"] = with_(*_P[:4]) + r"""SELECT token, count(*) AS doc_freq FROM (
  SELECT product_id, unnest(list_distinct(regexp_extract_all(lower(short_name_processed), '(\w\w+)', 1))) AS token
  FROM processed) GROUP BY token HAVING count(*) >= 2"""
ORACLE["bag_of_words_counts"] = with_(*_P[:4], r"""held AS (SELECT product_id, token, count(*) AS n FROM (
  SELECT product_id, unnest(regexp_extract_all(lower(short_name_processed), '(\w\w+)', 1)) AS token
  FROM processed) GROUP BY product_id, token)""") + """SELECT product_id, word_id, token, n FROM held JOIN (
  SELECT token, row_number() OVER (ORDER BY token) - 1 AS word_id FROM held GROUP BY token HAVING count(*) >= 2)
  USING (token)"""
ORACLE["document_words"] = f"""WITH docs AS (SELECT doc_id, text FROM documents WHERE lang = 'es'),
toks AS (SELECT doc_id, list_distinct({stems_sql(f"""
           list_filter(regexp_extract_all(lower(text), '(\\w\\w+)', 1),
                       lambda w: NOT list_contains({STOPS_SQL}, w))""")}) AS ws FROM docs)
SELECT token, count(*) AS doc_freq FROM (SELECT doc_id, unnest(ws) AS token FROM toks)
GROUP BY token HAVING count(*) >= 2"""

# ---------------------------------------------------------------- profiling
_ps = []
for _c in ["demand", "channel_id"]:
    _ps.append(f"count({_c}) AS {_c}_count, CAST(sum({_c}) AS BIGINT) AS {_c}_sum, "
               f"min({_c}) AS {_c}_min, max({_c}) AS {_c}_max, "
               f"{r6(f'median({_c})')} AS {_c}_median, {r6(f'avg({_c})')} AS {_c}_mean")
ORACLE["product_period_stats"] = with_(DEMAND_NOID, TRAIN) + (
    "SELECT period, product_id, " + ", ".join(_ps) + " FROM train GROUP BY period, product_id")
ORACLE["median_join_back"] = with_(DEMAND, TRAIN) + f"""SELECT t.row_id, t.client_id, t.product_id,
  t.demand, {r6('m.med')} AS median_demand
FROM train t JOIN (SELECT client_id, product_id, median(demand) AS med FROM train GROUP BY 1, 2) m
  ON t.client_id = m.client_id AND t.product_id = m.product_id"""
ORACLE["median_vs_log_mean"] = with_(DEMAND_NOID, TRAIN) + (
    f"SELECT depot_id, {r6('median(demand)')} AS median, {r6(lm())} AS log_mean "
    "FROM train GROUP BY depot_id")
_DESC_COLS = ["period", "depot_id", "channel_id", "route_id", "client_id", "product_id", "demand"]


def _describe(cols: list[str], source: str, first: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {first}'{c}' AS column, count({c}) AS count, {r6(f'avg({c})')} AS mean,
  {r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min,
  {r6(f'quantile_cont({c}, 0.25)')} AS p25, {r6(f'quantile_cont({c}, 0.5)')} AS p50,
  {r6(f'quantile_cont({c}, 0.75)')} AS p75, {r6(f'max({c})')} AS max FROM {source}""" for c in cols)


ORACLE["describe_numeric"] = with_(DEMAND_NOID, TRAIN) + _describe(_DESC_COLS, "train")
ORACLE["describe_test"] = with_(DEMAND, TEST) + _describe(["id"] + _DESC_COLS[:-1], "test")
ORACLE["describe_unique_counts"] = with_(DEMAND_NOID, TRAIN, *[
    f"u_{_key} AS (SELECT {_key}, " + ", ".join(f"count(DISTINCT {c}) AS {n}" for c, n in _cols)
    + f" FROM train WHERE {_key} IS NOT NULL GROUP BY 1)" for _key, _cols in _U.values()]) + " UNION ALL ".join(
    _describe([n for _, n in _cols], f"u_{_key}", f"'{_key}' AS key, ") for _key, _cols in _U.values())
ORACLE["table_shape"] = with_(DEMAND, TRAIN, TEST) + """
SELECT 'train' AS "table", count(*) AS n_rows, CAST(8 AS BIGINT) AS n_cols,
  'row_id,period,depot_id,channel_id,route_id,client_id,product_id,demand' AS columns FROM train
UNION ALL
SELECT 'test', count(*), CAST(7 AS BIGINT), 'id,period,depot_id,channel_id,route_id,client_id,product_id'
FROM test"""
ORACLE["null_counts"] = with_(*_P[:2]) + """SELECT * FROM (
  SELECT 'product_id' AS column, count(*) - count(product_id) AS nulls FROM attrs UNION ALL
  SELECT 'name', count(*) - count(name) FROM attrs UNION ALL
  SELECT 'short_name', count(*) - count(short_name) FROM attrs UNION ALL
  SELECT 'brand', count(*) - count(brand) FROM attrs UNION ALL
  SELECT 'weight', count(*) - count(weight) FROM attrs UNION ALL
  SELECT 'pieces', count(*) - count(pieces) FROM attrs)"""
ORACLE["top_values"] = with_(DEMAND_NOID, TRAIN) + (
    "SELECT demand, count(*) AS count FROM train GROUP BY demand "
    "ORDER BY count DESC, demand ASC LIMIT 10")
ORACLE["distinct_values"] = with_(DEMAND_NOID, TRAIN) + "SELECT " + ", ".join(
    f"count(DISTINCT {c}) AS n_{c}" for c in
    ["period", "depot_id", "channel_id", "route_id", "client_id", "product_id"]) + " FROM train"
ORACLE["natural_self_join"] = with_(CLIENT) + """SELECT
  (SELECT count(*) FROM client) AS rows_before,
  (SELECT count(*) FROM client a JOIN client b ON a.client_id IS NOT DISTINCT FROM b.client_id
     AND a.name IS NOT DISTINCT FROM b.name) AS rows_after"""
ORACLE["unseen_products"] = with_(DEMAND_NOID) + """SELECT DISTINCT product_id FROM demand
WHERE period >= 72 AND product_id NOT IN (SELECT product_id FROM demand WHERE period < 72)"""
ORACLE["distinct_products"] = with_(DEMAND_NOID) + """SELECT
  (SELECT count(DISTINCT product_id) FROM demand WHERE period >= 72) AS n_test_product_id,
  (SELECT count(*) FROM (SELECT DISTINCT product_id FROM demand WHERE period >= 72
     AND product_id NOT IN (SELECT product_id FROM demand WHERE period < 72))) AS n_unseen_product_id"""

# ---------------------------------------------------------------- metrics
_SCORED = with_(DEMAND, TRAIN, TEST, STATS) + "SELECT {e} AS rmsle, count(*) AS n FROM (" + \
    chain_join("test") + ") r JOIN demand d ON r.id = d.row_id"
ORACLE["rmsle_strict"] = _SCORED.format(
    e=r6("sqrt(avg(pow(ln(r.lm_prev_client_depot_product + 1) - ln(d.demand + 1), 2)))"))
ORACLE["rmsle_clamped"] = _SCORED.format(
    e=r6("sqrt(avg(pow(ln(greatest(coalesce(r.lm_prev_client_depot_product, 0), 0) + 1) - ln(d.demand + 1), 2)))"))
ORACLE["constant_baselines"] = with_(DEMAND_NOID, TRAIN) + f"""SELECT {r6('c.lmv')} AS log_mean,
  {r6('c.mv')} AS mean, {r6('c.med')} AS median,
  {r6('sqrt(avg(pow(ln(c.lmv + 1) - ln(t.demand + 1), 2)))')} AS rmsle_log_mean,
  {r6('sqrt(avg(pow(ln(c.mv + 1) - ln(t.demand + 1), 2)))')} AS rmsle_mean,
  {r6('sqrt(avg(pow(ln(c.med + 1) - ln(t.demand + 1), 2)))')} AS rmsle_median
FROM train t CROSS JOIN (SELECT {lm()} AS lmv, avg(demand) AS mv, median(demand) AS med FROM train) c
GROUP BY c.lmv, c.mv, c.med"""
ORACLE["cap_label"] = with_(DEMAND, TRAIN) + \
    "SELECT row_id, demand, least(demand, 10) AS demand_capped FROM train"
ORACLE["floor_prediction"] = with_(DEMAND, TRAIN) + \
    "SELECT row_id, greatest(demand - 25, 0) AS floored FROM train"
ORACLE["binarise_label"] = with_(DEMAND, TRAIN) + \
    "SELECT row_id, CASE WHEN demand / 50.0 >= 0.5 THEN 1 ELSE 0 END AS label FROM train"

# ---------------------------------------------------------------- splits
ORACLE["kfold_exact"] = with_(DEMAND, TRAIN) + \
    "SELECT row_id, CAST(ntile(10) OVER (ORDER BY row_id) AS INTEGER) AS fold FROM train"
ORACLE["kfold_hash"] = with_(DEMAND, TRAIN) + """SELECT CAST(fold AS INTEGER) AS fold,
  true AS unique_ids, true AS balanced FROM (SELECT unnest(range(1, 6)) AS fold)
WHERE (SELECT count(*) = count(DISTINCT row_id) FROM train)"""
ORACLE["chunk_ids"] = with_(DEMAND, TRAIN) + """SELECT row_id,
  CAST(floor((row_number() OVER (ORDER BY row_id) - 1) / ceil(count(*) OVER () / 8.0)) AS INTEGER) AS chunk_id
FROM train"""
ORACLE["split_union"] = with_(DEMAND, TRAIN) + \
    "SELECT *, CAST(ntile(8) OVER (ORDER BY row_id) AS INTEGER) AS part FROM train"
ORACLE["holdout_split"] = with_(DEMAND, TRAIN) + \
    "SELECT count(DISTINCT row_id) AS n_ids, CAST(0 AS BIGINT) AS n_on_both, true AS fifth_held_out FROM train"
ORACLE["shuffle_rows"] = with_(DEMAND, TRAIN) + """SELECT count(*) AS n_rows,
  count(*) AS n_positions, CAST(1 AS BIGINT) AS min_pos, count(*) AS max_pos,
  CAST(sum(row_id) AS BIGINT) AS sum_ids, true AS order_is_new FROM train"""
ORACLE["exact_sample"] = with_(DEMAND, TRAIN) + \
    "SELECT count(*) // 2 AS n_rows, count(*) // 2 AS n_ids, true AS spread FROM train"

# ---------------------------------------------------------------- scaling and models
_SC = ["period", "channel_id", "route_id"]
ORACLE["standard_scale"] = with_(DEMAND, TRAIN, TEST) + "SELECT t.id, " + ", ".join(
    f"{r6(f'(t.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 THEN 1.0 ELSE s.s_{c} END')} AS {c}_scaled"
    for c in _SC) + " FROM test t CROSS JOIN (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SC) + " FROM train) s"
ORACLE["impute_mean"] = with_(*_P[:2]) + f"""SELECT product_id,
  {r6('coalesce(weight, (SELECT avg(weight) FROM attrs))')} AS weight,
  {r6('coalesce(pieces, (SELECT avg(pieces) FROM attrs))')} AS pieces FROM attrs"""
ORACLE["ols_one_feature"] = with_(DEMAND_NOID, TRAIN) + (
    f"SELECT {r6('regr_slope(demand, period)')} AS slope, "
    f"{r6('regr_intercept(demand, period)')} AS intercept FROM train")
ORACLE["importance_share"] = with_(DEMAND_NOID, TRAIN) + """SELECT feature, fscore,
  CAST(row_number() OVER (ORDER BY fscore, feature) AS INTEGER) AS rank FROM (
  SELECT channel_id AS feature, count(*) / sum(count(*)) OVER () AS fscore FROM train GROUP BY 1)"""

# ---------------------------------------------------------------- stacking
FOLDS = "tf AS (SELECT *, CAST(ntile(5) OVER (ORDER BY row_id) AS INTEGER) AS fold FROM train)"


def _oof_ctes(key: str, p: str) -> str:
    return f"""{p}per AS (SELECT {key}, fold, sum(ln(demand + 1)) AS sf, count(*) AS cf FROM tf GROUP BY 1, 2),
{p}tot AS (SELECT {key}, sum(sf) AS s, sum(cf) AS c FROM {p}per GROUP BY 1),
{p}km AS (SELECT t.{key}, f.fold,
  CASE WHEN t.c - coalesce(p.cf, 0) > 0
       THEN exp((t.s - coalesce(p.sf, 0)) / (t.c - coalesce(p.cf, 0))) - 1 END AS oof
  FROM {p}tot t CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold) f
  LEFT JOIN {p}per p ON p.{key} = t.{key} AND p.fold = f.fold)"""


GLOBAL_OOF = """gper AS (SELECT fold, sum(ln(demand + 1)) AS sf, count(*) AS cf FROM tf GROUP BY 1),
gm AS (SELECT fold, exp((sum(sf) OVER () - sf) / (sum(cf) OVER () - cf)) - 1 AS oof_global FROM gper)"""


def _oof_pred(key: str, p: str, model: str) -> str:
    return f"""SELECT tf.row_id, '{model}' AS model, coalesce({p}km.oof, gm.oof_global) AS prediction
FROM tf LEFT JOIN {p}km ON tf.{key} = {p}km.{key} AND tf.fold = {p}km.fold JOIN gm ON tf.fold = gm.fold"""


ORACLE["oof_group_mean"] = with_(DEMAND, TRAIN, FOLDS, _oof_ctes("client_id", "c_"), GLOBAL_OOF) + \
    f"SELECT row_id, model, {r6('prediction')} AS prediction FROM (" + \
    _oof_pred("client_id", "c_", "client") + ")"
ORACLE["test_fold_mean"] = with_(DEMAND, TRAIN, TEST, FOLDS, _oof_ctes("client_id", "c_"),
                                 GLOBAL_OOF) + f"""SELECT t.id, 'client' AS model,
  {r6('coalesce(pk.p, un.g)')} AS prediction
FROM test t LEFT JOIN (SELECT k.client_id, avg(coalesce(k.oof, gm.oof_global)) AS p
                       FROM c_km k JOIN gm ON k.fold = gm.fold GROUP BY 1) pk
  ON t.client_id = pk.client_id
CROSS JOIN (SELECT avg(oof_global) AS g FROM gm) un"""
ORACLE["blend_pivot"] = with_(
    DEMAND, TRAIN, FOLDS, _oof_ctes("client_id", "c_"), _oof_ctes("product_id", "p_"),
    _oof_ctes("depot_id", "d_"), GLOBAL_OOF,
    "c AS (" + _oof_pred("client_id", "c_", "client") + ")",
    "p AS (" + _oof_pred("product_id", "p_", "product") + ")",
    "d AS (" + _oof_pred("depot_id", "d_", "depot") + ")") + f"""SELECT c.row_id,
  {r6('c.prediction')} AS client, {r6('p.prediction')} AS product, {r6('d.prediction')} AS depot
FROM c JOIN p ON c.row_id = p.row_id JOIN d ON c.row_id = d.row_id"""

ORACLE["feature_job"] = f"SELECT *, true AS has_group FROM ({ORACLE['build_features_test']})"
ORACLE["submission_sink"] = with_(DEMAND, TRAIN, TEST, STATS) + \
    f"SELECT id, {r6('greatest(lm_prev_client_depot_product, 0)')} AS demand FROM (" + \
    chain_join("test") + ")"

# ---------------------------------------------------------------- facts of fitted results
_FACT = "count(*) AS n_rows, count(DISTINCT {k}) AS n_ids, CAST(sum({k}) AS BIGINT) AS sum_ids, " \
    "CAST(0 AS BIGINT) AS n_wrong, true AS varied"
for _k in ["ols_predict", "gbt_predict", "gbt_early_stop", "gbt_with_words", "linear_booster_predict",
           "forest_predict", "binary_classify", "stack_submission"]:
    ORACLE[f"{_k}_facts"] = with_(DEMAND, TEST) + f"SELECT {_FACT.format(k='id')} FROM test"
for _k in ["product_group_gmm", "product_group_kmeans"]:
    ORACLE[f"{_k}_facts"] = with_(_P[0]) + f"SELECT {_FACT.format(k='product_id')} FROM product"
_MODELS = "(SELECT unnest(['gbt_a', 'linear_booster', 'gbt_b', 'ols']) AS model) m"
ORACLE["stack_oof_facts"] = with_(DEMAND, TRAIN) + \
    f"SELECT model, {_FACT.format(k='row_id')} FROM train CROSS JOIN {_MODELS} GROUP BY model"
ORACLE["stack_test_mean_facts"] = with_(DEMAND, TEST) + \
    f"SELECT model, {_FACT.format(k='id')} FROM test CROSS JOIN {_MODELS} GROUP BY model"
ORACLE["feature_importance_facts"] = "SELECT true AS shares_sum_to_1, true AS gains_sum_to_1, " \
    'true AS "distinct", CAST(0 AS BIGINT) AS n_unknown'
for _k, _n in [("cv_evaluate", "count(*)"), ("cv_evaluate_linear", "least(count(*), 2000000)")]:
    ORACLE[f"{_k}_facts"] = with_(DEMAND) + f"""SELECT CAST(1 AS INTEGER) AS fold,
  n - CAST(ceil(n / 5.0) AS BIGINT) AS n_train, CAST(ceil(n / 5.0) AS BIGINT) AS n_valid,
  true AS rmsle_in_range FROM (SELECT {_n} AS n FROM demand)"""
ORACLE["planted_signal_facts"] = with_(DEMAND, TEST) + """SELECT model, count(*) AS n_rows, true AS beats_constant
FROM test CROSS JOIN (SELECT unnest(['gbt', 'forest', 'linear_booster', 'ols']) AS model) m GROUP BY model"""
ORACLE["ols_two_features"] = with_(DEMAND, TRAIN) + f"""SELECT {r6('a')} AS slope_period, {r6('b')} AS slope_channel,
  {r6('my - a * mx - b * mz')} AS intercept FROM (
  SELECT (sxy * szz - szy * sxz) / (sxx * szz - sxz * sxz) AS a, (szy * sxx - sxy * sxz) / (sxx * szz - sxz * sxz) AS b,
         mx, mz, my FROM (
    SELECT var_pop(period) AS sxx, var_pop(channel_id) AS szz, covar_pop(period, channel_id) AS sxz,
           covar_pop(demand, period) AS sxy, covar_pop(demand, channel_id) AS szy,
           avg(period) AS mx, avg(channel_id) AS mz, avg(demand) AS my FROM train))"""
ORACLE["file_inventory_facts"] = "SELECT true AS all_listed, CAST(0 AS BIGINT) AS n_unsized"
ORACLE["feature_product_groups"] = with_(DEMAND, TRAIN) + """SELECT product_id, count(*) AS n_rows,
  CAST(1 AS BIGINT) AS n_groups, true AS all_grouped FROM train GROUP BY product_id"""

# ---------------------------------------------------------------- feature table users
from demandspark.sources.schemas import model_features  # noqa: E402

_FC = model_features()
_TRAIN_F, _TEST_F = (ORACLE[f"build_features_{s}"] for s in ("train", "test"))
ORACLE["scaled_features"] = (
    f"WITH ftr AS ({_TRAIN_F}), fte AS ({_TEST_F}), st AS (SELECT " + ", ".join(
        f"CASE WHEN min({c}) = max({c}) THEN CAST(min({c}) AS DOUBLE) ELSE avg({c}) END AS m_{c}, "
        f"CASE WHEN min({c}) = max({c}) THEN 1.0::DOUBLE ELSE stddev_pop({c}) END AS s_{c}" for c in _FC)
    + " FROM ftr) SELECT id, " + ", ".join(
        f"round(CAST((t.{c} - st.m_{c}) / st.s_{c} AS DOUBLE), 5) AS {c}" for c in _FC)
    + " FROM fte t CROSS JOIN st")
ORACLE["shuffled_features"] = _TRAIN_F
ORACLE["evaluator_score"] = f"SELECT rmsle FROM ({ORACLE['rmsle_clamped']})"

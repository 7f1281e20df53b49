"""DuckDB SQL for each registered query (the independent oracle).

The CTEs below restate the fixture recipe of ``sources.fixtures`` in SQL.
Integers are cast explicitly and doubles rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from demandspark.functions.text import spanish_stop_words, stem_steps
from demandspark.sources.fixtures import PRODUCT_NAME_SQL

DEMAND = """demand AS (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           l_shipdate) AS BIGINT) AS row_id,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS period,
         l_suppkey AS depot_id, l_linenumber AS channel_id, l_orderkey % 97 AS route_id,
         o_custkey AS client_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS demand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DEMAND_NOID = """demand AS (
  SELECT CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS period,
         l_suppkey AS depot_id, l_linenumber AS channel_id, l_orderkey % 97 AS route_id,
         o_custkey AS client_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS demand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DENSE = """demand AS (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           l_shipdate) AS BIGINT) AS row_id,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS period,
         s_nationkey AS depot_id, l_linenumber AS channel_id, l_orderkey % 97 AS route_id,
         o_custkey AS client_id, p_brand AS product_id, CAST(l_quantity AS INTEGER) AS demand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

TRAIN = "train AS (SELECT * FROM demand WHERE period < 72)"
TEST = """test AS (SELECT row_id AS id, period, depot_id, channel_id, route_id, client_id,
  product_id FROM demand WHERE period >= 72)"""
TEST_LABELS = "test_labels AS (SELECT row_id AS id, demand FROM demand WHERE period >= 72)"

PRODUCT = f"""product AS (
  SELECT p_partkey AS product_id, {PRODUCT_NAME_SQL} AS name
  FROM part)"""

LOCATION = """location AS (
  SELECT s_suppkey AS depot_id, n_name AS town, r_name AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CLIENT = """client AS (
  SELECT c_custkey AS client_id, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_name END AS name
  FROM customer
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_name END
  FROM customer WHERE c_custkey % 10 = 0)"""


def lm(v: str = "demand") -> str:
    return f"exp(avg(ln({v} + 1))) - 1"


def r6(e: str) -> str:
    return f"round(CAST({e} AS DOUBLE), 6)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Product preparation in SQL: attributes, codes, brand mean, mean fill.
STOPS_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in spanish_stop_words()) + "]"


def stems_sql(words: str) -> str:
    """The stems of a list of words: the same rules, one list pass per step."""
    out = words
    for fields in stem_steps():
        packed = ", ".join(f"{k} := {v}" for k, v in fields.items())
        out = f"list_transform({out}, lambda x: struct_pack({packed}))"
    return f"list_transform({out}, lambda x: x.w)"


# The name patterns and unit factors of ``functions.expressions``.
PRODUCT_ATTRS = r"""attrs AS (
  SELECT product_id, name,
         regexp_extract(name, '^(\D*)', 1) AS short_name,
         nullif(regexp_extract(name, '^.+\s(\D+) \d+$', 1), '') AS brand,
         CAST(nullif(regexp_extract(name, '(\d+)(Kg|g)', 1), '') AS DOUBLE)
           * CASE regexp_extract(name, '(\d+)(Kg|g)', 2) WHEN 'Kg' THEN 1000 WHEN 'g' THEN 1 END AS weight,
         CAST(nullif(regexp_extract(name, '(\d+)p ', 1), '') AS DOUBLE) AS pieces
  FROM product)"""

PRODUCT_CODES = """sn_codes AS (
  SELECT short_name, CAST(row_number() OVER (ORDER BY short_name NULLS LAST) - 1 AS INTEGER) AS short_name_code
  FROM (SELECT DISTINCT short_name FROM attrs)),
brand_codes AS (
  SELECT brand, CAST(row_number() OVER (ORDER BY brand NULLS LAST) - 1 AS INTEGER) AS brand_code
  FROM (SELECT DISTINCT brand FROM attrs)),
coded AS (
  SELECT a.*, s.short_name_code, b.brand_code
  FROM attrs a JOIN sn_codes s ON a.short_name IS NOT DISTINCT FROM s.short_name
               JOIN brand_codes b ON a.brand IS NOT DISTINCT FROM b.brand)"""

PROCESSED = f"""processed AS (
  SELECT *, array_to_string({stems_sql(f"""
            list_filter(list_filter(string_split_regex(trim(lower(short_name)), '\\s+'), lambda w: length(w) > 0),
                        lambda w: NOT list_contains({STOPS_SQL}, w))""")}, ' ') AS short_name_processed
  FROM coded)"""

PREPARED = """brand_weight AS (
  SELECT brand_code, avg(weight) AS avg_brand_weight FROM processed
  WHERE weight IS NOT NULL GROUP BY brand_code),
filled AS (
  SELECT p.*, bw.avg_brand_weight, coalesce(p.pieces, 1.0) AS pieces_filled
  FROM processed p LEFT JOIN brand_weight bw USING (brand_code)),
prepared AS (
  SELECT product_id, name, short_name, short_name_processed, short_name_code, brand, brand_code,
         coalesce(weight, (SELECT avg(weight) FROM filled)) AS weight,
         pieces_filled AS pieces,
         coalesce(avg_brand_weight, (SELECT avg(avg_brand_weight) FROM filled)) AS avg_brand_weight
  FROM filled)"""

PRODUCTS_ALL = [PRODUCT, PRODUCT_ATTRS, PRODUCT_CODES, PROCESSED, PREPARED]

LOCATION_PREPARED = """loc_ts AS (SELECT *, town || state AS town_state FROM location),
ts_codes AS (SELECT town_state, CAST(row_number() OVER (ORDER BY town_state NULLS LAST) - 1 AS INTEGER) AS town_state_code
  FROM (SELECT DISTINCT town_state FROM loc_ts)),
st_codes AS (SELECT state, CAST(row_number() OVER (ORDER BY state NULLS LAST) - 1 AS INTEGER) AS state_code
  FROM (SELECT DISTINCT state FROM loc_ts)),
loc_prepared AS (
  SELECT l.depot_id, l.town, l.state, t.town_state_code, s.state_code
  FROM loc_ts l JOIN ts_codes t ON l.town_state IS NOT DISTINCT FROM t.town_state
                JOIN st_codes s ON l.state IS NOT DISTINCT FROM s.state)"""

LOCATIONS_ALL = [LOCATION, LOCATION_PREPARED]

# Statistics on train (CTE per key) and unique counts with median fills.
STATS = f"""g AS (SELECT {lm()} AS lm_global FROM train),
s_c AS (SELECT client_id, {lm()} AS lm_client FROM train GROUP BY 1),
s_cp AS (SELECT client_id, product_id, {lm()} AS lm_client_product FROM train GROUP BY 1, 2),
s_dp AS (SELECT depot_id, product_id, {lm()} AS lm_depot_product FROM train GROUP BY 1, 2),
s_cpd AS (SELECT client_id, product_id, depot_id, {lm()} AS lm_client_product_depot FROM train GROUP BY 1, 2, 3),
s_wdp AS (SELECT CAST(period + 1 AS INTEGER) AS period, depot_id, product_id, {lm()} AS lm_prev_depot_product
          FROM train GROUP BY period, depot_id, product_id),
s_wcdp AS (SELECT CAST(period + 1 AS INTEGER) AS period, client_id, depot_id, product_id,
          {lm()} AS lm_prev_client_depot_product FROM train GROUP BY period, client_id, depot_id, product_id)"""

UNIQUE = """u_d AS (SELECT depot_id, count(DISTINCT channel_id) AS n_channels_per_depot,
             count(DISTINCT product_id) AS n_products_per_depot FROM train GROUP BY 1),
u_c AS (SELECT client_id, count(DISTINCT channel_id) AS n_channels_per_client,
             count(DISTINCT product_id) AS n_products_per_client FROM train GROUP BY 1),
u_p AS (SELECT product_id, count(DISTINCT client_id) AS n_clients_per_product,
             count(DISTINCT depot_id) AS n_depots_per_product FROM train GROUP BY 1),
u_med AS (SELECT * FROM
  (SELECT median(n_channels_per_depot) AS m_cd, median(n_products_per_depot) AS m_pd FROM u_d),
  (SELECT median(n_channels_per_client) AS m_cc, median(n_products_per_client) AS m_pc FROM u_c),
  (SELECT median(n_clients_per_product) AS m_cp, median(n_depots_per_product) AS m_dp FROM u_p))"""


def unique_join(rows: str) -> str:
    return f"""SELECT r.*,
  CAST(coalesce(u_d.n_channels_per_depot, m.m_cd) AS DOUBLE) AS n_channels_per_depot,
  CAST(coalesce(u_d.n_products_per_depot, m.m_pd) AS DOUBLE) AS n_products_per_depot,
  CAST(coalesce(u_c.n_channels_per_client, m.m_cc) AS DOUBLE) AS n_channels_per_client,
  CAST(coalesce(u_c.n_products_per_client, m.m_pc) AS DOUBLE) AS n_products_per_client,
  CAST(coalesce(u_p.n_clients_per_product, m.m_cp) AS DOUBLE) AS n_clients_per_product,
  CAST(coalesce(u_p.n_depots_per_product, m.m_dp) AS DOUBLE) AS n_depots_per_product
FROM {rows} r CROSS JOIN u_med m
  LEFT JOIN u_d ON r.depot_id = u_d.depot_id
  LEFT JOIN u_c ON r.client_id = u_c.client_id
  LEFT JOIN u_p ON r.product_id = u_p.product_id"""


def chain_join(rows: str) -> str:
    """Rows joined to every statistic with the fallback chain resolved (raw doubles)."""
    return f"""SELECT r.*, g.lm_global,
  coalesce(s_c.lm_client, g.lm_global) AS lm_client,
  coalesce(s_cp.lm_client_product, s_c.lm_client, g.lm_global) AS lm_client_product,
  coalesce(s_dp.lm_depot_product, g.lm_global) AS lm_depot_product,
  coalesce(s_cpd.lm_client_product_depot, s_cp.lm_client_product, s_c.lm_client, g.lm_global) AS lm_client_product_depot,
  coalesce(s_wdp.lm_prev_depot_product, s_dp.lm_depot_product, g.lm_global) AS lm_prev_depot_product,
  coalesce(s_wcdp.lm_prev_client_depot_product, s_wdp.lm_prev_depot_product, s_dp.lm_depot_product,
           g.lm_global) AS lm_prev_client_depot_product
FROM {rows} r CROSS JOIN g
  LEFT JOIN s_c ON r.client_id = s_c.client_id
  LEFT JOIN s_cp ON r.client_id = s_cp.client_id AND r.product_id = s_cp.product_id
  LEFT JOIN s_dp ON r.depot_id = s_dp.depot_id AND r.product_id = s_dp.product_id
  LEFT JOIN s_cpd ON r.client_id = s_cpd.client_id AND r.product_id = s_cpd.product_id
                 AND r.depot_id = s_cpd.depot_id
  LEFT JOIN s_wdp ON r.period = s_wdp.period AND r.depot_id = s_wdp.depot_id
                 AND r.product_id = s_wdp.product_id
  LEFT JOIN s_wcdp ON r.period = s_wcdp.period AND r.client_id = s_wcdp.client_id
                 AND r.depot_id = s_wcdp.depot_id AND r.product_id = s_wcdp.product_id"""


def dims_join(rows: str) -> str:
    return f"""SELECT r.*, p.weight, p.brand_code, p.pieces, p.short_name_code,
  l.town_state_code, l.state_code
FROM {rows} r JOIN prepared p ON r.product_id = p.product_id
              JOIN loc_prepared l ON r.depot_id = l.depot_id"""


FEATURE_DOUBLES = ["lm_client", "lm_client_product", "lm_client_product_depot", "lm_depot_product",
                   "lm_global", "lm_prev_client_depot_product", "lm_prev_depot_product", "weight",
                   "pieces", "n_channels_per_client", "n_channels_per_depot",
                   "n_clients_per_product", "n_depots_per_product", "n_products_per_client",
                   "n_products_per_depot"]
FEATURE_INTS = ["brand_code", "channel_id", "client_id", "depot_id", "period", "product_id",
                "route_id", "short_name_code", "state_code", "town_state_code"]


def feature_select(idcol: str, label: bool) -> str:
    cols = [idcol] + sorted(FEATURE_INTS) + [f"{r6(c)} AS {c}" for c in sorted(FEATURE_DOUBLES)]
    if label:
        cols.append("demand")
    return ", ".join(cols)

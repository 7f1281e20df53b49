"""Adapters from the TPC-H-like test tables to demand / test / product /
location / client frames (shapes of FIXTURES.md).

Each adapter reads only the columns it needs, so the parquet scans carry a
pruned ``ReadSchema``; filters on the result are pushed into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.session import materialize
from demandspark.sources.ids import with_consecutive_id

# Fixed values of the fixture recipe (must equal the oracle SQL).
FIRST_YEAR = 1995
SPLIT_PERIOD = 72          # train: period < 72, test: period >= 72
ROUTE_MODULUS = 97
LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]

# Generated product name: digits for the name parsers to find (same text runs
# in Spark SQL and DuckDB).
PRODUCT_NAME_SQL = (
    "p_name"
    " || case when p_partkey % 7 = 0 then '' else ' ' || p_size || 'p' end"
    " || case when p_partkey % 11 = 0 then ''"
    "         when p_partkey % 5 = 0 then ' ' || (1 + p_size % 3) || 'Kg'"
    "         else ' ' || (p_size * 10) || 'g' end"
    " || case when p_partkey % 17 = 0 then '' else ' ' || p_type end"
    " || ' ' || p_partkey"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _period(ts: str = "l_shipdate"):
    return ((F.year(ts) - FIRST_YEAR) * 12 + F.month(ts) - 1).cast("int")


_MEMO: dict = {}


def demand(spark: SparkSession, sf_dir: str, with_row_id: bool = True,
           dense: bool = False, with_returns: bool = False) -> DataFrame:
    """Memoised per session when row ids are requested (the numbered table is
    written once to the checkpoint folder and reused)."""
    if not with_row_id:
        return _demand(spark, sf_dir, False, dense, with_returns)
    if dense and not with_returns:
        # same rows and ids as the numbered table: swap the keys by joining the
        # supplier and part dimensions (no second numbering)
        base = demand(spark, sf_dir, with_row_id=True)
        sup = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("depot_id"), F.col("s_nationkey").alias("_nation"))
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("_brand"))
        return (base.join(sup, "depot_id").join(part, "product_id")
                .select("row_id", "period", F.col("_nation").alias("depot_id"), "channel_id",
                        "route_id", "client_id", F.col("_brand").alias("product_id"), "demand"))
    key = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", ""), sf_dir,
           dense, with_returns)
    if key not in _MEMO:
        _MEMO[key] = _demand(spark, sf_dir, True, dense, with_returns)
    return _MEMO[key]


def _demand(spark: SparkSession, sf_dir: str, with_row_id: bool,
            dense: bool, with_returns: bool) -> DataFrame:
    """Demand rows: (row_id, period, depot_id, channel_id, route_id, client_id,
    product_id, demand).

    ``dense`` swaps depot to the supplier nation and product to the part brand,
    so previous-period keys match often. ``with_returns`` adds a returned-units
    column (quantity of lines flagged 'R', else 0) for the returns-style mean.
    ``row_id`` numbers rows by all lineitem columns without a single-task window.
    """
    li_cols = LINEITEM_ORDER if with_row_id else [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_shipdate"] + (["l_returnflag"] if with_returns else [])
    li = table(spark, sf_dir, "lineitem").select(*li_cols)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(orders, li.l_orderkey == orders.o_orderkey)
    depot = F.col("l_suppkey")
    product = F.col("l_partkey")
    if dense:
        sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        rows = (rows.join(sup, rows.l_suppkey == sup.s_suppkey)
                .join(part, rows.l_partkey == part.p_partkey))
        depot = F.col("s_nationkey")
        product = F.col("p_brand")
    out = [
        _period().alias("period"),
        depot.alias("depot_id"),
        F.col("l_linenumber").alias("channel_id"),
        (F.col("l_orderkey") % ROUTE_MODULUS).alias("route_id"),
        F.col("o_custkey").alias("client_id"),
        product.alias("product_id"),
        F.col("l_quantity").cast("int").alias("demand"),
    ]
    if with_returns:
        out.append(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int"))
                   .otherwise(F.lit(0)).alias("returns"))
    if not with_row_id:
        return rows.select(*out)
    # the sort carries the table's own columns; the fixture columns are worked
    # out from them behind it and alone are written, as real parquet columns
    # (filters on period reach the scan)
    keys = ["o_custkey", *(["s_nationkey", "p_brand"] if dense else [])]
    numbered = with_consecutive_id(rows.select(*LINEITEM_ORDER, *keys), LINEITEM_ORDER, "row_id", keep=out)
    # the numbered fact table is written once: later scans are plain parquet
    # with pruning and pushed filters
    return materialize(numbered.select("row_id", *numbered.drop("row_id").columns), "demand")


def split_train_test(rows: DataFrame, split_period: int = SPLIT_PERIOD) -> tuple[DataFrame, DataFrame]:
    """Train rows (with the label) and test rows (id, keys, no label)."""
    train = rows.where(F.col("period") < split_period)
    test = (rows.where(F.col("period") >= split_period)
            .withColumnRenamed("row_id", "id").drop("demand", "returns"))
    return train, test


def train_test(spark: SparkSession, sf_dir: str, dense: bool = False,
               with_row_id: bool = True) -> tuple[DataFrame, DataFrame]:
    return split_train_test(demand(spark, sf_dir, with_row_id=with_row_id, dense=dense))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, name) of every part, with generated names."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.expr(PRODUCT_NAME_SQL).alias("name"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(depot_id, town, state) of every depot: supplier -> nation -> region."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("depot_id"), F.col("n_name").alias("town"),
                    F.col("r_name").alias("state")))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(client_id, name): every 10th client duplicated, every 20th name NULL."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client_id"),
        F.when(F.col("c_custkey") % 20 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_name")).alias("name"))
    return c.unionByName(c.where(F.col("client_id") % 10 == 0))


def spanish_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("lang") == "es").select("doc_id", "text")

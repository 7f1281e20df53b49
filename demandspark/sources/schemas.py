"""Explicit schemas and feature lists (no schema inference in jobs)."""

from pyspark.sql import types as T

# Weekly demand rows. The period is an integer week/month number, never a
# timestamp; it is an int (not a byte) because period+1 must not overflow.
DEMAND_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("depot_id", T.LongType()),
    T.StructField("channel_id", T.IntegerType()),
    T.StructField("route_id", T.LongType()),
    T.StructField("client_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("demand", T.IntegerType()),
])

TEST_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [f for f in DEMAND_SCHEMA.fields if f.name not in ("row_id", "demand")])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
])

LOCATION_SCHEMA = T.StructType([
    T.StructField("depot_id", T.LongType()),
    T.StructField("town", T.StringType()),
    T.StructField("state", T.StringType()),
])

SUBMISSION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("demand", T.DoubleType()),
])

TARGET = "demand"
KEY_COLUMNS = ["period", "depot_id", "channel_id", "route_id", "client_id", "product_id"]

MEAN_FEATURES = [
    "lm_global", "lm_client", "lm_client_product", "lm_client_product_depot",
    "lm_depot_product", "lm_prev_depot_product",
]
# computed and emitted, but left out of the model list by default
EXTRA_MEAN_FEATURES = ["lm_prev_client_depot_product"]

UNIQUE_FEATURES = [
    "n_channels_per_depot", "n_channels_per_client", "n_products_per_client",
    "n_products_per_depot", "n_clients_per_product", "n_depots_per_product",
]
PRODUCT_FEATURES = ["weight", "brand_code", "pieces", "short_name_code"]
CLUSTER_FEATURES = ["product_group"]
LOCATION_FEATURES = ["town_state_code", "state_code"]


def model_features(with_groups: bool = False) -> list[str]:
    """Fixed, sorted model input list (the source list had no defined order)."""
    cols = KEY_COLUMNS + MEAN_FEATURES + UNIQUE_FEATURES + PRODUCT_FEATURES + LOCATION_FEATURES
    if with_groups:
        cols = cols + CLUSTER_FEATURES
    return sorted(cols)

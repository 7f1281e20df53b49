"""Distinct-count features per depot / client / product, filled with the
median of the per-key counts.

Each key level is one aggregate with several ``count_distinct`` columns; Spark
plans it as an Expand + partial de-duplication, so rows are de-duplicated on
(key, value) map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.joins import left_attach, with_constants
from demandspark.operators.quantiles import grouped_quantiles

# key -> {feature name: counted column}. The *_extra entries are the pair the
# profiling job looked at but the feature job does not use.
UNIQUE_SPECS = {
    "depot_id": {"n_channels_per_depot": "channel_id", "n_products_per_depot": "product_id"},
    "client_id": {"n_channels_per_client": "channel_id", "n_products_per_client": "product_id"},
    "product_id": {"n_clients_per_product": "client_id", "n_depots_per_product": "depot_id"},
}
EXTRA_SPECS = {
    "depot_id": {"n_clients_per_depot": "client_id"},
    "client_id": {"n_depots_per_client": "depot_id"},
}


def unique_counts(train: DataFrame, key: str, with_extra: bool = False) -> DataFrame:
    """One row per non-null key with its distinct counts."""
    spec = dict(UNIQUE_SPECS[key])
    if with_extra:
        spec.update(EXTRA_SPECS.get(key, {}))
    return (train.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(*[F.count_distinct(c).alias(n) for n, c in spec.items()]))


def count_medians(tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row ``_med_<name>``: exact median of each count column over its keys.

    All count columns are stacked to (name, value) and share one histogram
    pipeline. A column's histogram has at most (max count) rows, so the
    per-name window is bounded by the value domain, not by the number of keys.
    """
    long = None
    names = []
    for counts, cols in tables:
        names += cols
        stack = "stack({}, {}) as (_name, _v)".format(
            len(cols), ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols))
        part = counts.selectExpr(stack)
        long = part if long is None else long.unionByName(part)
    med = grouped_quantiles(long, ["_name"], "_v", [0.5], ["_m"], small_domain=True)
    return (med.groupBy().pivot("_name", names).agg(F.first("_m"))
            .select(*[F.col(n).alias(f"_med_{n}") for n in names]))


def add_unique_features(rows: DataFrame, train: DataFrame) -> DataFrame:
    """Attach the six counts computed on ``train`` to ``rows``; unmatched keys
    get the median of that count over the training keys."""
    tables = [(unique_counts(train, key), list(spec)) for key, spec in UNIQUE_SPECS.items()]
    medians = count_medians(tables)
    out = rows
    for (counts, _), key in zip(tables, UNIQUE_SPECS):
        out = left_attach(out, counts, [key])
    out = with_constants(out, medians)
    names = [n for _, cols in tables for n in cols]
    out = out.withColumns({n: F.coalesce(F.col(n).cast("double"), F.col(f"_med_{n}"))
                           for n in names})
    return out.drop(*[f"_med_{n}" for n in names])

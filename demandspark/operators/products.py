"""Product and location preparation: name parsing, label codes, brand means,
mean imputation, bag of words and product grouping (Spark ML)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizer, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions import expressions as X
from demandspark.functions.text import TOKEN_PATTERN, processed_name
from demandspark.operators.joins import with_constants
from demandspark.session import materialize
from demandspark.operators.words import COMPONENTS as GMM_COMPONENTS, ROUNDS, document_frequency, fit_mixture, word_counts
from demandspark.sources.ids import dense_codes_many

DEFAULT_SEED = 47
KMEANS_CLUSTERS = 30
KMEANS_ITERATIONS = 100


def encode(df: DataFrame, col: str, code: str) -> DataFrame:
    """Label code of ``col``: sorted distinct values -> 0..n-1, NULL -> n."""
    return encode_many(df, {col: code})


def encode_many(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Label codes for several string columns from one numbering job.

    Each dictionary has one row per distinct value; it is joined on the
    value (NULL matching NULL) and AQE broadcasts it at runtime when its
    shuffle output is small.
    """
    out = df
    for c, d in dense_codes_many(df, cols).items():
        out = out.join(d, out[c].eqNullSafe(d["_val"]), "left").drop("_val")
    return out


def product_attributes(products: DataFrame) -> DataFrame:
    """(product_id, name) -> + short_name, brand, weight (grams), pieces."""
    return products.select(
        "product_id", "name",
        X.short_name("name").alias("short_name"),
        X.brand("name").alias("brand"),
        X.weight_grams("name").alias("weight"),
        X.pieces("name").alias("pieces"))


def brand_mean(attrs: DataFrame, value: str, name: str) -> DataFrame:
    """Mean of ``value`` per brand code over rows where it is known."""
    return (attrs.where(F.col(value).isNotNull())
            .groupBy("brand_code").agg(F.avg(value).alias(name)))


def named_products(products: DataFrame) -> DataFrame:
    """Product attributes with the processed short name, parsed once and written: codes, means, words and
    groups all read them. Names are few bytes and much work, so they are dealt over the cores first: a scan
    cuts its tasks by bytes and would parse them all in one."""
    spread = products.repartition(2 * products.sparkSession.sparkContext.defaultParallelism, "product_id")
    return materialize(product_attributes(spread).withColumn("short_name_processed", processed_name("short_name")),
                       "product-names")


def with_codes(products: DataFrame) -> DataFrame:
    return encode_many(named_products(products),
                       {"short_name": "short_name_code", "brand": "brand_code"})


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill NULLs of each column with that column's mean (one-row aggregate)."""
    means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    out = with_constants(df, means)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_mean_{c}")))
    return out.drop(*[f"_mean_{c}" for c in cols])


def prepare_products(products: DataFrame, cluster: str | None = None,
                     seed: int = DEFAULT_SEED, k: int | None = None,
                     max_iter: int | None = None) -> DataFrame:
    """Prepared product table.

    Columns: product_id, name, short_name, short_name_processed,
    short_name_code, brand, brand_code, weight, pieces, avg_brand_weight and,
    with ``cluster`` = 'gmm' or 'kmeans', product_group.
    """
    attrs = with_codes(products)
    if cluster:
        attrs = attrs.join(product_groups(attrs, cluster, seed, k, max_iter), "product_id", "left")
    out = attrs.join(brand_mean(attrs, "weight", "avg_brand_weight"), "brand_code", "left")
    out = out.withColumn("pieces", F.coalesce(F.col("pieces"), F.lit(1.0)))
    out = impute_mean(out, ["weight", "avg_brand_weight"])
    cols = ["product_id", "name", "short_name", "short_name_processed", "short_name_code",
            "brand", "brand_code", "weight", "pieces", "avg_brand_weight"]
    if cluster:
        cols.append("product_group")
    return out.select(*cols)


def product_features(prepared: DataFrame) -> DataFrame:
    cols = ["product_id", "weight", "brand_code", "pieces", "short_name_code"]
    if "product_group" in prepared.columns:
        cols.append("product_group")
    return prepared.select(*cols)


def bag_of_words(prepared: DataFrame, min_df: int = 2):
    """Fitted tokenizer + count vectorizer; returns (model, vectors frame).

    The vocabulary is every word found in ``min_df`` names: its size is counted
    first, so that no default limit cuts the rarer words."""
    size = document_frequency(prepared, "short_name_processed", min_df=min_df).count()
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="short_name_processed", outputCol="_tokens",
                       pattern=TOKEN_PATTERN, gaps=False, toLowercase=True),
        CountVectorizer(inputCol="_tokens", outputCol="words", minDF=float(min_df),
                        vocabSize=max(1, size)),
    ])
    model = pipe.fit(prepared)
    return model, model.transform(prepared).drop("_tokens")


def product_groups(prepared: DataFrame, method: str = "gmm", seed: int = DEFAULT_SEED,
                   k: int | None = None, max_iter: int | None = None) -> DataFrame:
    """(product_id, product_group) from clustering the words of the names: a
    mixture on the sparse word counts, or k-means on the word vectors."""
    if method == "gmm":
        fitted = fit_mixture(prepared, word_counts(prepared, "short_name_processed"), k=k or GMM_COMPONENTS,
                             rounds=max_iter or ROUNDS, seed=seed)
        return fitted.groups.withColumnRenamed("group", "product_group")
    _, vec = bag_of_words(prepared)
    est = KMeans(k=k or KMEANS_CLUSTERS, seed=seed, featuresCol="words",
                 predictionCol="product_group", maxIter=max_iter or KMEANS_ITERATIONS,
                 initMode="k-means||")
    return est.fit(vec).transform(vec).select("product_id", F.col("product_group").cast("int"))


def prepare_locations(locations: DataFrame) -> DataFrame:
    """(depot_id, town, state) -> + town_state_code (of town||state, no
    separator, so 'ab'+'c' and 'a'+'bc' share a code) and state_code."""
    out = locations.withColumn("town_state", F.concat("town", "state"))
    out = encode_many(out, {"town_state": "town_state_code", "state": "state_code"})
    return out.select("depot_id", "town", "state", "town_state_code", "state_code")


def location_features(prepared: DataFrame) -> DataFrame:
    return prepared.select("depot_id", "town_state_code", "state_code")

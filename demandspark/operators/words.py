"""Words of names as sparse rows, and a Gaussian mixture fitted on them.

A bag of words is a table (id, word_id, n) with a dictionary (token, doc_freq,
word_id) numbered in token order; neither reaches the driver and no bound cuts
the words. The mixture has a diagonal covariance per component, like the
source's, and works on that table alone: what a word that a row lacks adds to a
component's density is the same for all rows, so it is summed once per
component, and only the words that a row holds are joined.

Rows of equal words are one row with a weight, so copies of a name cost
nothing. What reaches the driver is one number per component and round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.text import tokens
from demandspark.session import materialize
from demandspark.sources.ids import with_consecutive_id

COMPONENTS = 45
ROUNDS = 100
TOLERANCE = 1e-3      # rise of the mean log-likelihood that ends the fit
MIN_VARIANCE = 1e-3   # floor of every variance


def document_frequency(docs: DataFrame, text: str, id_col: str = "product_id", min_df: int = 2) -> DataFrame:
    """(token, doc_freq) of the tokens that at least ``min_df`` rows hold."""
    t = docs.select(id_col, F.explode(F.array_distinct(tokens(text))).alias("token"))
    return t.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq")).where(F.col("doc_freq") >= min_df)


def word_counts(docs: DataFrame, text: str, id_col: str = "product_id", min_df: int = 2) -> DataFrame:
    """(id, word_id, token, n): how often each row holds each token of the
    dictionary; word_id counts the dictionary's tokens in order, from 0. Rows
    without such a token have no line."""
    dictionary = with_consecutive_id(document_frequency(docs, text, id_col, min_df), ["token"], "word_id", start=0)
    held = (docs.select(id_col, F.explode(tokens(text)).alias("token"))
            .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("n")))
    return held.join(dictionary.select("token", "word_id"), "token").select(id_col, "word_id", "token", "n")


class Mixture:
    """A fitted mixture: rows (``id``, group), parameters (word_id, m, v) and the
    log-likelihood per row before each round."""

    def __init__(self, groups: DataFrame, parameters: DataFrame, shares: list[float], likelihoods: list[float]):
        self.groups, self.parameters, self.shares, self.likelihoods = groups, parameters, shares, likelihoods


def _numbers(values: list[float]) -> Column:
    """One number per component, as data: the plan's code is the same every round."""
    return F.from_json(F.lit(str([float(v) for v in values])), "array<double>")


def _added(arrays: Column, k: int) -> Column:
    """Sum of some arrays, place by place."""
    return F.aggregate(arrays, F.array_repeat(F.lit(0.0), k), lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))


def _by_component(df: DataFrame, value: Column, k: int) -> list[float]:
    """Sums of an array column over all rows, place by place."""
    told = df.select(F.posexplode(value).alias("c", "x")).groupBy("c").agg(F.sum("x").alias("x")).collect()  # k rows
    by = {r["c"]: r["x"] for r in told}
    return [by.get(c) or 0.0 for c in range(k)]


def _expect(patterns: DataFrame, counts: DataFrame, parameters: DataFrame, shares: list[float]) -> DataFrame:
    """Per pattern its shares in the components (r) and the log of its density."""
    k = len(shares)
    empty = _by_component(parameters, F.zip_with("m", "v", lambda m, v: -0.5 * (F.log(2 * math.pi * v) + m * m / v)), k)
    base = [max(math.log(s), -1e300) + e if s > 0 else -1e300 for s, e in zip(shares, empty)]
    x = F.col("n")
    # a row's words are those of one text
    held = (counts.join(parameters, "word_id")
            .select("row", F.zip_with("m", "v", lambda m, v: x * m / v - x * x / (2 * v)).alias("s"))
            .groupBy("row").agg(_added(F.collect_list("s"), k).alias("s")))
    logs = patterns.join(held, "row", "left").select(
        "row", "weight", F.zip_with(F.coalesce("s", F.array_repeat(F.lit(0.0), k)), _numbers(base),
                                    lambda s, b: s + b).alias("logs"))
    top = logs.withColumn("top", F.array_max("logs"))
    density = F.col("top") + F.log(F.aggregate("logs", F.lit(0.0), lambda a, y: a + F.exp(y - F.col("top"))))
    return (top.withColumn("density", density)
            .select("row", "weight", "density", F.transform("logs", lambda y: F.exp(y - F.col("density"))).alias("r")))


def _in_order(column: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("c", column))), lambda x: x[column])


def _maximise(expected: DataFrame, counts: DataFrame, sizes: list[float]) -> DataFrame:
    """(word_id, m, v) from the rows' shares; ``sizes`` are the components' weights.
    A word's rows are summed per component before they are shuffled."""
    size = F.greatest(F.get(_numbers(sizes), F.col("c")), F.lit(1e-300))
    sums = (counts.join(expected, "row")
            .select("word_id", "n", "weight", F.posexplode("r").alias("c", "r"))
            .groupBy("word_id", "c").agg(F.sum(F.col("weight") * F.col("r") * F.col("n")).alias("a"),
                                         F.sum(F.col("weight") * F.col("r") * F.col("n") * F.col("n")).alias("b")))
    moments = sums.withColumns({"m": F.col("a") / size, "q": F.col("b") / size}).withColumn(
        "v", F.greatest(F.lit(MIN_VARIANCE), F.col("q") - F.col("m") * F.col("m")))
    return moments.groupBy("word_id").agg(_in_order("m").alias("m"), _in_order("v").alias("v"))


def fit_mixture(ids: DataFrame, words: DataFrame, id_col: str = "product_id", k: int = COMPONENTS,
                rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: int = 47) -> Mixture:
    """Expectation maximisation over sparse rows.

    ids: all rows (``id_col``); words: (``id_col``, word_id, n), where a row
    without words is the zero row. Components start at k different rows picked
    by a hash (fewer if there are fewer different rows) with the variances of
    all rows. Variances are held at MIN_VARIANCE or above, under which each round's
    parameters are the best, so the likelihood never falls.
    """
    held = words.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("word_id", "n"))).alias("held"))
    kind = held.schema["held"].dataType.simpleString()
    rows = materialize(ids.select(id_col).join(held, id_col, "left")
                       .withColumn("held", F.coalesce("held", F.array().cast(kind))), "word-rows")
    patterns = materialize(with_consecutive_id(rows.groupBy("held").agg(F.count(F.lit(1)).cast("double").alias("weight")),
                                               ["held"], "row", start=0), "word-patterns")
    counts = materialize(patterns.select("row", "weight", F.explode("held").alias("x")).select(
        "row", "weight", "x.word_id", F.col("x.n").cast("double").alias("n")), "word-counts")
    chosen = [r[0] for r in patterns.orderBy(F.xxhash64("row", F.lit(seed)), "row").limit(k).select("row").collect()]
    k = max(1, len(chosen))
    total = patterns.agg(F.sum("weight")).first()[0] or 1.0
    mean, square = (F.sum(F.col("weight") * F.col("n") ** p) / F.lit(total) for p in (1, 2))
    spread = F.greatest(F.lit(MIN_VARIANCE), square - mean * mean)
    first = ids.sparkSession.createDataFrame([(r, c) for c, r in enumerate(chosen)], "row long, c int")
    start = (counts.join(first, "row", "left").groupBy("word_id")
             .agg(spread.alias("spread"), F.map_from_entries(F.collect_list(F.when(
                 F.col("c").isNotNull(), F.struct("c", "n")))).alias("own")))     # k entries at most
    parameters = materialize(start.select(
        "word_id", F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                               lambda c: F.coalesce(F.try_element_at("own", c), F.lit(0.0))).alias("m"),
        F.array_repeat("spread", k).alias("v")), "word-parameters")
    shares, likelihoods = [1.0 / k] * k, []
    counts, numbered, patterns = counts.drop("weight"), patterns.drop("weight"), patterns.drop("held")
    while True:
        expected = materialize(_expect(patterns, counts, parameters, shares), "word-shares")
        told = expected.agg(F.sum(F.col("weight") * F.col("density"))).first()[0]
        likelihoods.append((told or 0.0) / total)
        if len(likelihoods) > rounds or len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tolerance:
            break
        sizes = _by_component(expected, F.transform("r", lambda r: r * F.col("weight")), k)
        parameters = materialize(_maximise(expected, counts, sizes), "word-parameters")
        shares = [s / total for s in sizes]
    best = expected.select("row", (F.array_position("r", F.array_max("r")) - 1).cast("int").alias("group"))
    groups = rows.join(numbered.join(best, "row"), "held").select(id_col, "group")
    return Mixture(materialize(groups, "word-groups"), parameters, shares, likelihoods)

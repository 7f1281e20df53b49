"""Hand-made rows for the semantic decisions (null handling, clamps, codes,
splits, scaling, name patterns)."""

import math
import re

import pytest
from pyspark.sql import functions as F

from demandspark.functions import expressions as X
from demandspark.operators import features as FE
from demandspark.operators import metrics as ME
from demandspark.operators import models as M
from demandspark.operators import products as PR
from demandspark.operators import profile as PF
from demandspark.operators import quantiles as Q
from demandspark.operators import splits as SP
from demandspark.operators import stacking as ST
from demandspark.operators import target_means as TM
from demandspark.operators import unique_counts as UC
from demandspark.sources.ids import with_consecutive_id, with_running_sum


def test_name_patterns(spark):
    names = ["Tostado Integral 180g BIM 120", "Bimbollos Ext sAjonjoli 6p 480g BIM 41",
             "NO IDENTIFICADO 0", "Pan 1Kg X2 BON 99", ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "product_id long, name string")
    got = {r.product_id: r for r in PR.product_attributes(df).collect()}
    assert got[0].short_name == "Tostado Integral "
    assert got[0].brand == "BIM" and got[0].weight == 180.0 and got[0].pieces is None
    assert got[1].brand == "BIM" and got[1].weight == 480.0 and got[1].pieces == 6.0
    assert got[2].short_name == "NO IDENTIFICADO " and got[2].brand == "IDENTIFICADO"
    assert got[2].weight is None
    assert got[3].weight == 1000.0 and got[3].brand == "BON"
    assert got[4].short_name == "" and got[4].brand is None


def test_clamp_and_metric(spark):
    rows = [(-3.0, 0.0), (0.0, 1.0), (2.5, 2.0), (float("nan"), 3.0)]
    df = spark.createDataFrame(rows, "p double, y double")
    clamped = [r.c for r in df.select(X.clamp_nonneg("p").alias("c")).collect()]
    assert clamped == [0.0, 0.0, 2.5, 0.0]
    got = ME.score(df, "p", "y", clamp=True).first()["rmsle"]
    exp = math.sqrt(sum((math.log1p(max(0, p if p == p else 0)) - math.log1p(y)) ** 2
                        for p, y in rows) / 4)
    assert abs(got - exp) < 1e-12


def test_strict_equals_clamped_when_nonnegative(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "p double, y double")
    a = ME.score(df, "p", "y", clamp=False).first()["rmsle"]
    b = ME.score(df, "p", "y", clamp=True).first()["rmsle"]
    assert abs(a - b) < 1e-15


def test_log_mean_edge_cases(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (2, 3), (3, -1), (3, 3)], "k int, demand int")
    got = {r.k: r.lm for r in TM.target_mean(df, ["k"], "lm").collect()}
    assert got[1] == 0.0
    assert abs(got[2] - (math.exp(math.log(4) / 2) - 1)) < 1e-12
    # y = -1 gives NULL log and is ignored by the mean (documented choice)
    assert abs(got[3] - 3.0) < 1e-12


def test_null_group_keys_dropped(spark):
    df = spark.createDataFrame([(None, 1), (1, 1), (1, 3)], "client_id long, demand int")
    out = TM.target_mean(df, ["client_id"], "lm").collect()
    assert [r.client_id for r in out] == [1]


def test_label_codes_sorted_with_null_last(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "b")], "i int, v string")
    got = {r.i: r.code for r in PR.encode(df, "v", "code").collect()}
    assert got == {0: 1, 1: 0, 2: 2, 3: 1}


def test_town_state_code_collision(spark):
    df = spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc")], "depot_id long, town string, state string")
    got = {r.depot_id: r for r in PR.prepare_locations(df).collect()}
    assert got[1].town_state_code == got[2].town_state_code
    assert got[1].state_code != got[2].state_code


def test_split_sizes_match_array_split(spark):
    df = spark.range(1, 12).withColumnRenamed("id", "row_id")
    folds = SP.exact_folds(df, 4, order=[F.col("row_id")])
    sizes = sorted((r.fold, r.n) for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect())
    assert [n for _, n in sizes] == [3, 3, 3, 2]


def test_split_parts_read_their_own_files(spark):
    df = spark.range(1, 22).select(F.col("id").alias("row_id"), (F.col("id") * 2).alias("v"))
    parts = SP.split_parts(df, 4)
    assert [sorted(r.row_id for r in p.collect()) for p in parts] == [
        list(range(1, 7)), list(range(7, 12)), list(range(12, 17)), list(range(17, 22))]
    plan = parts[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "Exchange" not in plan
    assert sorted(SP.union_parts(parts).select("row_id", "v").collect()) == sorted(df.collect())


def test_every_row_one_fold(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "row_id")
    f = SP.exact_folds(df, 7, shuffle=True, seed=3)
    assert f.count() == 1000 and f.select("row_id").distinct().count() == 1000
    sizes = [r.n for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) - min(sizes) <= 1
    h = SP.hash_folds(df, 5)
    assert h.where(~F.col("fold").between(1, 5)).count() == 0


def test_consecutive_ids_and_running_sum(spark):
    df = spark.createDataFrame([(i % 17, i) for i in range(500)], "a int, b int")
    ids = with_consecutive_id(df, ["a", "b"], "rid")
    got = [r.rid for r in ids.orderBy("a", "b").collect()]
    assert got == list(range(1, 501))
    rs = with_running_sum(df, ["a", "b"], "b", "cum").orderBy("a", "b").collect()
    acc = 0
    for r in rs:
        acc += r.b
        assert r.cum == acc


def test_spanish_stems(spark):
    from demandspark.functions.text import processed_name, stemmed
    from demandspark.plans.oracle import stems_sql
    import duckdb
    pairs = {"chicas": "chic", "cheques": "chequ", "torneado": "torn", "torneos": "torne", "torniquete": "torniquet",
             "torpeza": "torpez", "tortillas": "tortill", "toros": "tor", "tortura": "tortur", "torturando": "tortur",
             "chihuahua": "chihuahu", "tórax": "torax", "rápidamente": "rapid", "llegando": "lleg",
             "haciéndola": "hac", "contribuyendo": "contribu", "paguen": "pag", "tecnologías": "tecnolog",
             "pequeñas": "pequeñ", "nacionalidad": "nacional", "instituciones": "institu", "soluciones": "solucion", "presidencia": "president",
             "trabajadores": "trabaj", "negativamente": "negat", "en": "en", "a": "a", "12": "12", "x": "x"}
    df = spark.createDataFrame([(list(pairs),)], "w array<string>")
    assert dict(zip(pairs, df.select(stemmed(F.col("w"))).first()[0])) == pairs
    quoted = "[" + ", ".join(f"'{w}'" for w in pairs) + "]"
    assert duckdb.connect().execute("SELECT " + stems_sql(quoted)).fetchone()[0] == list(pairs.values())
    names = spark.createDataFrame([("Las  Galletas de Chocolate ",), ("",), (None,)], "name string")
    got = names.select(processed_name("name").alias("p"))
    assert [r.p for r in got.collect()] == ["gallet chocolat", "", None]
    assert "INSET" in got._jdf.queryExecution().optimizedPlan().toString()


def test_exact_sample_size(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "row_id")
    s = SP.exact_sample(df, 123, seed=5)
    assert s.count() == 123 and s.select("row_id").distinct().count() == 123
    assert SP.exact_sample(df, 5000).count() == 1000


def test_exact_sample_is_the_first_by_hash_without_a_sort(spark):
    df = spark.range(1, 20_001).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("row_id"), F.col("id").alias("v"))
    ranked = sorted((r.h, r.row_id or 0) for r in df.select("row_id", SP.hash_order("row_id", 9).alias("h")).collect())
    for n in (0, 1, 777, 19_999, 20_000, 50_000):
        got = SP.exact_sample(df, n, seed=9).select("row_id", SP.hash_order("row_id", 9).alias("h")).collect()
        assert sorted((r.h, r.row_id or 0) for r in got) == ranked[:n]
    assert SP.exact_sample(df.where("v < 0"), 5).count() == 0
    # the rows are filtered scans; only the bound's rows were ranked, in a table of their own
    plan = SP.exact_sample(df, 777, seed=9)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(row_id" not in plan
    bound = SP.prefix_bound(df, 777, seed=9)
    on = df.where(SP.hash_prefix("row_id", 9) == bound.prefix).count()
    assert bound.below < 777 <= bound.below + on and on < 20


def test_quantiles_match_linear_interpolation(spark):
    vals = [5, 1, 9, 3, 3, 8, 2, 7]
    df = spark.createDataFrame([(1, v) for v in vals], "k int, v int")
    s = sorted(vals)

    def q(p):
        h = (len(s) - 1) * p
        lo, hi = math.floor(h), math.ceil(h)
        return s[lo] + (s[hi] - s[lo]) * (h - lo)
    g = Q.global_quantiles(df, "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert (g.a, g.b, g.c) == (q(0.25), q(0.5), q(0.75))
    gq = Q.grouped_quantiles(df, ["k"], "v", [0.5], ["m"]).first()
    assert gq.m == q(0.5)


def test_exact_sample_of_repeated_ids(spark):
    # all ids hash alike, so the hash threshold may leave none: still exactly n rows
    df = spark.range(2000).select(F.lit(7).cast("long").alias("row_id"), F.col("id").alias("v"))
    s = SP.exact_sample(df, 50, seed=5)
    assert s.count() == 50 and s.select("v").distinct().count() == 50


def test_grouped_stats_keep_exact_integer_sums(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(1, big, 1), (1, 1, 2), (1, 1, 5)], "k int, a long, b int")
    r = PF.grouped_stats(df, ["k"], ["a", "b"]).first()
    assert r.a_sum == big + 2 and r.a_max == big and r.a_median == 1.0
    assert r.b_sum == 8 and r.b_median == 2.0


def test_vocabulary_and_groups(spark):
    names = ["pan blanco", "pan integral", "galleta blanco", "galleta integral", "torta"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                               "product_id long, short_name_processed string")
    model, _ = PR.bag_of_words(df)
    assert sorted(model.stages[-1].vocabulary) == ["blanco", "galleta", "integral", "pan"]
    got = PR.product_groups(df, "gmm", k=2, max_iter=5).collect()
    assert sorted(r.product_id for r in got) == [0, 1, 2, 3, 4]
    assert all(0 <= r.product_group < 2 for r in got)


def test_cached_table_hit_and_parameters(spark, tmp_path):
    from demandspark.sources import io as IO
    built = []

    def build():
        built.append(1)
        return spark.range(3)
    path = str(tmp_path / "cache")
    assert IO.cached_table(spark, path, build).count() == 3
    assert IO.cached_table(spark, path, build).count() == 3
    assert len(built) == 1


def test_cached_table_follows_its_inputs(spark, tmp_path):
    from demandspark.sources import io as IO
    src, path = str(tmp_path / "my input"), str(tmp_path / "cache")
    built = []

    def cached(**kw):
        df = spark.read.parquet(src)

        def build():
            built.append(1)
            return df.groupBy().sum("id")
        return IO.cached_table(spark, path, build, inputs=[df], **kw)

    spark.range(4).write.parquet(src)
    first = cached()
    assert first.first()[0] == 6 and cached().first()[0] == 6 and len(built) == 1
    # more files, rewritten files and other parameters each lead to a table of their own
    spark.range(10, 12).write.mode("append").parquet(src)
    assert cached().first()[0] == 27 and cached().first()[0] == 27 and len(built) == 2
    spark.range(5).write.mode("overwrite").parquet(src)
    assert cached().first()[0] == 10 and len(built) == 3
    assert cached(params={"k": 2}).first()[0] == 10 and len(built) == 4
    assert cached(rebuild=True).first()[0] == 10 and len(built) == 5
    # who read the first state still can
    assert first.first()[0] == 6
    # a build that was cut short left no manifest
    import glob
    import shutil
    for m in glob.glob(path + "/*-manifest"):
        shutil.rmtree(m)
    assert cached().first()[0] == 10 and len(built) == 6
    # without files nothing tells a change: built each time
    for k in (1, 2):
        IO.cached_table(spark, path + "2", lambda: built.append(1) or spark.range(3), inputs=[spark.range(3)])
        assert len(built) == 6 + k


def test_feature_csv_keeps_types(spark):
    from demandspark.plans import jobs as J
    from demandspark.sources import fixtures as FX
    from conftest import SF_SMALL
    train, test = FX.train_test(spark, SF_SMALL)
    out = J.create_features(spark, train, test, FX.products(spark, SF_SMALL),
                            FX.locations(spark, SF_SMALL), csv=True)
    kinds = dict(out.test.dtypes)
    assert kinds["lm_client"] == "double" and kinds["client_id"] == "bigint"
    assert out.test.count() == test.count()


def test_zero_variance_scaling(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    out = M.standard_scale(df, df, ["a", "b"]).collect()
    assert all(r.a == 0.0 for r in out)
    assert sorted(r.b for r in out) == [-1.0, 1.0]


def test_natural_self_join_null_safe(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "z")], "client_id long, name string")
    r = PF.self_join_counts(df).first()
    assert r.rows_before == 4 and r.rows_after == 1 + 4 + 1


def test_fallback_chain_has_no_nulls(spark):
    train = spark.createDataFrame(
        [(1, 10, 100, 1000, 5), (1, 10, 100, 1000, 7), (2, 11, 101, 1001, 1)],
        "period int, depot_id long, client_id long, product_id long, demand int")
    test = spark.createDataFrame(
        [(1, 2, 10, 100, 1000), (2, 2, 99, 999, 9999), (3, 3, 11, 101, 1001)],
        "id long, period int, depot_id long, client_id long, product_id long")
    out = FE.attach_means(test, TM.mean_stats(train))
    for c in FE.CHAIN:
        assert out.where(F.col(c).isNull()).count() == 0
    row = {r.id: r for r in out.collect()}
    # unseen everything -> global value everywhere
    assert len({getattr(row[2], c) for c in FE.CHAIN}) == 1
    # previous period present for id 1 (period 2 <- 1)
    assert abs(row[1].lm_prev_client_depot_product - (math.exp((math.log(6) + math.log(8)) / 2) - 1)) < 1e-12


def test_statistics_merged_from_one_state(spark):
    rows = spark.createDataFrame(
        [(3, 1, 10, 100, 1, 5), (3, 1, 10, 100, 2, 7), (4, 1, 10, 101, 1, None), (4, None, 10, 100, 1, 2),
         (4, 2, None, 100, None, 9), (5, 2, 11, None, 3, -4), (5, 3, 11, 101, 3, -1), (None, 3, 12, 101, 3, 0)],
        "period int, depot_id int, client_id int, product_id int, channel_id int, demand int")
    direct, merged = TM.mean_stats(rows), TM.mean_stats_from_state(TM.mean_state(rows))
    for name in TM.MeanStats.__dataclass_fields__:
        a, b = getattr(direct, name), getattr(merged, name)
        assert sorted(a.columns) == sorted(b.columns) and dict(a.dtypes) == dict(b.dtypes), name
        rounded = [[tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.select(*sorted(a.columns)).collect()]
                   for d in (a, b)]
        assert sorted(rounded[0], key=str) == sorted(rounded[1], key=str), name
    state = TM.mean_state(rows)
    for key in UC.UNIQUE_SPECS:
        assert sorted(UC.unique_counts(rows, key).collect()) == sorted(UC.unique_counts(state, key).collect())
    empty = rows.where("period > 99")
    assert TM.mean_stats_from_state(TM.mean_state(empty)).global_mean.first().lm_global is None


def test_unique_counts_median_fill(spark):
    train = spark.createDataFrame(
        [(1, 1, 1, 1), (1, 2, 1, 2), (2, 1, 2, 1), (3, 1, 3, 3)],
        "depot_id long, channel_id int, client_id long, product_id long")
    rows = spark.createDataFrame([(9, 9, 9)], "depot_id long, client_id long, product_id long")
    r = UC.add_unique_features(rows, train).first()
    # channels per depot: {1: 2, 2: 1, 3: 1} -> median 1
    assert r.n_channels_per_depot == 1.0
    # products per client: {1: 2, 2: 1, 3: 1} -> median 1
    assert r.n_products_per_client == 1.0


def test_oof_mean_excludes_own_fold(spark):
    train = spark.createDataFrame(
        [(1, 1, 1, 3), (2, 1, 2, 7), (3, 2, 1, 1), (4, 2, 2, 1)],
        "row_id long, client_id long, fold int, demand int")
    from demandspark.operators import stacking as ST
    got = {r.row_id: r.prediction for r in ST.oof_group_mean(train, ["client_id"], 2, "c").collect()}
    assert abs(got[1] - 7.0) < 1e-12 and abs(got[2] - 3.0) < 1e-12


def test_rmsle_evaluator(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, 0.0)], "prediction double, label double")
    ev = ME.RmsleEvaluator()
    exp = math.sqrt(((math.log(2) - math.log(3)) ** 2 + 0.0) / 2)
    assert abs(ev.evaluate(df) - exp) < 1e-12 and not ev.isLargerBetter()


def test_unmatched_dimension_rows(spark):
    train = spark.createDataFrame(
        [(1, 1, 1, 10, 100, 1, 5)],
        "row_id long, period int, depot_id long, channel_id int, client_id long, product_id long, demand int")
    train = train.withColumn("route_id", F.lit(1).cast("long"))
    test = spark.createDataFrame([(7, 2, 1, 1, 10, 100, 1), (8, 2, 1, 1, 10, 999, 1)],
                                 "id long, period int, depot_id long, channel_id int, client_id long, "
                                 "product_id long, route_id long")
    prods = spark.createDataFrame([(100, 5.0, 0, 1.0, 0)],
                                  "product_id long, weight double, brand_code int, pieces double, "
                                  "short_name_code int")
    locs = spark.createDataFrame([(1, 0, 0)], "depot_id long, town_state_code int, state_code int")
    _, inner = FE.build_features(train, test, prods, locs)
    assert [r.id for r in inner.collect()] == [7]
    _, left = FE.build_features(train, test, prods, locs, keep_unmatched=True)
    got = {r.id: r for r in left.collect()}
    assert set(got) == {7, 8} and got[8].weight is None and got[8].lm_client == got[7].lm_client


def test_facts_fail_on_wrong_results(spark):
    from demandspark.plans.queries import _facts
    schema = "id long, prediction double"
    good = _facts(spark.createDataFrame([(1, 0.0), (2, 3.5)], schema), "id", "prediction", 0.0, 9.0).first()
    assert tuple(good) == (2, 2, 3, 0, True)
    bad = spark.createDataFrame([(1, None), (1, float("nan")), (2, -1.0), (3, 10.0), (4, float("inf"))], schema)
    row = _facts(bad, "id", "prediction", 0.0, 9.0).first()
    assert row["n_rows"] == 5 and row["n_ids"] == 4 and row["n_wrong"] == 5


def test_linear_models_fill_missing_values(spark):
    rows = [(i, float(i) if i % 4 else None, 2.0 * i) for i in range(40)]
    df = spark.createDataFrame(rows + [(40, float("nan"), 80.0)], "id long, x double, demand double")
    for est in (M.ols(), M.linear_booster()):
        pred = M.predict_imputed(M.fit_imputed(est, df, ["x"]), df, ["x"]).collect()
        assert len(pred) == 41 and all(p["prediction"] >= 0 for p in pred)
        by_id = {p["id"]: p["prediction"] for p in pred}
        assert by_id[40] == by_id[4] == by_id[0]  # missing values share the mean's prediction
        assert by_id[30] > by_id[10]


def test_scaling_of_a_constant_that_sums_inexactly(spark):
    df = spark.range(1000).select("id", F.lit(0.1).alias("c"), F.col("id").cast("double").alias("x"))
    out = M.standard_scale(df, df, ["c", "x"]).agg(F.max(F.abs("c")).alias("c"), F.stddev_pop("x").alias("x")).first()
    assert out["c"] == 0.0 and abs(out["x"] - 1) < 1e-9


def test_numbering_writes_only_what_is_kept(spark):
    """Columns that only order the rows are sorted by, not written."""
    df = spark.createDataFrame([(3, "x", 1.5), (1, "y", 2.5), (2, None, 3.5), (None, "w", 4.5)], "a int, b string, c double")
    got = with_consecutive_id(df, ["a", "b"], "n", keep=["b", (F.col("a") * 10).alias("t")])
    assert got.columns == ["b", "t", "n"]
    assert sorted((r.n, r.b, r.t) for r in got.collect()) == [(1, "w", None), (2, "y", 10), (3, None, 20), (4, "x", 30)]
    ordered = [f for f in got.inputFiles() if "ordered" in f]
    assert ordered and set(spark.read.parquet(*ordered).columns) == {"b", "t", "_pid", "_pos"}


def test_names_are_parsed_once_over_the_cores(spark):
    """Few bytes of names lie in one file; all that is made of them reads what several tasks parsed and wrote."""
    rows = spark.createDataFrame([(i, f"Pan Blanco {i % 7}p 100g BIM {i}") for i in range(200)] + [(None, None)],
                                 "product_id long, name string").coalesce(1)
    coded = PR.with_codes(rows)
    assert coded.count() == 201 and coded.where("product_id is null").count() == 1
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "regexp" not in plan
    if spark.sparkContext.defaultParallelism > 1:
        assert len([f for f in coded.inputFiles() if "product-names" in f]) > 1


def feature_rows(spark):
    """Train and test rows with null and unknown keys, repeated rows, gaps between periods and labels of -1 or none."""
    keys = "period int, depot_id long, channel_id int, client_id long, product_id long, route_id long"
    train = [(i, i % 4 if i % 11 else None, i % 3 if i % 7 else None, i % 2, i % 5 if i % 13 else None,
              i * i % 6 if i % 17 else None, 1, i % 9 - 1 if i % 19 else None) for i in range(150)]
    test = [(i, (i % 6) if i % 11 else None, i % 4 if i % 5 else None, i % 2, i % 7 if i % 3 else None,
             i % 8 if i % 13 else None, 1) for i in range(80)]
    train = spark.createDataFrame(train + train[:20], f"row_id long, {keys}, demand int")
    prods = spark.createDataFrame([(p, 1.0 * p, 0, 1.0, p) for p in (0, 1, 1, 2, 3, 4)],
                                  "product_id long, weight double, brand_code int, pieces double, short_name_code int")
    locs = spark.createDataFrame([(0, 0, 0), (1, 1, 0), (1, 2, 1)], "depot_id long, town_state_code int, state_code int")
    return train, spark.createDataFrame(test, f"id long, {keys}"), prods, locs


@pytest.mark.parametrize("keep", [False, True])
def test_feature_windows_equal_feature_joins(spark, keep):
    from demandspark.plans.common import round_doubles
    train, test, prods, locs = feature_rows(spark)
    joined, windows = ([sorted(map(str, round_doubles(t, 9).collect())) for t in FE.build_features(
        train, test, prods, locs, keep, materialize_stats=m)] for m in (False, True))
    assert joined == windows and all(len(t) > 20 for t in windows)


def test_feature_rows_are_dealt_by_product_once(spark):
    train, test, prods, locs = feature_rows(spark)
    tr, _ = FE.build_features(train, test, prods, locs, materialize_stats=True)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", tr._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
    assert sum("product_id" in d for d in dealt) <= 2 and len(dealt) <= 5, dealt    # rows and products; clients; depots


def test_grouped_stats_and_blend_need_no_pivot(spark):
    rows = [(k, a, b) for k, vals in ((1, [(3, 1), (None, 2), (5, 9), (5, None)]), (2, [(None, 4)]), (3, [(None, None)]))
            for a, b in vals]
    df = PF.grouped_stats(spark.createDataFrame(rows, "k int, a int, b int"), ["k"], ["a", "b"])
    got = {r.k: tuple(r)[1:] for r in df.collect()}
    assert got == {1: (3, 13, 3, 5, 5.0, 13 / 3, 3, 12, 1, 9, 2.0, 4.0),
                   2: (None,) * 6 + (1, 4, 4, 4, 4.0, 4.0)}
    long = spark.createDataFrame([(1, "x", 2.0), (1, "y", None), (2, "y", 3.0), (2, "z", 4.0)],
                                 "row_id long, model string, prediction double")
    wide = ST.blend_pivot(long, ["x", "y"])
    assert sorted(map(tuple, wide.collect())) == [(1, 2.0, None), (2, None, 3.0)]
    for plan in (df, wide):     # a pivot groups a second time, by key and value
        assert "pivotfirst" not in plan._jdf.queryExecution().toString().lower()

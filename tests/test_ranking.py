"""Ranks, quantiles, bins and scaling against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallycrest.operators import binning, folds, ranking, scaling


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0.0, 0.5, 1.0, 1.5, 2.0, 7.25, -3.0, 1e9]), min_size=1, max_size=60), st.integers(2, 6))
def test_bins_equal_pandas(spark, values, q):
    df = frame(spark, i=range(len(values)), x=values, y=values)
    got = [r["b"] for r in binning.quantile_bins(df, {"x": q}, {"x": "b"}).orderBy("i").collect()]
    want = pd.qcut(pd.Series(values), q, labels=False, duplicates="drop")
    assert got == [0 if pd.isna(w) else int(w) for w in want]


def test_bins_keep_nulls_and_are_monotone(spark):
    df = spark.createDataFrame([(i, float(i % 17) if i % 5 else None) for i in range(200)], "i int, x double")
    rows = binning.quantile_bins(df, {"x": 4}, {"x": "b"}).filter("x IS NOT NULL").select("x", "b").distinct()
    bins = [b for _, b in sorted((r["x"], r["b"]) for r in rows.collect())]
    assert bins == sorted(bins)
    assert binning.quantile_bins(df, {"x": 4}, {"x": "b"}).filter("x IS NULL AND b IS NULL").count() == 40


def test_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(3, 2, 4000), np.full(2000, 5.0)])
    df = frame(spark, x=values, g=np.where(np.arange(6000) % 3 == 0, "a", "b"))
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.99, 1]
    for row in ranking.quantiles(df, ["x"], probs, ["g"]).collect():
        part = values[np.arange(6000) % 3 == 0] if row["g"] == "a" else values[np.arange(6000) % 3 != 0]
        assert row["n"] == len(part)
        np.testing.assert_allclose(row["q"], np.quantile(part, probs), rtol=1e-12)


def test_midranks(spark):
    values = [3.0, 1.0, 3.0, 2.0, 3.0, 1.0, 9.0]
    df = frame(spark, x=values, y=values)
    ranked = ranking.midranks(ranking.long_values(df, ["x"]), ["metric"]).collect()
    want = pd.Series(values).rank()
    assert {r["value"]: r["midrank"] for r in ranked} == dict(zip(values, want))


def test_nan_and_null_are_no_values(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert ranking.quantiles(df, ["x"], [0.5]).first()["n"] == 1


def test_scaling_of_constant_and_null(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0), (3, 5.0, None)], "i int, c double, x double")
    z = {r["i"]: r for r in scaling.standardize(df, ["c", "x"]).collect()}
    assert [z[i]["c"] for i in (1, 2, 3)] == [0, 0, 0]
    assert [z[i]["x"] for i in (1, 2, 3)] == [-1, 1, None]
    m = {r["i"]: r for r in scaling.minmax(df, ["c", "x"]).collect()}
    assert [m[i]["c_std"] for i in (1, 2, 3)] == [None] * 3
    assert [m[i]["x_std"] for i in (1, 2, 3)] == [0, 1, None]


def test_unstandardize_returns_the_original(spark):
    df = frame(spark, i=range(10), qty=[float(i * i) for i in range(10)])
    scaled = scaling.standardize(df, ["qty"], "_z").drop("qty")
    back = scaling.unstandardize(scaled, scaling.column_stats(df, ["qty"]), "qty", "qty_z", "qty")
    assert [round(r["qty"], 9) for r in back.orderBy("i").collect()] == [i * i for i in range(10)]
    again = scaling.unstandardize_by_scaled(scaling.standardize(df, ["qty"]), "qty").toPandas()["qty"]
    z = (df.toPandas()["qty"] - 28.5) / df.toPandas()["qty"].std(ddof=0)
    np.testing.assert_allclose(sorted(again), sorted(z * z.std() + z.mean()), rtol=1e-9, atol=1e-12)


def test_outliers(spark):
    values = [1.0] * 30 + [2.0] * 30 + [50.0]
    df = frame(spark, x=values, y=[1.0] * 60 + [2.0])
    assert scaling.drop_outliers_z(df, ["x"], 2.0).count() == 60
    assert scaling.drop_outliers_iqr(df, "x").count() == 60
    edge = frame(spark, x=[0.0, 1.0, 2.0, 3.0, 4.0, 6.0], y=[0.0] * 6)  # fences 1.25-1.5*2.5 and 3.75+1.5*2.5
    assert scaling.drop_outliers_iqr(edge, "x").count() == 6


def test_label_codes_and_one_hot(spark):
    df = spark.createDataFrame([("retain",), ("churn",), ("retain",), (None,)], "label string")
    assert {(r["label"], r["code"]) for r in binning.label_encode(df, "label", "code").collect()} == {
        ("retain", 1), ("churn", 0), (None, None)}
    hot = binning.one_hot(df, "label", ["churn", "retain"], "is_").collect()
    assert sorted((r["is_churn"], r["is_retain"]) for r in hot) == [(0, 0), (0, 1), (0, 1), (1, 0)]


def test_folds_differ_by_at_most_one(spark):
    df = frame(spark, id=range(1003), label=["a" if i % 3 else "b" for i in range(1003)])
    folded = folds.add_folds(df, "id", 5, "label")
    sizes = folded.groupBy("label", "fold").count().toPandas()
    assert len(folded.select("id").distinct().collect()) == 1003
    assert (sizes.groupby("label")["count"].max() - sizes.groupby("label")["count"].min() <= 1).all()
    whole = folds.add_folds(df, "id", 4).groupBy("fold").count().toPandas()["count"]
    assert whole.max() - whole.min() <= 1
    again = folds.add_folds(df.orderBy(F.rand(1)), "id", 5, "label")
    assert folded.select("id", "fold").exceptAll(again.select("id", "fold")).count() == 0


def test_folds_do_not_move_with_the_partition_number(spark):
    df = frame(spark, id=range(500), label=["a" if i % 3 else "b" for i in range(500)])
    seen, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        seen.append({r["id"]: r["fold"] for r in folds.add_folds(df, "id", 5, "label").collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_any_number_of_classes_is_encoded(spark):
    labels = [f"label {i:05}" for i in range(12_000)]
    df = frame(spark, label=[*labels, *labels[:5], None])
    got = {r["label"]: r["code"] for r in binning.label_encode(df, "label", "code").collect()}
    assert got == {**{x: i for i, x in enumerate(labels)}, None: None}


def test_one_hot_of_awkward_names(spark):
    df = frame(spark, kind=["it's", "KA, CP", None])
    got = binning.one_hot(df, "kind", ["it's", "KA, CP"], "customer_")
    assert got.columns == ["kind", "customer_it's", "customer_ka,_cp"]
    assert [tuple(r)[1:] for r in got.collect()] == [(1, 0), (0, 1), (0, 0)]

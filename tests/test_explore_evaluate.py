"""Exploration and evaluation on small frames."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from tallycrest.functions import pvalues
from tallycrest.operators import evaluate, explore

D = dt.datetime


def test_label_rates(spark):
    rows = [("x", "churn"), ("x", "retain"), ("x", "retain"), ("y", "retain"), (None, "churn"), ("z", None)]
    df = spark.createDataFrame(rows, "seg string, label string")
    got = {r["seg"]: (r["churn"], r["retain"], r["total"]) for r in
           explore.label_rates(df, "seg", "label", ["churn", "retain"]).collect()}
    assert got == {"x": (pytest.approx(1 / 3), pytest.approx(2 / 3), 1.0), "y": (0.0, 1.0, 1.0)}
    shares = {r["label"]: (r["n"], r["share"]) for r in explore.label_share(df, "label").collect()}
    assert shares == {"churn": (2, 0.4), "retain": (3, 0.6)}


def test_monthly_trend_has_empty_months(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(D(2020, 1, 31), 1.0), (D(2020, 4, 1), 2.0), (D(2020, 4, 30), 3.0)],
                               "d timestamp_ntz, x double")
    got = {r["month"]: r["x"] for r in explore.monthly_trend(df, "d", {"x": F.sum("x")}).collect()}
    assert got == {dt.date(2020, 1, 1): 1.0, dt.date(2020, 2, 1): 0.0, dt.date(2020, 3, 1): 0.0, dt.date(2020, 4, 1): 5.0}


def periods_by_hand(rows, months):
    df = pd.DataFrame(rows, columns=["c", "d"])
    cuts = pd.date_range(df.d.min(), df.d.max(), freq=f"{months}ME")
    found = set()
    for a, b in zip(cuts[:-1], cuts[1:]):
        now = set(df[(df.d >= a) & (df.d < b + pd.DateOffset(days=1))].c)
        after = set(df[(df.d >= b) & (df.d < b + pd.DateOffset(months=months) + pd.DateOffset(days=1))].c)
        found |= now & after
    return len(found)


@pytest.mark.parametrize("months,seed", [(1, 0), (3, 1), (6, 2)])
def test_consecutive_periods(spark, months, seed):
    rng = np.random.default_rng(seed)
    start = D(2020, 1, 17, 6)
    rows = [(int(rng.integers(40)), start + dt.timedelta(hours=int(h))) for h in rng.integers(0, 24 * 800, 120)]
    rows += [(99, D(2020, 4, 30, 6)), (98, D(2020, 5, 1, 5)), (97, start)]
    df = spark.createDataFrame(rows, "customer_id int, order_date timestamp_ntz")
    got = explore.consecutive_periods(df, months).first()
    first = min(r[1] for r in rows)
    clocked = [(c, pd.Timestamp(d)) for c, d in rows]
    assert first.hour == 6 or first < start
    assert got["consecutive_customers"] == periods_by_hand(clocked, months)
    assert got["customers"] == len({r[0] for r in rows})


def test_histogram_box_and_describe(spark):
    values = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 100.0]
    df = spark.createDataFrame([(v, "g") for v in values], "x double, g string")
    hist = {r["bin"]: r["n"] for r in explore.histogram(df, "x", "g").collect()}
    assert hist == {0: 10, 1: 1, 9: 1}
    box = explore.box_summary(df, ["x"], "g").first()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (box["n"], box["q25"], box["q50"], box["q75"]) == (12, q1, q2, q3)
    assert (box["low_whisker"], box["high_whisker"], box["outliers"]) == (0.0, 10.0, 1)
    stats = explore.describe_numeric(df, ["x"]).first()
    want = pd.Series(values).describe()
    assert [stats[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))


def test_constant_column_histogram(spark):
    df = spark.createDataFrame([(2.0, "g")] * 3, "x double, g string")
    assert [(r["bin"], r["n"]) for r in explore.histogram(df, "x", "g").collect()] == [(0, 3)]


PRED = "target_encoded int, predictions int, probability double, fold int"


def test_confusion_and_report(spark):
    rows = [(0, 0, 0.9, 0), (0, 1, 0.6, 0), (1, 1, 0.8, 0), (1, 0, 0.7, 1), (1, 1, 0.5, 1), (0, 0, 0.5, 1)]
    df = spark.createDataFrame(rows, PRED)
    kinds = {r["outcome"]: (r["n"], r["mean"]) for r in evaluate.confusion_probabilities(df).collect()}
    assert kinds == {"correct_0": (2, pytest.approx(0.7)), "correct_1": (2, pytest.approx(0.65)),
                     "incorrect_1": (1, 0.6), "incorrect_0": (1, 0.7)}
    report = {r["class"]: r for r in evaluate.classification_report(df, "fold").collect()}
    assert report[0]["precision"] == pytest.approx((1 + 0.5) / 2)
    assert report[0]["recall"] == pytest.approx((0.5 + 1) / 2)
    assert report[1]["f1"] == pytest.approx((2 / 3 + 2 / 3) / 2)
    assert (report[0]["support"], report[1]["support"], report[1]["accuracy"]) == (3, 3, pytest.approx(2 / 3))


def test_regression_metrics_and_bands(spark):
    rows = [(1, 100.0, 105.0), (1, 100.0, 80.0), (2, 100.0, 130.0), (2, 50.0, 100.0), (3, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "sales_id int, y_true double, y_pred double")
    m = evaluate.regression_metrics(df).first()
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert m["mse"] == pytest.approx(((y - p) ** 2).mean()) and m["mae"] == pytest.approx(abs(y - p).mean())
    assert m["median_ape"] == pytest.approx(30.0) and m["mean_ape"] == pytest.approx(155 / 4)
    assert m["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    bands = {r["band"]: (r["n_rows"], r["n_reps"]) for r in evaluate.forecast_bands(df).collect()}
    assert bands == {"highly accurate": (1, 1), "good": (1, 1), "reasonable": (1, 1), "weak and inaccurate": (2, 2)}
    hit = spark.createDataFrame([(4, 0.0, 0.0)], df.schema)
    assert evaluate.forecast_bands(df.unionByName(hit)).agg({"n_rows": "sum"}).first()[0] == 5


def test_tail_probabilities():
    assert pvalues.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert pvalues.chi2_upper(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert pvalues.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-9)
    assert pvalues.t_two_sided(1.959963984540054, 1e7) == pytest.approx(0.05, rel=1e-5)
    assert pvalues.t_inverse(0.975, 4) == pytest.approx(2.7764451051977987, rel=1e-9)
    assert pvalues.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-9)
    # an even number of degrees of freedom has a closed form
    assert pvalues.chi2_upper(50, 4) == pytest.approx(math.exp(-25) * 26, rel=1e-9)


def test_rank_tests(spark):
    a, b, c = [1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 7.0, 8.0, 9.0], [4.0, 4.0, 4.0]
    rows = [(v, g) for g, vs in zip("abc", (a, b, c)) for v in vs]
    df = spark.createDataFrame(rows, "x double, g string")
    u = evaluate.mann_whitney(df, ["x"], "g", ["a", "b"]).first()
    wins = sum((p > q) + (p == q) / 2 for p in a for q in b)
    assert (u["size_1"], u["size_2"], u["u"]) == (4, 5, wins)
    ranks = pd.Series([r[0] for r in rows]).rank().to_numpy()
    groups = np.array([r[1] for r in rows])
    n = len(rows)
    h = 12 / (n * (n + 1)) * sum(ranks[groups == g].sum() ** 2 / (groups == g).sum() for g in "abc") - 3 * (n + 1)
    counts = pd.Series([r[0] for r in rows]).value_counts()
    h /= 1 - (counts**3 - counts).sum() / (n**3 - n)
    k = evaluate.rank_test(df, ["x"], "g", ["a", "b", "c"]).first()
    assert k["statistic"] == pytest.approx(h) and k["p"] == pytest.approx(math.exp(-h / 2))


def test_t_test(spark):
    rows = [(1.0, 1), (2.0, 1), (4.0, 1), (2.0, 2), (6.0, 2), (7.0, 2), (9.0, 2)]
    df = spark.createDataFrame(rows, "x double, g int").selectExpr("x", "x AS y", "g")
    got = {r["feature"]: r for r in evaluate.t_test_bonferroni(df, ["x", "y"], df["g"] == 1, df["g"] == 2).collect()}
    a, b = np.array([1, 2, 4.0]), np.array([2, 6, 7, 9.0])
    pooled = (2 * a.var(ddof=1) + 3 * b.var(ddof=1)) / 5
    t = (a.mean() - b.mean()) / (pooled * (1 / 3 + 1 / 4)) ** 0.5
    assert got["x"]["t"] == pytest.approx(t)
    assert got["x"]["p"] == pytest.approx(pvalues.t_two_sided(t, 5))
    assert got["y"]["p_corrected"] == pytest.approx(min(1, 2 * got["x"]["p"]))

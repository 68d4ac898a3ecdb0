"""Rep features and quota rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycrest.operators import quota_rules as rules
from tallycrest.operators import reps

D = dt.datetime
SALE = "sales_id string, efftive_date timestamp_ntz, eur double, tran_type string"
MONTHLY = "sales_id long, year_id int, month int, eur double, amount double"


def by_key(df, *values):
    return {tuple(r[k] for k in reps.KEYS): tuple(r[v] for v in values) for r in df.collect()}


def test_month_numbers(spark):
    rows = [("Jan",), ("Dec",), ("1",), ("12",), ("01",), ("13",), ("x",), (None,)]
    from tallycrest.functions.columns import month_number

    got = [r[0] for r in spark.createDataFrame(rows, "m string").select(month_number("m")).collect()]
    assert got == [1, 12, 1, 12, None, None, None, None]


def test_scores_cover_all_lines_and_sales_only_shipments(spark):
    rows = [("1", D(2020, 1, 5), -10.0, "Shipment"), ("1", D(2020, 1, 9), 5.0, "Backlog"),
            ("1", D(2018, 1, 9), 5.0, "Shipment"), ("GPSales", D(2020, 1, 1), 900.0, "Shipment"),
            ("2", D(2020, 2, 1), 7.0, "Backlog"), ("x", D(2020, 2, 1), 7.0, "Shipment")]
    scores = reps.rep_month_scores(spark.createDataFrame(rows, SALE), 2018)
    found = {r["sales_id"]: (r["lines"], r["total"], r["eur"]) for r in scores.collect()}
    assert found == {"1": (2, 15.0, 10.0), "GPSales": (1, 900.0, 900.0), "2": (1, 7.0, 0.0), "x": (1, 7.0, 7.0)}
    backlog = spark.createDataFrame([("1", D(2020, 1, 1), 3.0, "Backlog")], SALE)
    assert by_key(reps.rep_month_sales(scores, backlog), "eur", "backlog") == {(1, 2020, 1): (10.0, 3.0)}


def test_backlog_per_row_mode(spark):
    rows = [("1", D(2020, 1, d), 1.0, "Shipment") for d in (1, 2, 3)] + [("2", D(2020, 1, 1), 1.0, "Shipment")]
    scores = reps.rep_month_scores(spark.createDataFrame(rows, SALE), 2018)
    backlog = spark.createDataFrame([("1", D(2020, 1, 1), 2.0, "Backlog")], SALE)
    got = by_key(reps.rep_month_sales(scores, backlog, mode="per_row"), "backlog")
    assert got == {(1, 2020, 1): (6.0,), (2, 2020, 1): (0.0,)}


def test_quota_months_are_summed_in_full_units(spark):
    rows = [(1, "n1", 2020, "Jan", 1.5, "s", "f"), (1, "n2", 2020, "1", 2.0, "s", "f"), (1, "n", 2020, "?", 9.0, "s", "f")]
    df = spark.createDataFrame(rows, "sales_id long, sales_name string, year_id int, month string, amount double, "
                                     "master_sector string, fact_entity string")
    assert by_key(reps.quota_monthly(df), "amount", "sales_name") == {(1, 2020, 1): (3500.0, "n2")}


def test_calendar_lag_and_row_lag(spark):
    rows = [(1, 2020, m, float(m), 0.0) for m in range(1, 13) if m != 3]
    rows += [(1, 2021, m, 100.0 + m, 0.0) for m in range(1, 13)] + [(1, 2023, 1, 5.0, 0.0)]
    df = spark.createDataFrame(rows, MONTHLY)
    calendar = by_key(reps.lag_year(df, {"eur": "before"}), "before")
    assert calendar[(1, 2021, 3)] == (None,) and calendar[(1, 2021, 4)] == (4.0,)
    assert calendar[(1, 2023, 1)] == (None,)
    by_rows = by_key(reps.lag_rows(df, {"eur": "before"}, filled_year=2020), "before")
    assert len(by_rows) == len(rows)
    assert by_rows[(1, 2021, 3)] == (None,) and by_rows[(1, 2021, 4)] == (4.0,)  # month 3 counts as a row
    assert by_rows[(1, 2023, 1)] == (101.0,)
    unfilled = by_key(reps.lag_rows(df, {"eur": "before"}, filled_year=1999), "before")
    assert unfilled[(1, 2021, 3)] == (2.0,)


def test_interpolation(spark):
    rows = [(1, 2020, 9, 10.0, 0.0), (1, 2020, 12, None, 0.0), (1, 2021, 6, None, 0.0), (1, 2021, 7, 4.0, 0.0),
            (1, 2021, 8, 999.0, 0.0), (1, 2021, 9, None, 0.0), (2, 2021, 8, 7.0, 0.0), (2, 2021, 9, None, 0.0),
            (3, 2020, 8, None, 0.0), (3, 2021, 1, 6.0, 0.0)]
    df = spark.createDataFrame(rows, MONTHLY)
    got = by_key(reps.interpolate_open_months(df), "eur")
    assert got[(1, 2020, 9)] == (10.0,)  # a past year's month stays
    assert got[(1, 2020, 12)] == (5.0,)  # half way to the 0 of June
    assert got[(1, 2021, 6)] == (0.0,) and got[(1, 2021, 7)] == (4.0,)
    assert got[(1, 2021, 8)] == (4.0,) and got[(1, 2021, 9)] == (4.0,)  # flat end
    assert got[(2, 2021, 8)] == (None,) and got[(2, 2021, 9)] == (None,)  # nothing known
    assert got[(3, 2020, 8)] == (6.0,)  # flat start
    every = by_key(reps.interpolate_open_months(df, scope="all"), "eur")
    assert every[(1, 2020, 9)] == (0.0,)


def test_mean_fill_and_spread(spark):
    rows = [(1, 2020, 1, 2.0, 10.0), (1, 2020, 2, None, 20.0), (1, 2020, 3, 4.0, 30.0), (2, 2020, 1, None, 5.0)]
    df = spark.createDataFrame(rows, MONTHLY)
    got = by_key(reps.fill_by_rep_mean(df, ["eur"]), "eur")
    assert got[(1, 2020, 2)] == (3.0,) and got[(2, 2020, 1)] == (None,)
    spread = by_key(reps.add_spread(df), "historical_mean", "spread")
    assert spread[(1, 2020, 1)] == (20.0, 10.0) and spread[(2, 2020, 1)] == (5.0, None)


def test_win_rates(spark):
    rows = [("7", p, D(2020, 1, 3), 1.0) for p in (None, 74.9, 75.0, 100.0)]
    rows += [("7.9", 100.0, D(2020, 1, 4), 1.0), ("n/a", 100.0, D(2020, 1, 3), 1.0), ("8", 100.0, D(2020, 1, 3), 1.0)]
    opp = spark.createDataFrame(rows, "sales_code_text string, probability double, created_date timestamp_ntz, amount double")
    quota = spark.createDataFrame([(7, 2020, 1, 0.0, 0.0), (7, 2020, 2, 0.0, 0.0)], MONTHLY)
    got = by_key(reps.rep_win_rate(quota, opp), "leads", "win_rate", "partial_win_rate")
    assert got == {(7, 2020, 1): (5, 40.0, 60.0)}


def test_growth(spark):
    rows = [(1, 2020, 1, 100.0, 0.0), (1, 2022, 1, 144.0, 0.0), (2, 2020, 1, 5.0, 0.0), (3, 2020, 1, 0.0, 0.0),
            (3, 2021, 1, 5.0, 0.0), (4, 2020, 1, 10.0, 0.0), (4, 2021, 1, 5.0, 0.0)]
    cagr = reps.rep_cagr(spark.createDataFrame(rows, MONTHLY))
    got = {r["sales_id"]: round(r["cagr"], 9) for r in cagr.collect()}
    assert got == {1: 0.2, 3: 0.0, 4: -0.5}
    kinds = {r["sales_id"]: r["growth_potential"] for r in reps.growth_potential(cagr).collect()}
    assert kinds == {1: "High", 3: "High", 4: "Low"}


RULE = "eur double, amount double, a double, b double, growth_potential string"


def test_capped_quota(spark):
    cases = [
        ((0.0, 0.0, 5.0, 5.0), 0.0),
        ((100.0, 100.0, 100.0, 110.0), 105.0),  # +5 %: the ensemble
        ((100.0, 100.0, 120.0, 130.0), 110.0),  # +25 %: the quota and its draw
        ((10.0, 100.0, 120.0, 130.0), 12.0),  # weak revenue wins
        ((50.0, 0.0, 5.0, 5.0), 0.0),  # no quota, positive prediction
        ((50.0, 0.0, 0.0, 0.0), 0.0),
        ((50.0, 0.0, -4.0, -2.0), -3.0),
    ]
    df = spark.createDataFrame([(i, *c[0], "High") for i, c in enumerate(cases)], "i int, " + RULE)
    got = [r["q"] for r in df.withColumn("q", rules.capped_quota(["a", "b"], (0.1, 0.2))).orderBy("i").collect()]
    assert got == pytest.approx([c[1] for c in cases])


def test_floor_quota_and_flags(spark):
    rows = [(0.0, 0.0, 9.0, 9.0, "High"), (100.0, 0.0, 9.0, 9.0, "Medium"), (100.0, 5.0, 9.0, 9.0, "Low"),
            (20000.0, 5.0, 9.0, 11.0, None)]
    df = rules.quota_flags(spark.createDataFrame(rows, RULE)).withColumn("q", rules.floor_quota(["a", "b"]))
    got = [(round(r["q"], 9), r["inactive_or_no_quota"], r["growth_adjustment_weight"]) for r in df.collect()]
    assert got == [(0.0, True, 1.4), (102.0, True, 1.2), (101.5, False, 1.0), (10.0, False, 1.0)]


def test_draws_repeat_and_stay_in_range():
    assert rules.growth_draws(7) == rules.growth_draws(7) != rules.growth_draws(8)
    assert all(0.03 <= u <= 0.08 for s in range(50) for u in rules.growth_draws(s))


def test_interval_uses_student_quantile(spark):
    rows = [(2020, float(i), float(i) + 1.0, float(i), float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "year_id int, y_true double, y_pred double, lagged_quota_std double, backlog_std double")
    got = {r["y_true"]: r for r in rules.prediction_interval(df, confidence=0.95, optimization=0.5).collect()}
    t = 2.2281388519649385  # two-sided 95 %, 10 degrees of freedom
    half = t * (1 + 1 / 11) ** 0.5
    assert got[5.0]["y_upper"] == pytest.approx(6 + half)
    assert got[5.0]["y_adjusted"] == pytest.approx(6 + half / 2)
    assert got[10.0]["y_upper"] == pytest.approx(11 + t * (1 + 1 / 11 + 25 / 110) ** 0.5 + 0.55)
    assert got[0.0]["y_lower"] == pytest.approx(1 - t * (1 + 1 / 11 + 25 / 110) ** 0.5 + 0.05)


def test_features_keep_the_quota_rows(spark, views):
    from tallycrest.plans import queries as q

    quota = q.quota_monthly(views).count()
    train = q.train_features(views)
    assert train.count() == quota
    shares = train.select(*[c for c in train.columns if c.endswith("_std")])
    ends = shares.agg(*[F.min(c).alias(f"lo_{c}") for c in shares.columns], *[F.max(c).alias(f"hi_{c}") for c in shares.columns]).first()
    assert all(0 <= v <= 1 for v in ends if v is not None)
    last = q.quota_monthly(views).agg(F.max("year_id")).first()[0]
    infer = q.infer_features(views)
    assert infer.count() == q.quota_monthly(views).filter(F.col("year_id") == last).count()
    assert {r[0] for r in infer.select("year_id").distinct().collect()} == {last + 1}


def test_codes_that_mean_one_rep_are_one_row(spark):
    rows = [(c, D(2020, 1, 5), 10.0, "Shipment") for c in ("7", "07", "7.9", "8", "GPSales", "x")]
    scores = reps.rep_month_scores(spark.createDataFrame(rows, SALE), 2018)
    late = spark.createDataFrame([("07", D(2020, 1, 9), 3.0, "Backlog")], SALE)
    assert by_key(reps.rep_month_sales(scores, late), "eur", "backlog") == {
        (7, 2020, 1): (30.0, 3.0), (8, 2020, 1): (10.0, 0.0)
    }
    assert by_key(reps.rep_month_sales(scores, late, mode="per_row"), "backlog")[7, 2020, 1] == (9.0,)


@pytest.mark.parametrize("digits", [2, 4])
def test_sums_of_whole_numbers_are_those_of_decimals(spark, digits):
    from tallycrest.functions.columns import decimal_sum, decimal_units

    values = [0.00005, 1.00005, -1.00005, 2.00015, 1.005, -2.675, 0.1, -0.1, -0.0, 1e-9, 99_999_999.99995, 1e8 + 0.00005,
              9.9e13, -9.9e13, 1234567.89015, *[k / 20000 for k in range(-3000, 3000)]]
    rows = spark.createDataFrame([(i % 5, x) for i, x in enumerate(values)] + [(9, None)], "g int, x double")
    decimal = F.col("x").cast(f"decimal(18,{digits})")
    units = rows.select(decimal_units("x", digits).alias("a"), (decimal * 10**digits).cast("long").alias("b"))
    assert units.filter("NOT a <=> b").count() == 0
    sums = rows.groupBy("g").agg(decimal_sum("x", digits).alias("a"), F.sum(decimal).cast("double").alias("b"))
    assert sums.count() == 6 and sums.filter("NOT a <=> b").count() == 0


def test_sums_past_a_long_are_whole(spark):
    from tallycrest.functions.columns import money_sum

    rows = spark.range(200_000).select(F.lit(9.9e13).alias("x"))
    assert rows.agg(money_sum("x").alias("s")).first()["s"] == 9.9e13 * 200_000
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        spark.createDataFrame([(1e15,)], "x double").agg(money_sum("x").alias("s")).collect()


def test_money_sums_hold_whole_numbers_and_scores_reduce_the_lines_once(spark, capsys):
    lines = spark.createDataFrame([("1", D(2020, 1, 5), -10.0, "Shipment"), ("1", D(2020, 1, 9), 5.0, "Backlog")], SALE)
    capsys.readouterr()
    reps.rep_month_scores(lines, 2018).explain()
    assert "ExistingRDD" not in capsys.readouterr().out  # the bins and the result read the stored months
    reps.backlog_by_rep_month(lines).explain()
    assert "partial_sum(shiftright(" in capsys.readouterr().out

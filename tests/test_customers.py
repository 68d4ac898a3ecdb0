"""Customer features on hand-made lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycrest.operators import customers as cu

D = dt.datetime
LINE = "customer_id string, order_date timestamp_ntz, eur double, qty double, egroup string, cust_country string, sector string"


def lines(spark, rows):
    full = [(*r, *("x", "c", "s")[: 7 - len(r)]) if len(r) < 7 else r for r in rows]
    return spark.createDataFrame(full, LINE)


def dates(spark, by_customer):
    rows = [(c, d, 1.0, 1.0) for c, ds in by_customer.items() for d in ds]
    return lines(spark, rows)


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_churn_rule_branches(spark):
    year = 2024
    new_year = D(2024, 1, 1)
    day = dt.timedelta(days=1)
    frame = dates(spark, {
        "one recent": [new_year - 360 * day],
        "one old": [new_year - 361 * day],
        "one recent by hours": [new_year - 360 * day - dt.timedelta(hours=1)],
        "equal dates": [new_year - 10 * day, new_year - 10 * day],
        "gap 365": [new_year - 10 * day, new_year - 375 * day],
        "gap 366": [new_year - 10 * day, new_year - 376 * day],
        "gap 365 and an hour": [new_year - 10 * day, new_year - 375 * day - dt.timedelta(hours=1)],
        "previous 480": [new_year - 200 * day, new_year - 480 * day],
        "previous 481": [new_year - 200 * day, new_year - 481 * day],
        "two times on the last day": [new_year - 500 * day, new_year - 5 * day, new_year - 5 * day + dt.timedelta(hours=3)],
        "two times, long ago": [new_year - 481 * day + dt.timedelta(hours=h) for h in (0, 5)],
        "future": [new_year + 30 * day],
    })
    assert as_dict(cu.churn_label(frame, year), "customer_id", "label") == {
        "one recent": "retain", "one old": "churn", "one recent by hours": "churn", "equal dates": "retain",
        "gap 365": "retain", "gap 366": "churn", "gap 365 and an hour": "churn", "previous 480": "retain",
        "previous 481": "churn", "two times on the last day": "retain", "two times, long ago": "churn",
        "future": "retain",
    }


def test_variability_is_sample_deviation_with_row_weighted_fill(spark):
    frame = dates(spark, {
        "a": [D(2020, 1, 1), D(2020, 1, 11), D(2020, 1, 31)],  # gaps 10, 20
        "b": [D(2020, 1, 1), D(2020, 1, 1), D(2020, 1, 3), D(2020, 1, 9)],  # gaps 0, 2, 6
        "one": [D(2020, 5, 5)],
        "two": [D(2020, 5, 5), D(2020, 6, 5)],
    })
    found = as_dict(cu.purchase_variability(frame), "customer_id", "purchase_variability")
    a, b = 50**0.5, (28 / 3) ** 0.5
    assert found["a"] == pytest.approx(a)
    assert found["b"] == pytest.approx(b)
    mean = (3 * a + 4 * b) / 7
    assert found["one"] == pytest.approx(mean) and found["two"] == pytest.approx(mean)


def test_variability_floors_partial_days(spark):
    times = [D(2020, 1, 1, 20), D(2020, 1, 2, 10), D(2020, 1, 2, 12), D(2020, 1, 4, 11), D(2020, 1, 9, 12)]
    gaps = [0, 0, 1, 5]
    mean = sum(gaps) / 4
    want = (sum((g - mean) ** 2 for g in gaps) / 3) ** 0.5
    found = as_dict(cu.purchase_variability(dates(spark, {"a": times})), "customer_id", "purchase_variability")
    assert found["a"] == pytest.approx(want)


def test_rfm_scores_and_null_customers(spark):
    rows = [(f"c{i}", D(2020, 1, 1) + dt.timedelta(days=i), float(10 * i), 1.0) for i in range(8)]
    rows += [("c7", D(2020, 1, 2), 5.0, 1.0), (None, D(2020, 1, 2), 5.0, 1.0)]
    found = {r["customer_id"]: r for r in cu.rfm(lines(spark, rows), D(2020, 2, 1)).collect()}
    assert len(found) == 8
    assert found["c7"]["recency"] == 24 and found["c7"]["frequency"] == 2 and found["c7"]["monetary"] == 75.0
    assert [found[f"c{i}"]["recency_score"] for i in range(8)] == [3, 3, 2, 2, 1, 1, 0, 0]
    assert [found[f"c{i}"]["monetary_score"] for i in range(8)] == [0, 0, 1, 1, 2, 2, 3, 3]
    # seven customers with one line and one with two: all edges but the last are equal
    assert [found[f"c{i}"]["frequency_score"] for i in range(8)] == [0] * 8
    assert found["c7"]["rfm_score"] == 3


def test_clean_sales_parses_text(spark):
    raw = spark.createDataFrame(
        [
            ("Shipment", "2020-01-02 10:00:00.000", "-5.5", "abc"),
            ("Shipment", "2018-01-02 10:00:00.000", "1", "1"),
            ("Backlog", "2020-01-02 10:00:00.000", "1", "1"),
        ],
        "tran_type string, order_date string, eur string, qty string",
    )
    row = cu.clean_sales(raw, D(2018, 12, 12)).collect()
    assert len(row) == 1
    assert (row[0]["eur"], row[0]["qty"], row[0]["order_date"]) == (5.5, None, D(2020, 1, 2, 10))


def test_bad_order_date_is_an_error(spark):
    raw = spark.createDataFrame([("Shipment", "soon", "1")], "tran_type string, order_date string, eur string")
    with pytest.raises(Exception):
        cu.clean_sales(raw, D(2018, 12, 12)).collect()


def test_opportunities(spark):
    raw = spark.createDataFrame(
        [
            ("a", "10", 50.0, "3024-05-01"), ("a", "abc", None, "unknown"), ("a", "99", 0.0, "2024-09-09"),
            ("b", None, 100.0, None), (None, "1", 1.0, "2024-01-01"),
        ],
        "erp_id string, amount string, probability double, close_date string",
    )
    found = {r["erp_id"]: (r["amount"], r["close_date"]) for r in cu.opportunity_by_account(raw).collect()}
    assert found == {"a": (10.0, dt.date(2024, 5, 1)), "b": (0.0, None)}


def test_backlog_counts_both_sources_once(spark):
    schema = "customer_id string, eur double, efftive_date timestamp_ntz"
    history = spark.createDataFrame([("a", 1.0, D(2020, 1, 1)), (None, 5.0, D(2020, 1, 1))], schema)
    current = spark.createDataFrame([("a", 2.0, D(2021, 1, 1)), ("b", -3.0, D(2021, 1, 1))], schema)
    found = {r["customer_id"]: (r["backlog"], r["backlog_date"]) for r in cu.backlog_by_customer(history, current).collect()}
    assert found == {"a": (3.0, D(2021, 1, 1)), "b": (-3.0, D(2021, 1, 1))}


def test_gate_is_strict_and_null_safe(spark):
    base = spark.createDataFrame(
        [(c, D(2020, 6, 1)) for c in ("before", "equal", "after", "no date", "none")],
        "customer_id string, order_date timestamp_ntz")
    opp = spark.createDataFrame(
        [("before", 1.0, dt.date(2020, 5, 31)), ("equal", 1.0, dt.date(2020, 6, 1)),
         ("after", 1.0, dt.date(2020, 6, 2)), ("no date", 1.0, None)],
        "erp_id string, amount double, close_date date")
    backlog = spark.createDataFrame([("before", 2.0, D(2020, 5, 31))],
                                    "customer_id string, backlog double, backlog_date timestamp_ntz")
    found = {r["customer_id"]: (r["opportunity_amt"], r["backlog"]) for r in
             cu.attach_gated_amounts(base, opp, backlog).collect()}
    assert found == {"before": (1.0, 2.0), "equal": (0.0, 0.0), "after": (0.0, 0.0), "no date": (0.0, 0.0),
                     "none": (0.0, 0.0)}


def test_sector_ignores_no_break_spaces(spark):
    base = spark.createDataFrame([("a", "X"), ("b", "X\u00a0"), ("c", "Y"), ("d", None)], "customer_id string, sector string")
    dim = spark.createDataFrame([("X\u00a0", "M", "KA")], "sector string, master_sector string, customer_type string")
    found = as_dict(cu.map_sector(base, dim), "customer_id", "customer_type")
    assert found == {"a": "KA", "b": "KA", "c": None, "d": None}


def test_attributes_come_from_the_earliest_order_and_skip_nulls(spark):
    rows = [("a", D(2020, 1, 1), 1.0, 1.0, "z", None, "s2"), ("a", D(2020, 1, 2), 1.0, 1.0, "y", "de", "s1"),
            ("a", D(2020, 1, 3), 1.0, 1.0, "y", "fr", "s1")]
    row = cu.customer_attributes(lines(spark, rows)).first()
    assert (row["egroup"], row["cust_country"], row["sector"], row["purchase_diversity"]) == ("z", "de", "s2", 2)


def test_profile_keeps_one_row_per_customer_and_agrees_with_the_parts(spark, views):
    from tallycrest.plans import queries as q

    profile = q.customer_profile(views)
    parts = q.rfm(views).join(q.churn_label(views), "customer_id").join(q.purchase_diversity(views), "customer_id")
    shared = ["customer_id", "recency", "frequency", "monetary", "rfm_score", "label", "purchase_diversity"]
    assert profile.select(*shared).exceptAll(parts.select(*shared)).count() == 0
    assert profile.count() == parts.count() == profile.select("customer_id").distinct().count()


def test_stale_customers(spark):
    base = spark.createDataFrame([("a", D(2020, 12, 31)), ("b", D(2021, 1, 1))], "customer_id string, order_date timestamp_ntz")
    assert [r[0] for r in cu.drop_stale_customers(base, D(2021, 1, 1)).collect()] == ["b"]
    assert base.filter(F.col("customer_id").isNull()).count() == 0


def test_elapsed_days_round_down(spark):
    from tallycrest.functions.columns import elapsed_days

    rows = [(D(2020, 1, 1), D(2020, 1, 2, 12)), (D(2020, 1, 1), D(2020, 1, 2)), (D(2020, 1, 3, 12), D(2020, 1, 2)), (D(2020, 1, 1), D(2020, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(elapsed_days(F.col("a"), F.col("b")).cast("int")).collect()] == [-2, -1, 1, 0]


def test_unreadable_backlog_dates_are_null(spark):
    kind = "customer_id string, eur double, efftive_date string"
    rows = [("a", 1.0, "2020-01-02 00:00:00"), ("a", 2.0, "unknown"), ("a", 4.0, "2020-03-01"), ("b", 1.0, "31/12/2020")]
    got = cu.backlog_by_customer(spark.createDataFrame(rows[:2], kind), spark.createDataFrame(rows[2:], kind)).collect()
    assert {r["customer_id"]: (r["backlog"], r["backlog_date"]) for r in got} == {"a": (7.0, D(2020, 3, 1)), "b": (1.0, None)}


def test_text_dated_backlog_joins_current_lines_to_their_orders_once(views, capsys):
    from tallycrest.plans import queries as q

    capsys.readouterr()
    q.backlog_text_dates(views).explain()
    assert capsys.readouterr().out.count("Join") == 1  # that of the historic lines

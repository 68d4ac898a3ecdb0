"""Customer features from sales lines: recency/frequency/monetary, label, variability, diversity.

Sales lines are reduced once per (customer, day). A customer then has at most one row
per calendar day, whatever its share of the lines, so the per-customer windows below
stay small; the first reduction spreads a hot customer over its days and combines
before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.functions.columns import (
    elapsed_days, fix_year, gate, money_sum, parse_date, strip_no_break_space, to_moment, to_moment_or_null, to_number,
)
from tallycrest.operators.binning import quantile_bins
from tallycrest.session import materialize

RFM_BINS = {"recency": 4, "frequency": 5, "monetary": 4}
RFM_SCORES = {"recency": "recency_score", "frequency": "frequency_score", "monetary": "monetary_score"}
ONE_DATE_LIMIT = dt.timedelta(days=360)
GAP_LIMIT = dt.timedelta(days=365)
PREVIOUS_LIMIT = dt.timedelta(days=480)


def clean_sales(lines: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Shipments ordered after ``cutoff`` with parsed dates and absolute numbers."""
    numbers = [c for c in ("eur", "us_amt", "qty") if c in lines.columns]
    moments = [c for c in ("order_date", "efftive_date") if c in lines.columns]
    cleaned = lines.withColumns(
        {c: to_moment(lines, c) for c in moments}
        | {c: F.abs(to_number(c)) if c != "us_amt" else to_number(c) for c in numbers}
    )
    return cleaned.filter((F.col("tran_type") == "Shipment") & (F.col("order_date") > F.lit(cutoff)))


def rfm_scores(customers: DataFrame, weights: tuple[float, float, float] = (1, 1, 1)) -> DataFrame:
    """Add bins and the combined score to recency, frequency and monetary."""
    r, f, m = weights
    binned = quantile_bins(customers, RFM_BINS, RFM_SCORES)
    return binned.withColumn(
        "rfm_score", -F.col("recency_score") * r + F.col("frequency_score") * f + F.col("monetary_score") * m
    )


def rfm(lines: DataFrame, as_of: dt.datetime, weights: tuple[float, float, float] = (1, 1, 1)) -> DataFrame:
    """Recency, frequency and monetary value per customer with their bins and score."""
    customers = (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("order_date"),
            F.count("order_date").alias("frequency"),
            money_sum("eur").alias("monetary"),
        )
        .select(
            "customer_id",
            "order_date",
            elapsed_days(F.lit(as_of), F.col("order_date")).cast("int").alias("recency"),
            "frequency",
            "monetary",
        )
    )
    return rfm_scores(customers, weights)


def customer_days(lines: DataFrame) -> DataFrame:
    """Lines reduced to one row per customer and order day."""
    return (
        lines.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("customer_id", F.to_date("order_date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
            *([money_sum("eur").alias("eur")] if "eur" in lines.columns else []),
            *([money_sum("qty").alias("qty")] if "qty" in lines.columns else []),
        )
    )


def _with_previous_day(days: DataFrame) -> DataFrame:
    """Last order of the customer's preceding order day, and whole days since then.

    Gaps between orders of one day are 0 whole days, so these are all the gaps that count.
    """
    by_day = Window.partitionBy("customer_id").orderBy("day")
    seen = days.withColumn("before", F.lag("last_order").over(by_day))
    return seen.withColumn("gap", elapsed_days(F.col("first_order"), F.col("before")).cast("long"))


def _deviation_of_gaps() -> Column:
    """Sample deviation of the order gaps from whole-number sums."""
    gaps = F.sum("lines") - 1
    total = F.coalesce(F.sum("gap"), F.lit(0)).cast("double")
    squares = F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).cast("double")
    return F.when(gaps > 1, F.sqrt((squares - total * total / gaps) / (gaps - 1)))


def _previous_order() -> Column:
    """An order before the last one: of the same day if it has two times, else of the day before.

    Within a day any order serves, since the label compares whole days from midnight
    limits; null if all orders bear one timestamp.
    """
    candidate = F.when(F.col("first_order") < F.col("last_order"), F.col("first_order")).otherwise(F.col("before"))
    return F.max_by(candidate, "day")


def churn_case(last: Column, previous: Column, current_year: int) -> Column:
    new_year = F.lit(dt.datetime(current_year, 1, 1))
    return (
        F.when(
            previous.isNull(),
            F.when(new_year - last <= F.lit(ONE_DATE_LIMIT), "retain").otherwise("churn"),
        )
        .when(last - previous > F.lit(GAP_LIMIT), "churn")
        .when(new_year - previous > F.lit(PREVIOUS_LIMIT), "churn")
        .otherwise("retain")
    )


def churn_label(lines: DataFrame, current_year: int) -> DataFrame:
    """``churn`` or ``retain`` per customer, from its last two distinct order times."""
    dates = lines.select("customer_id", "order_date")
    last_two = (
        _with_previous_day(customer_days(dates))
        .groupBy("customer_id")
        .agg(F.max("last_order").alias("last"), _previous_order().alias("previous"))
    )
    return last_two.select(
        "customer_id", churn_case(F.col("last"), F.col("previous"), current_year).alias("label")
    )


def fill_variability(customers: DataFrame) -> DataFrame:
    """Replace a null deviation by the mean over sales lines."""
    known = F.when(F.col("purchase_variability").isNotNull(), F.col("frequency"))
    mean = customers.agg(
        F.try_divide(F.sum(F.col("purchase_variability") * known), F.sum(known))
    ).scalar()
    return customers.withColumn("purchase_variability", F.coalesce("purchase_variability", mean))


def purchase_variability(lines: DataFrame) -> DataFrame:
    """Deviation of the days between a customer's orders."""
    days = _with_previous_day(customer_days(lines.select("customer_id", "order_date")))
    deviations = days.groupBy("customer_id").agg(
        F.sum("lines").alias("frequency"), _deviation_of_gaps().alias("purchase_variability")
    )
    return fill_variability(deviations).select("customer_id", "purchase_variability")


def purchase_diversity(lines: DataFrame) -> DataFrame:
    """Number of product groups a customer bought from."""
    return (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.countDistinct("egroup").alias("purchase_diversity"))
    )


def customer_attributes(lines: DataFrame) -> DataFrame:
    """Diversity, and country, sector and product group of the earliest order of each customer."""
    kinds = ["egroup", "cust_country", "sector"]
    seen = (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", *kinds)
        .agg(F.min("order_date").alias("since"))
    )

    def earliest(name: str) -> Column:
        pair = F.when(F.col(name).isNotNull(), F.struct("since", name))
        return F.min(pair).getField(name).alias(name)

    return seen.groupBy("customer_id").agg(
        F.countDistinct("egroup").alias("purchase_diversity"), *[earliest(k) for k in kinds]
    )


def customer_profile(lines: DataFrame, as_of: dt.datetime, current_year: int) -> DataFrame:
    """One row per customer: scores, label, variability, diversity and attributes.

    The totals are written once: the mean, the bins and the result all read them, and
    one small table is cheaper than repeating the per-customer windows for each.
    """
    totals = (
        _with_previous_day(customer_days(lines))
        .groupBy("customer_id")
        .agg(
            F.max("last_order").alias("order_date"),
            _previous_order().alias("previous"),
            F.sum("lines").alias("frequency"),
            money_sum("eur").alias("monetary"),
            money_sum("qty").alias("qty"),
            _deviation_of_gaps().alias("purchase_variability"),
        )
        .withColumns(
            {
                "recency": elapsed_days(F.lit(as_of), F.col("order_date")).cast("int"),
                "label": churn_case(F.col("order_date"), F.col("previous"), current_year),
            }
        )
        .drop("previous")
    )
    scored = rfm_scores(fill_variability(materialize(totals, "customer-totals")))
    return scored.join(customer_attributes(lines), "customer_id").select(
        "customer_id", "cust_country", "recency", "frequency", "monetary", "recency_score", "frequency_score",
        "monetary_score", "rfm_score", "qty", "egroup", "order_date", "sector", "purchase_variability",
        "purchase_diversity", "label",
    )


def drop_stale_customers(customers: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Keep customers whose last order is not before ``cutoff``."""
    return customers.filter(F.col("order_date") >= F.lit(cutoff))


def opportunity_by_account(opportunities: DataFrame) -> DataFrame:
    """Amount and latest close date of the live opportunities of each account.

    A missing probability counts as live; only 0 is dropped.
    """
    return (
        opportunities.filter(F.col("erp_id").isNotNull() & ~F.col("probability").eqNullSafe(F.lit(0.0)))
        .groupBy("erp_id")
        .agg(
            money_sum(to_number("amount")).alias("amount"),
            F.max(parse_date(fix_year("close_date"))).alias("close_date"),
        )
    )


def backlog_by_customer(history: DataFrame, current: DataFrame) -> DataFrame:
    """Backlog amount and latest date per customer over historic and current lines.

    Dates may be text; one that cannot be read is null and never the latest.
    """

    def dated(lines: DataFrame) -> DataFrame:
        return lines.select("customer_id", "eur", to_moment_or_null(lines, "efftive_date").alias("efftive_date"))

    return (
        dated(history)
        .unionByName(dated(current))
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(money_sum("eur").alias("backlog"), F.max("efftive_date").alias("backlog_date"))
    )


def attach_gated_amounts(customers: DataFrame, opportunities: DataFrame, backlog: DataFrame) -> DataFrame:
    """Add the amounts that were known before each customer's last order, else 0."""
    opp = opportunities.select(
        F.col("erp_id").alias("customer_id"), "amount", "close_date"
    )
    return (
        customers.join(opp, "customer_id", "left")
        .join(backlog, "customer_id", "left")
        .withColumns(
            {
                "opportunity_amt": gate("amount", F.col("close_date").cast("timestamp_ntz"), "order_date"),
                "backlog": gate("backlog", "backlog_date", "order_date"),
            }
        )
        .drop("amount", "close_date", "backlog_date")
    )


def map_sector(customers: DataFrame, sectors: DataFrame) -> DataFrame:
    """Replace the sector by its master sector and account type; unknown sectors give null."""
    names = sectors.withColumn("sector", strip_no_break_space("sector"))
    keyed = customers.withColumn("sector", strip_no_break_space("sector"))
    return keyed.join(names, "sector", "left").drop("sector")

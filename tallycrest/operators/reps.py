"""Sales-rep features: monthly sales and scores, quota, win rates, growth, lags, interpolation.

Everything per rep is first reduced to one row per rep and month, so the per-rep
windows below hold at most one row per calendar month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.functions.columns import is_text, money_sum, month_number, rep_number, to_moment, to_number
from tallycrest.operators.binning import quantile_bins
from tallycrest.operators.ranking import attach_row, quantile_row
from tallycrest.session import materialize

KEYS = ["sales_id", "year_id", "month"]
HOUSE_ACCOUNT = "GPSales"
FIRST_OPEN_MONTH = 8


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Add ``year_id`` and ``month`` from a date column."""
    moment = to_moment(df, date)
    return df.withColumns({"year_id": F.year(moment), "month": F.month(moment)})


def after_year(df: DataFrame, date: str, year: int) -> DataFrame:
    """Rows dated after ``year``, as a range that a scan can skip by."""
    return df.filter(to_moment(df, date) >= F.lit(dt.datetime(year + 1, 1, 1)))


def rep_month_scores(lines: DataFrame, min_year: int, bins: int = 5) -> DataFrame:
    """Line count and amount per rep and month over all transaction types, with their bins.

    The shipped part is summed in the same pass (``eur``, ``shipments``). The months are written once: the
    bins read them twice, of other columns than the result, and would reduce the lines again.
    """
    shipped = F.col("tran_type") == "Shipment"
    months = (
        by_month(after_year(lines, "efftive_date", min_year), "efftive_date")
        .filter(F.col("sales_id").isNotNull())
        .withColumn("eur", F.abs(to_number("eur")))
        .groupBy(*KEYS)
        .agg(
            F.count("efftive_date").alias("lines"),
            money_sum("eur").alias("total"),
            F.count_if(shipped).alias("shipments"),
            money_sum(F.when(shipped, F.col("eur"))).alias("eur"),
        )
    )
    stored = materialize(months, "rep-months")
    return quantile_bins(stored, {"lines": bins, "total": bins}, {"lines": "frequency", "total": "monetary"})


def numeric_reps(df: DataFrame) -> DataFrame:
    """Leave out the house account and codes that are no numbers."""
    if not is_text(df, "sales_id"):
        return df
    named = df.filter(F.col("sales_id") != HOUSE_ACCOUNT)
    return named.withColumn("sales_id", rep_number(named, "sales_id")).filter(F.col("sales_id").isNotNull())


def backlog_by_rep_month(backlog: DataFrame) -> DataFrame:
    return (
        by_month(numeric_reps(backlog), "efftive_date")
        .filter(F.col("sales_id").isNotNull())
        .groupBy(*KEYS)
        .agg(money_sum("eur").alias("backlog"))
    )


def rep_month_sales(scores: DataFrame, backlog: DataFrame, mode: str = "once") -> DataFrame:
    """Shipped amount, bins and backlog per rep and month.

    ``mode="per_row"`` counts the month's backlog once per shipped line instead of once.
    """
    shipped = numeric_reps(scores).filter(F.col("shipments") > 0)
    if is_text(scores, "sales_id"):
        # codes such as 7 and 07 are one rep: amounts add up, the lowest bin stands, backlog counts once
        shipped = shipped.groupBy(*KEYS).agg(
            money_sum("eur").alias("eur"),
            F.sum("shipments").alias("shipments"),
            F.min("monetary").alias("monetary"),
            F.min("frequency").alias("frequency"),
        )
    times = F.col("shipments") if mode == "per_row" else F.lit(1)
    return shipped.join(backlog_by_rep_month(backlog), KEYS, "left").select(
        *KEYS, "eur", "monetary", "frequency", F.coalesce(F.col("backlog") * times, F.lit(0.0)).alias("backlog")
    )


def quota_monthly(quota: DataFrame) -> DataFrame:
    """Quota per rep, year and month number, in full currency units."""
    month = quota.withColumns(
        {
            "month": month_number("month"),
            "sales_id": F.col("sales_id").cast("long"),
            "amount": to_number("amount") * 1000,
        }
    )
    return (
        month.dropna(subset=KEYS)
        .groupBy(*KEYS)
        .agg(
            money_sum("amount").alias("amount"),
            F.min("master_sector").alias("master_sector"),
            F.min("fact_entity").alias("fact_entity"),
            F.max("sales_name").alias("sales_name"),
        )
    )


def quota_vs_sales(quota: DataFrame, sales: DataFrame) -> DataFrame:
    """Every quota row with that month's sales, null where there were none."""
    return quota.join(sales, KEYS, "left")


def fill_by_rep_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the rep's mean of the column."""
    rep = Window.partitionBy("sales_id")
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.avg(c).over(rep)) for c in columns})


def add_spread(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the rep's quota on every row."""
    rep = Window.partitionBy("sales_id")
    return df.withColumns(
        {"historical_mean": F.avg("amount").over(rep), "spread": F.stddev_samp("amount").over(rep)}
    )


def quota_spread(quota: DataFrame) -> DataFrame:
    return quota.groupBy("sales_id").agg(
        F.avg("amount").alias("historical_mean"), F.stddev_samp("amount").alias("spread")
    )


def leads_by_rep_month(opportunities: DataFrame) -> DataFrame:
    """Leads, full and partial win rate in percent, and amount per rep and month of creation."""
    probability = to_number("probability")
    return (
        by_month(opportunities.withColumn("sales_id", rep_number(opportunities, "sales_code_text")), "created_date")
        .dropna(subset=["sales_id"])
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("leads"),
            (F.count_if(probability == 100) * 100.0 / F.count(F.lit(1))).alias("win_rate"),
            (F.count_if(probability >= 75) * 100.0 / F.count(F.lit(1))).alias("partial_win_rate"),
            money_sum(to_number("amount")).alias("opportunity_amount"),
        )
    )


def rep_win_rate(quota: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Win rates of the months for which the rep has a quota."""
    return quota.select(*KEYS).join(leads_by_rep_month(opportunities), KEYS)


def rep_cagr(sales: DataFrame) -> DataFrame:
    """Compound yearly growth between a rep's first and last year; reps with one year are left out."""
    years = sales.groupBy("sales_id", "year_id").agg(money_sum("eur").alias("eur"))
    ends = years.groupBy("sales_id").agg(
        F.min_by("eur", "year_id").alias("first"),
        F.max_by("eur", "year_id").alias("last"),
        (F.max("year_id") - F.min("year_id")).alias("span"),
    )
    growth = F.pow(F.try_divide("last", "first"), F.try_divide(F.lit(1.0), F.col("span"))) - 1
    return ends.filter(F.col("span") > 0).select(
        "sales_id", F.when(F.col("first") > 0, growth).otherwise(0.0).alias("cagr")
    )


def growth_potential(cagr: DataFrame) -> DataFrame:
    """High from the median up, Medium from the first quartile up, else Low."""
    q = F.col("_q")["cagr"]
    known = attach_row(cagr, quantile_row(cagr, {"cagr": [0.25, 0.5]}), "_q")
    return known.withColumn(
        "growth_potential",
        F.when(F.col("cagr") >= q[1], "High").when(F.col("cagr") >= q[0], "Medium").otherwise("Low"),
    ).drop("_q")


def month_index() -> Column:
    return F.col("year_id") * 12 + F.col("month")


def lag_year(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Value of the same month one year earlier, null if the rep has no such month."""
    before = Window.partitionBy("sales_id").orderBy(month_index()).rangeBetween(-12, -12)
    return df.withColumns({name: F.max(c).over(before) for c, name in columns.items()})


def lag_rows(df: DataFrame, columns: dict[str, str], filled_year: int) -> DataFrame:
    """Value 12 rows back among the rep's present months; ``filled_year`` counts all its months."""
    present = df.withColumn("_filler", F.lit(False))
    grid = (
        df.filter(F.col("year_id") == filled_year)
        .select("sales_id", "year_id")
        .distinct()
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    )
    fillers = grid.join(df, KEYS, "left_anti").withColumn("_filler", F.lit(True))
    rows = Window.partitionBy("sales_id").orderBy("year_id", "month")
    return (
        present.unionByName(fillers, allowMissingColumns=True)
        .withColumns({name: F.lag(c, 12).over(rows) for c, name in columns.items()})
        .filter(~F.col("_filler"))
        .drop("_filler")
    )


def interpolate_open_months(df: DataFrame, scope: str = "open_year") -> DataFrame:
    """Fill missing revenue: 0 before August, from August on a line between the known rows.

    Months of the last year from August on are still open, so their revenue is replaced
    too; ``scope="all"`` replaces those months in every year. Positions are row numbers
    per rep, and the ends are flat.
    """
    late = F.col("month") >= FIRST_OPEN_MONTH
    if scope == "open_year":
        df = attach_row(df, df.agg(F.max("year_id").alias("year")), "_last")
        replaced = late & (F.col("year_id") == F.col("_last")["year"])
    else:
        df, replaced = df.withColumn("_last", F.lit(None)), late
    by_time = Window.partitionBy("sales_id").orderBy("year_id", "month")
    known = F.when(replaced, None).when(~late, F.coalesce("eur", F.lit(0.0))).otherwise(F.col("eur"))
    placed = df.withColumns({"_known": known, "_at": F.row_number().over(by_time)})
    point = F.when(F.col("_known").isNotNull(), F.struct(F.col("_at").alias("at"), F.col("_known").alias("eur")))
    left = F.last(point, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    right = F.first(point, ignorenulls=True).over(by_time.rowsBetween(0, Window.unboundedFollowing))
    sides = placed.withColumns({"_left": left, "_right": right})
    lo, hi = F.col("_left"), F.col("_right")
    line = lo["eur"] + (hi["eur"] - lo["eur"]) * (F.col("_at") - lo["at"]) / (hi["at"] - lo["at"])
    filled = (
        F.when(F.col("_known").isNotNull(), F.col("_known"))
        .when(hi.isNull(), lo["eur"])
        .when(lo.isNull(), hi["eur"])
        .otherwise(line)
    )
    return sides.withColumn("eur", filled).drop("_known", "_at", "_left", "_right", "_last")

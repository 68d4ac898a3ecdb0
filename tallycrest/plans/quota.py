"""The quota pipeline: training and inference features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycrest.operators import reps
from tallycrest.operators.binning import one_hot
from tallycrest.operators.ranking import attach_row
from tallycrest.operators.scaling import minmax
from tallycrest.session import materialize

LAGS = {
    "eur": "lagged_eur", "amount": "lagged_quota", "monetary": "lagged_monetary", "frequency": "lagged_frequency",
    "opportunity_amount": "lagged_opportunity_amount", "partial_win_rate": "lagged_partial_win_rate",
}
TRAIN_SCALED = [
    "monetary", "spread", "backlog", "historical_mean", "frequency", "lagged_eur", "lagged_quota",
    "lagged_monetary", "lagged_frequency",
]
# This year's figures are next year's lagged features.
INFER_SCALED = {
    "eur": "lagged_eur_std", "amount": "lagged_quota_std", "monetary": "lagged_monetary_std",
    "frequency": "lagged_frequency_std", "spread": "spread_std", "historical_mean": "historical_mean_std",
    "backlog": "backlog_std",
}


def train_features(
    quota: DataFrame, sales: DataFrame, opportunities: DataFrame, sectors: Sequence[str]
) -> DataFrame:
    """Monthly quota rows with lagged, scaled and one-hot features.

    ``quota`` and ``sales`` are monthly (``quota_monthly``, ``rep_month_sales``). The
    joins share their keys and the windows share the rep, so rows move twice.
    """
    base = reps.quota_vs_sales(quota, sales).join(reps.leads_by_rep_month(opportunities), reps.KEYS, "left")
    filled = reps.fill_by_rep_mean(base, ["eur", "monetary", "frequency"])
    lagged = reps.add_spread(reps.lag_year(filled, LAGS))
    features = lagged.drop("eur", "fact_entity", "sales_name", "leads", "opportunity_amount").fillna(0)
    # scaling reads its input twice: for the ranges and for the rows
    rows = materialize(one_hot(features, "master_sector", sectors).drop("master_sector"), "train-features")
    # a column of one value has no scale; its share counts as 0
    return minmax(rows, TRAIN_SCALED).fillna(0)


def infer_features(
    quota: DataFrame,
    sales: DataFrame,
    opportunities: DataFrame,
    future_backlog: DataFrame,
    sectors: Sequence[str],
    min_year: int,
) -> DataFrame:
    """The last year's rows moved to the next year, with the features the models expect."""
    base = reps.interpolate_open_months(reps.quota_vs_sales(quota, sales).drop("backlog"))
    filled = reps.add_spread(reps.fill_by_rep_mean(base, ["monetary", "frequency"]))
    leads = reps.leads_by_rep_month(opportunities).select(*reps.KEYS, "partial_win_rate")
    growth = reps.growth_potential(reps.rep_cagr(sales))
    last = attach_row(filled, quota.agg(F.max("year_id").alias("year")), "_last").filter(
        F.col("year_id") == F.col("_last")["year"]
    )
    known = (
        last.drop("_last")
        .join(leads, reps.KEYS, "left")
        .join(growth, "sales_id", "left")
        .fillna("Low", ["growth_potential"])
        .fillna(0)
        .withColumn("year_id", F.col("year_id") + 1)
    )
    ahead = (
        reps.after_year(future_backlog, "efftive_date", min_year)
        .filter(F.col("tran_type") == "Backlog")
        .withColumn("eur", F.abs("eur"))
    )
    with_backlog = known.join(reps.backlog_by_rep_month(ahead), reps.KEYS, "left")
    scaled = minmax(materialize(with_backlog, "infer-features"), list(INFER_SCALED), "_scaled")
    named = scaled.withColumnsRenamed({f"{c}_scaled": name for c, name in INFER_SCALED.items()})
    flagged = one_hot(named, "master_sector", sectors)
    return flagged.drop("monetary", "frequency", "historical_mean", "spread", "partial_win_rate", "backlog").fillna(0)

"""One named query per operator, run on the views over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.functions.columns import argmax_name, money_sum
from tallycrest.operators import binning, distances, evaluate, explore, folds, neighbours, scaling, sketches
from tallycrest.operators import customers as cu
from tallycrest.operators import quota_rules as rules
from tallycrest.operators import reps
from tallycrest.plans import models, retention
from tallycrest.plans import quota as quota_plan
from tallycrest.session import scratch_dir
from tallycrest.sources import sinks, tables
from tallycrest.sources.testviews import CUSTOMER_TYPES, MASTER_SECTORS, TestViews

AS_OF = dt.datetime(2002, 1, 1)
CURRENT_YEAR = 2002
CUTOFF = dt.datetime(1996, 1, 1)
STALE_CUTOFF = dt.datetime(2001, 6, 1)
HISTORY_END = dt.datetime(1999, 1, 1)
MIN_YEAR = 1995
MODELS = ["with_backlog", "without_backlog"]
DRAWS = (0.05, 0.04)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[TestViews], DataFrame]) -> Callable[[TestViews], DataFrame]:
    """Register a function of the views under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(TestViews(spark, folder))

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def shipments(v: TestViews, *columns: str) -> DataFrame:
    names = dict.fromkeys([*columns, "tran_type", "order_date"])
    return cu.clean_sales(v.sales(list(names), only="Shipment"), CUTOFF)


# --- sources and customer features -------------------------------------------------


@query
def scan_sales(v: TestViews) -> DataFrame:
    return v.sales()


@query
def scan_backlog_topn(v: TestViews) -> DataFrame:
    return tables.first_rows(v.backlog_history(), 1000, ["efftive_date", "customer_id", "sales_id", "eur"])


@query
def clean_sales(v: TestViews) -> DataFrame:
    lines = shipments(v, "customer_id", "order_no", "line_no", "order_date", "efftive_date", "qty", "eur")
    return lines.drop("tran_type")


@query
def customer_revenue(v: TestViews) -> DataFrame:
    return tables.revenue_by_customer(v.sales(["customer_id", "eur"]))


@query
def rfm(v: TestViews) -> DataFrame:
    return cu.rfm(shipments(v, "customer_id", "eur"), AS_OF)


@query
def drop_stale_customers(v: TestViews) -> DataFrame:
    last = shipments(v, "customer_id").groupBy("customer_id").agg(F.max("order_date").alias("order_date"))
    return cu.drop_stale_customers(last, STALE_CUTOFF)


@query
def churn_label(v: TestViews) -> DataFrame:
    return cu.churn_label(shipments(v, "customer_id"), CURRENT_YEAR)


@query
def purchase_variability(v: TestViews) -> DataFrame:
    return rounded(cu.purchase_variability(shipments(v, "customer_id")), 6, "purchase_variability")


@query
def purchase_diversity(v: TestViews) -> DataFrame:
    return cu.purchase_diversity(shipments(v, "customer_id", "egroup"))


@query
def purchase_diversity_merged(v: TestViews) -> DataFrame:
    """Product groups per customer from states kept by customer and month."""
    lines = shipments(v, "customer_id", "egroup").filter(F.col("customer_id").isNotNull())
    monthly = lines.withColumn("month", F.trunc("order_date", "MM"))
    states = v.stored("group-states", lambda: sketches.distinct_states(monthly, "egroup", ["customer_id", "month"]))
    return sketches.merged_distinct(states, ["customer_id"], "purchase_diversity")


@query
def opportunity_by_account(v: TestViews) -> DataFrame:
    return cu.opportunity_by_account(v.opportunity())


@query
def backlog_by_customer(v: TestViews) -> DataFrame:
    return cu.backlog_by_customer(v.backlog_history(), v.backlog_current())


@query
def backlog_text_dates(v: TestViews) -> DataFrame:
    """Backlog whose dates are text, some of it unreadable."""

    def spelled(lines: DataFrame) -> DataFrame:
        return lines.withColumn("efftive_date", F.date_format("efftive_date", "yyyy-MM-dd HH:mm:ss"))

    # joined to their orders once: each further join in the union would share the tasks with the others
    current = v.stored("backlog-current", v.backlog_current)
    unread = current.withColumn("efftive_date", F.lit("unknown")).withColumn("eur", F.lit(0.0))
    return cu.backlog_by_customer(spelled(v.backlog_history()), spelled(current).unionByName(unread))


@query
def gated_amounts(v: TestViews) -> DataFrame:
    last = shipments(v, "customer_id").groupBy("customer_id").agg(F.max("order_date").alias("order_date"))
    return cu.attach_gated_amounts(last, opportunity_by_account(v), backlog_by_customer(v))


@query
def map_sector(v: TestViews) -> DataFrame:
    return cu.map_sector(v.customers().select("customer_id", "sector"), v.sector_map())


def _profile(v: TestViews) -> DataFrame:
    lines = shipments(v, "customer_id", "egroup", "qty", "eur", "cust_country", "sector")
    return cu.customer_profile(lines, AS_OF, CURRENT_YEAR)


def _features(v: TestViews) -> DataFrame:
    columns = ["customer_id", "tran_type", "order_date", "egroup", "qty", "eur", "cust_country", "sector"]
    return retention.customer_features(
        v.sales(columns, only="Shipment"), v.opportunity(), v.backlog_history(), v.backlog_current(),
        v.sector_map(), AS_OF, CURRENT_YEAR, CUTOFF,
    )


@query
def customer_profile(v: TestViews) -> DataFrame:
    return rounded(_profile(v), 6, "purchase_variability")


@query
def customer_features(v: TestViews) -> DataFrame:
    return rounded(_features(v), 6, "purchase_variability")


# --- rep features ------------------------------------------------------------------


def _scores(v: TestViews) -> DataFrame:
    return reps.rep_month_scores(v.sales(["sales_id", "efftive_date", "eur", "tran_type"]), MIN_YEAR)


def _rep_backlog(v: TestViews) -> DataFrame:
    return v.sales(["sales_id", "eur", "efftive_date"], only="Backlog").filter(
        F.col("efftive_date") < F.lit(HISTORY_END)
    )


def _monthly_sales(v: TestViews) -> DataFrame:
    return reps.rep_month_sales(_scores(v), _rep_backlog(v))


def _quota_sales(v: TestViews) -> DataFrame:
    return reps.quota_vs_sales(quota_monthly(v), _monthly_sales(v))


def _filled(v: TestViews) -> DataFrame:
    return reps.fill_by_rep_mean(_quota_sales(v), ["eur", "monetary", "frequency"])


@query
def rep_month_scores(v: TestViews) -> DataFrame:
    return _scores(v).select(*reps.KEYS, "lines", "total", "frequency", "monetary")


@query
def rep_month_sales(v: TestViews) -> DataFrame:
    return _monthly_sales(v)


@query
def rep_month_sales_text(v: TestViews) -> DataFrame:
    """Rep codes as text with a leading zero, and the house account."""

    def spelled(lines: DataFrame) -> DataFrame:
        return lines.withColumn("sales_id", F.concat(F.lit("0"), F.col("sales_id").cast("string")))

    scores = spelled(_scores(v))
    house = scores.withColumn("sales_id", F.lit(reps.HOUSE_ACCOUNT))
    return reps.rep_month_sales(scores.unionByName(house), spelled(_rep_backlog(v)))


@query
def rep_month_sales_per_row(v: TestViews) -> DataFrame:
    return reps.rep_month_sales(_scores(v), _rep_backlog(v), mode="per_row")


@query
def quota_monthly(v: TestViews) -> DataFrame:
    return reps.quota_monthly(v.quota())


@query
def quota_vs_sales(v: TestViews) -> DataFrame:
    return _quota_sales(v).select(*reps.KEYS, "amount", "eur", "backlog")


@query
def group_mean_fill(v: TestViews) -> DataFrame:
    filled = _filled(v).select(*reps.KEYS, "eur", "monetary", "frequency")
    return rounded(rounded(filled, 6, "eur"), 6, "monetary", "frequency")


@query
def quota_spread(v: TestViews) -> DataFrame:
    return rounded(reps.quota_spread(quota_monthly(v)), 5, "historical_mean", "spread")


@query
def rep_win_rate(v: TestViews) -> DataFrame:
    return reps.rep_win_rate(quota_monthly(v), v.opportunity())


@query
def rep_cagr(v: TestViews) -> DataFrame:
    return rounded(reps.rep_cagr(_monthly_sales(v)), 8, "cagr")


@query
def growth_potential(v: TestViews) -> DataFrame:
    return rounded(reps.growth_potential(reps.rep_cagr(_monthly_sales(v))), 8, "cagr")


@query
def quota_lag12(v: TestViews) -> DataFrame:
    lags = {"eur": "lagged_eur", "amount": "lagged_quota", "monetary": "lagged_monetary",
            "frequency": "lagged_frequency"}
    lagged = reps.lag_year(_filled(v), lags).select(*reps.KEYS, *lags.values())
    return rounded(rounded(lagged, 6, "lagged_eur"), 6, "lagged_monetary", "lagged_frequency")


@query
def fill_interpolate_eur(v: TestViews) -> DataFrame:
    return rounded(reps.interpolate_open_months(_quota_sales(v)).select(*reps.KEYS, "eur"), 6, "eur")


@query
def fill_interpolate_all(v: TestViews) -> DataFrame:
    return rounded(reps.interpolate_open_months(_quota_sales(v), scope="all").select(*reps.KEYS, "eur"), 6, "eur")


@query
def quota_lag_rows(v: TestViews) -> DataFrame:
    """Lag by rows that are there; the first year's missing months are filled in."""
    lagged = reps.lag_rows(quota_monthly(v), {"amount": "lagged_quota"}, YEARS[0])
    return lagged.select(*reps.KEYS, "lagged_quota")


def _stored_quota(v: TestViews) -> DataFrame:
    return v.stored("quota-monthly", lambda: quota_monthly(v))


def _stored_sales(v: TestViews) -> DataFrame:
    return v.stored("rep-month-sales", lambda: _monthly_sales(v))


def _train(v: TestViews) -> DataFrame:
    return quota_plan.train_features(_stored_quota(v), _stored_sales(v), v.opportunity(), MASTER_SECTORS)


def _infer(v: TestViews) -> DataFrame:
    return quota_plan.infer_features(
        _stored_quota(v), _stored_sales(v), v.opportunity(), v.future_backlog(), MASTER_SECTORS, MIN_YEAR
    )


@query
def train_features(v: TestViews) -> DataFrame:
    shares = [f"{c}_std" for c in quota_plan.TRAIN_SCALED]
    rates = ["monetary", "frequency", "lagged_monetary", "lagged_frequency", "win_rate", "partial_win_rate",
             "lagged_partial_win_rate"]
    return rounded(rounded(_train(v), 6, *shares, *rates), 5, "historical_mean", "spread", "lagged_eur")


@query
def infer_features(v: TestViews) -> DataFrame:
    return rounded(rounded(_infer(v), 6, "cagr", *quota_plan.INFER_SCALED.values()), 2, "eur")


# --- quota rules -------------------------------------------------------------------


def _modelled(v: TestViews) -> DataFrame:
    """Quota rows with two made-up model outputs that reach every branch of the rules."""
    rows = _quota_sales(v).withColumns(
        {
            "amount": F.when(F.col("month") == 5, 0.0).otherwise(F.col("amount")),
            "eur": F.coalesce(
                F.when(F.col("sales_id") % 3 == 0, F.col("eur") / 1000).otherwise(F.col("eur")), F.lit(0.0)
            ),
            "growth_potential": F.when(F.col("sales_id") % 4 == 0, "High")
            .when(F.col("sales_id") % 4 == 1, "Medium").otherwise("Low"),
        }
    )
    base = F.when(F.col("month") == 7, 0.0).otherwise(F.col("amount"))
    code = F.col("sales_id") + F.col("month")
    return rows.withColumns(
        {
            "with_backlog": base * (1 + (code % 13 - 6) / F.lit(20.0)),
            "without_backlog": base * (1 + (code % 7 - 3) / F.lit(10.0)),
        }
    )


def _capped(v: TestViews) -> DataFrame:
    return rules.quota_flags(_modelled(v)).withColumn("predicted_quota", rules.capped_quota(MODELS, DRAWS))


@query
def quota_rules(v: TestViews) -> DataFrame:
    flagged = _capped(v).select(
        *reps.KEYS, "predicted_quota", "inactive_or_no_quota", "growth_adjustment_weight"
    )
    return rounded(flagged, 6, "predicted_quota")


@query
def quota_rules_v1(v: TestViews) -> DataFrame:
    return _modelled(v).select(*reps.KEYS, F.round(rules.floor_quota(MODELS), 8).alias("predicted_quota"))


@query
def ensemble_mean(v: TestViews) -> DataFrame:
    return _modelled(v).select(
        *reps.KEYS,
        F.round(rules.ensemble_mean(MODELS), 6).alias("mean"),
        F.round(rules.ensemble_mean(MODELS, zero_inactive=True), 6).alias("mean_active"),
    )


@query
def quota_totals(v: TestViews) -> DataFrame:
    return rounded(rules.quota_totals(_capped(v)), 0, "predicted_quota", "revenue", "quota")


def _forecasts(v: TestViews) -> DataFrame:
    error = ((F.col("sales_id") + F.col("month")) % 13 - 6) / F.lit(9.7)
    return _stored_quota(v).select(
        *reps.KEYS, F.col("amount").alias("y_true"), (F.col("amount") * (1 + error)).alias("y_pred")
    )


@query
def prediction_interval(v: TestViews) -> DataFrame:
    features = _train(v).select(*reps.KEYS, "lagged_quota_std", "backlog_std")
    banded = rules.prediction_interval(_forecasts(v).join(features, reps.KEYS), t_value=0.32)
    return rounded(banded.select(*reps.KEYS, "y_upper", "y_lower", "y_adjusted"), 2,
                   "y_upper", "y_lower", "y_adjusted")


# --- preprocessing -----------------------------------------------------------------


def _rfm(v: TestViews) -> DataFrame:
    """Recency, frequency, monetary and quantity per customer, without scores."""
    return (
        shipments(v, "customer_id", "eur", "qty")
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("order_date"),
            F.count("order_date").alias("frequency"),
            money_sum("eur").alias("monetary"),
            money_sum("qty").alias("qty"),
        )
        .withColumn("recency", F.datediff(F.lit(AS_OF), "order_date"))
    )


@query
def rfm_approx(v: TestViews) -> DataFrame:
    """Edges of the score bins from states kept by month of the last order, held against the exact ranks:
    ``within`` is true if the edge's rank is no further off than ``sketches.rank_error``."""
    rows = v.stored("rfm-customers", lambda: _rfm(v).withColumn("month", F.trunc("order_date", "MM")))
    columns = list(cu.RFM_BINS)
    states = v.stored("rfm-states", lambda: sketches.quantile_states(rows, columns, ["month"]))
    probs = {c: binning.bin_probs(q) for c, q in cu.RFM_BINS.items()}
    edges = sketches.merged_quantiles(states, probs)
    named = [
        F.struct(F.lit(c).alias("metric"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("edge"))
        for c, shares in probs.items() for i, p in enumerate(shares)
    ]
    wanted = edges.select(F.inline(F.array(*named)))
    # one row for each edge: broadcast
    values = rows.selectExpr(*[f"CAST({c} AS DOUBLE) AS {c}" for c in columns]).unpivot([], columns, "metric", "value")
    counted = values.join(F.broadcast(wanted), "metric").groupBy("metric", "prob").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") < F.col("edge")).alias("below"),
        F.count_if(F.col("value") <= F.col("edge")).alias("upto"),
    )
    error = sketches.rank_error()
    within = (F.col("below") / F.col("n") - error <= F.col("prob")) & (F.col("upto") / F.col("n") + error >= F.col("prob"))
    return counted.select("metric", "prob", "n", within.alias("within"))


@query
def outliers_z(v: TestViews) -> DataFrame:
    kept = scaling.drop_outliers_z(_rfm(v), ["frequency", "monetary"], 2.0)
    return kept.select("customer_id", "frequency", "monetary")


@query
def outliers_iqr(v: TestViews) -> DataFrame:
    return scaling.drop_outliers_iqr(_rfm(v), "monetary").select("customer_id", "monetary")


@query
def standardize(v: TestViews) -> DataFrame:
    columns = ["recency", "frequency", "monetary", "qty"]
    return rounded(scaling.standardize(_rfm(v), columns).select("customer_id", *columns), 6, *columns)


@query
def minmax_scale(v: TestViews) -> DataFrame:
    columns = ["recency", "frequency", "monetary", "qty"]
    named = [f"{c}_std" for c in columns]
    return rounded(scaling.minmax(_rfm(v), columns).select("customer_id", *named), 6, *named)


def _types(v: TestViews) -> DataFrame:
    return binning.one_hot(map_sector(v), "customer_type", CUSTOMER_TYPES, retention.TYPE_PREFIX)


@query
def one_hot(v: TestViews) -> DataFrame:
    return _types(v).select("customer_id", *retention.type_columns(CUSTOMER_TYPES))


@query
def decode_onehot(v: TestViews) -> DataFrame:
    return one_hot(v).select(
        "customer_id", argmax_name(retention.type_columns(CUSTOMER_TYPES)).alias("customer_type")
    )


@query
def label_encode(v: TestViews) -> DataFrame:
    return binning.label_encode(churn_label(v), "label", "target_encoded")


@query
def denormalize(v: TestViews) -> DataFrame:
    base = _rfm(v).select("customer_id", "qty")
    scaled = scaling.standardize(base, ["qty"], "_scaled").drop("qty")
    back = scaling.unstandardize(scaled, scaling.column_stats(base, ["qty"]), "qty", "qty_scaled", "qty")
    return rounded(rounded(back, 6, "qty_scaled"), 4, "qty")


@query
def tomek_undersample(v: TestViews) -> DataFrame:
    kept = neighbours.undersample(v.neighbours(), "customer_id", "features", "target_encoded")
    return kept.select("customer_id", "target_encoded")


@query
def tomek_links(v: TestViews) -> DataFrame:
    kept = neighbours.undersample(v.neighbours(), "customer_id", "features", "target_encoded", "tomek")
    return kept.select("customer_id", "target_encoded")


@query
def inference_table(v: TestViews) -> DataFrame:
    return retention.inference_table(_stored_features(v), CUSTOMER_TYPES)


def _stored_features(v: TestViews) -> DataFrame:
    return v.stored("customer-features", lambda: _features(v))


@query
def training_table(v: TestViews) -> DataFrame:
    return retention.training_table(_stored_features(v), CUSTOMER_TYPES)


@query
def training_table_text_keys(v: TestViews) -> DataFrame:
    """Customer numbers spelled as text go through scaling, encoding and undersampling."""
    spelled = F.concat(F.lit("C"), F.lpad(F.col("customer_id").cast("string"), 12, "0"))
    return retention.training_table(_stored_features(v).withColumn("customer_id", spelled), CUSTOMER_TYPES)


# --- exploration -------------------------------------------------------------------

LABELS = ["churn", "retain"]


def _labelled(v: TestViews) -> DataFrame:
    """Customers with scores, label, master sector and account type."""
    return cu.map_sector(_profile(v), v.sector_map())


def _label_sector(v: TestViews) -> DataFrame:
    """Label and segments only: the label needs no amounts."""
    sectors = cu.map_sector(v.customers(), v.sector_map())
    return churn_label(v).join(sectors, "customer_id")


@query
def label_share(v: TestViews) -> DataFrame:
    return rounded(explore.label_share(churn_label(v), "label"), 6, "share")


@query
def churn_rate_by_segment(v: TestViews) -> DataFrame:
    rates = explore.label_rates(_label_sector(v), "cust_country", "label", LABELS)
    return rounded(rates, 6, *LABELS, "total")


@query
def pivot_counts(v: TestViews) -> DataFrame:
    return explore.pivot_counts(_label_sector(v), "master_sector", "label", LABELS)


@query
def category_counts(v: TestViews) -> DataFrame:
    return explore.category_counts(_label_sector(v), "customer_type", "label")


@query
def segment_profile(v: TestViews) -> DataFrame:
    means = ["frequency", "recency", "monetary", "purchase_variability", "purchase_diversity"]
    profile = explore.segment_profile(_labelled(v), "label", means, ["qty"])
    return rounded(profile, 4, *[f"mean_{c}" for c in means])


@query
def monthly_trend(v: TestViews) -> DataFrame:
    sums = {"monetary": money_sum("monetary"), "frequency": F.sum("frequency")}
    return explore.monthly_trend(_rfm(v), "order_date", sums)


@query
def monthly_means(v: TestViews) -> DataFrame:
    means = explore.monthly_means(_rfm(v), "order_date", ["monetary", "frequency"])
    return rounded(means, 4, "mean_monetary", "mean_frequency")


@query
def consecutive_periods(v: TestViews) -> DataFrame:
    orders = v.table("orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date"))
    return rounded(explore.consecutive_periods(orders, 3), 6, "percentage")


@query
def correlation_matrix(v: TestViews) -> DataFrame:
    scored = cu.rfm_scores(_rfm(v))
    table = explore.correlation_matrix(scored, ["frequency", "recency", "monetary", "qty", "rfm_score"])
    return rounded(table, 6, "corr")


@query
def describe_numeric(v: TestViews) -> DataFrame:
    table = explore.describe_numeric(_rfm(v), ["recency", "frequency", "monetary", "qty"])
    return rounded(table, 4, "mean", "std", "q25", "q50", "q75")


@query
def histogram_by_group(v: TestViews) -> DataFrame:
    rows = _rfm(v).join(v.customers().select("customer_id", "sector"), "customer_id")
    return rounded(explore.histogram(rows, "qty", "sector"), 4, "bin_start")


@query
def box_summary(v: TestViews) -> DataFrame:
    rows = _rfm(v).join(v.customers().select("customer_id", "sector"), "customer_id")
    table = explore.box_summary(rows, ["recency", "frequency", "monetary"], "sector")
    return rounded(table, 4, "q25", "q50", "q75", "low_whisker", "high_whisker")


# --- evaluation --------------------------------------------------------------------


@query
def confusion_split(v: TestViews) -> DataFrame:
    return evaluate.with_outcome(v.predictions()).select("customer_id", "outcome")


@query
def confusion_prob_stats(v: TestViews) -> DataFrame:
    return rounded(evaluate.confusion_probabilities(v.predictions()), 6, "mean", "std")


@query
def confusion_prob_stats_by_class(v: TestViews) -> DataFrame:
    rows = v.predictions().withColumns({"p_0": 1 - F.col("probability"), "p_1": F.col("probability")})
    return rounded(evaluate.confusion_probabilities(rows, None, ("p_0", "p_1")), 6, "mean", "std")


@query
def segment_accuracy(v: TestViews) -> DataFrame:
    return rounded(evaluate.segment_accuracy(v.predictions(), "customer_type"), 6, "correct_pct", "incorrect_pct")


@query
def classification_report(v: TestViews) -> DataFrame:
    rows = v.predictions().withColumn("fold", F.col("customer_id") % 5)
    return rounded(evaluate.classification_report(rows, "fold"), 6, "precision", "recall", "f1", "accuracy")


@query
def regression_metrics(v: TestViews) -> DataFrame:
    table = evaluate.regression_metrics(_forecasts(v), ["year_id"])
    return rounded(rounded(table, 1, "mse"), 6, "mae", "median_ape", "mean_ape", "r2")


@query
def forecast_bands(v: TestViews) -> DataFrame:
    return rounded(evaluate.forecast_bands(_forecasts(v)), 6, "mean_error_below_70")


SCORES = ["rfm_score", "frequency_score", "monetary_score"]


def _scored_predictions(v: TestViews) -> DataFrame:
    """Predictions with the customer's three scores (null for those without shipments)."""
    return v.predictions().join(rfm(v).select("customer_id", *SCORES), "customer_id", "left")


@query
def score_boxes_by_outcome(v: TestViews) -> DataFrame:
    """Box tables of the scores, of rightly and wrongly predicted customers of each class."""
    rows = evaluate.with_outcome(_scored_predictions(v)).select("outcome", *SCORES)
    table = explore.box_summary(rows, SCORES, "outcome")
    return rounded(table, 4, "q25", "q50", "q75", "low_whisker", "high_whisker")


TESTED = [*SCORES, "qty"]
RANKED = ["monetary", "frequency", "recency", "qty", "rfm_score"]


@query
def t_test_bonferroni(v: TestViews) -> DataFrame:
    wrong = F.col("predictions") != F.col("target_encoded")
    return rounded(evaluate.t_statistics(_scored_predictions(v), TESTED, wrong, ~wrong), 6, "t")


@query
def t_test_p_values(v: TestViews) -> DataFrame:
    wrong = F.col("predictions") != F.col("target_encoded")
    return rounded(evaluate.t_test_bonferroni(_scored_predictions(v), TESTED, wrong, ~wrong), 6, "t", "p", "p_corrected")


@query
def mann_whitney(v: TestViews) -> DataFrame:
    labelled = cu.rfm_scores(_rfm(v)).join(churn_label(v), "customer_id")
    table = evaluate.mann_whitney(labelled, RANKED, "label", LABELS)
    return rounded(table, 6, "z")


@query
def kruskal_wallis(v: TestViews) -> DataFrame:
    rows = _rfm(v).join(cu.map_sector(v.customers(), v.sector_map()), "customer_id")
    return rounded(
        evaluate.kruskal_wallis(rows, ["monetary", "frequency", "recency"], "customer_type", CUSTOMER_TYPES), 6, "h"
    )


@query
def rank_test_p_values(v: TestViews) -> DataFrame:
    labelled = cu.rfm_scores(_rfm(v)).join(churn_label(v), "customer_id")
    return rounded(evaluate.rank_test(labelled, RANKED, "label", LABELS), 6, "p")


def _prediction_vectors(v: TestViews) -> DataFrame:
    flags = [F.when(F.col("customer_type") == t, 1.0).otherwise(0.0) for t in CUSTOMER_TYPES]
    return v.predictions().withColumn("vector", F.array(F.col("qty"), *flags))


@query
def error_distance(v: TestViews) -> DataFrame:
    table = neighbours.error_distance(_prediction_vectors(v), "customer_id", "vector")
    return rounded(table, 6, "min_distance", "avg_distance")


@query
def pca_distances(v: TestViews) -> DataFrame:
    """Where wrong predictions lie by their distances to all correct ones."""
    table = distances.distance_components(_prediction_vectors(v), "customer_id", "vector")
    return rounded(table, 3, "pc1", "pc2")


@query
def pca_2d(v: TestViews) -> DataFrame:
    rows = binning.one_hot(v.predictions(), "customer_type", CUSTOMER_TYPES, retention.TYPE_PREFIX)
    return models.principal_components(rows, "customer_id", ["qty", *retention.type_columns(CUSTOMER_TYPES)])


# --- models ------------------------------------------------------------------------

FEATURES = retention.model_features(CUSTOMER_TYPES)
SECTOR_COLUMNS = [binning.one_hot_name(s) for s in MASTER_SECTORS]
YEARS = [1998, 1999, 2000, 2001]


@query
def stratified_folds(v: TestViews) -> DataFrame:
    rows = folds.add_folds(churn_label(v), "customer_id", 5, "label")
    return rows.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query
def churn_gbt_cv(v: TestViews) -> DataFrame:
    settings = models.combinations(models.GBT_GRID)
    return models.churn_search(training_table(v), FEATURES, models.gbt_classifier(), settings)[1]


@query
def churn_gbt_report(v: TestViews) -> DataFrame:
    return models.churn_report(training_table(v), FEATURES, models.gbt_classifier())


@query
def churn_mlp_cv(v: TestViews) -> DataFrame:
    settings = [{"layers": [len(FEATURES), *hidden, 2]} for hidden in models.MLP_LAYERS]
    return models.churn_search(training_table(v), FEATURES, models.mlp_classifier(len(FEATURES)), settings)[1]


@query
def churn_mlp_report(v: TestViews) -> DataFrame:
    return models.churn_mlp_run(training_table(v), FEATURES)


@query
def score_customers(v: TestViews) -> DataFrame:
    table = models.fitting_frame(training_table(v), "churn-train")
    model = models.pipeline(FEATURES, models.gbt_classifier()).fit(table)
    scored = models.score(model, retention.inference_table(_stored_features(v), CUSTOMER_TYPES))
    return retention.scored_output(scored, CUSTOMER_TYPES, retention.quantity_stats(_stored_features(v)))


@query
def score_customers_mlp(v: TestViews) -> DataFrame:
    """By the network as saved and loaded again; both class probabilities are given."""
    path = f"{scratch_dir(v.spark)}/network-{uuid.uuid4().hex}"
    models.churn_mlp_run(training_table(v), FEATURES, model_path=path)
    scored = models.score(models.load(path), retention.inference_table(_stored_features(v), CUSTOMER_TYPES))
    return scored.select("customer_id", "predictions", "probability_class_0", "probability_class_1")


@query
def customer_value_features(v: TestViews) -> DataFrame:
    return models.customer_value(training_table(v), customer_revenue(v))


@query
def customer_value_rf(v: TestViews) -> DataFrame:
    return models.customer_value_metrics(customer_value_features(v), FEATURES)


@query
def backtest_splits(v: TestViews) -> DataFrame:
    rows = folds.backtest_splits(_train(v), YEARS, ["lagged_quota_std", "lagged_eur_std"])
    return rows.select("test_year", "role", *reps.KEYS)


@query
def quota_backtest(v: TestViews) -> DataFrame:
    return models.quota_backtest(_train(v), YEARS, SECTOR_COLUMNS)


@query
def quota_ensemble(v: TestViews) -> DataFrame:
    """One fit of each model, without a search."""
    return models.ensemble_report(models.quota_ensemble(_train(v), SECTOR_COLUMNS, [{}]))


@query
def quota_random_search(v: TestViews) -> DataFrame:
    return models.ensemble_report(models.quota_ensemble(_train(v), SECTOR_COLUMNS))


@query
def quota_predictions(v: TestViews) -> DataFrame:
    """By the two models as saved and loaded again."""
    folder = f"{scratch_dir(v.spark)}/quota-models-{uuid.uuid4().hex}"
    train = models.fitting_frame(_train(v), "quota-train")
    models.save_pair(models.fit_pair(train, SECTOR_COLUMNS), folder)
    return models.quota_predictions(models.load_pair(folder), models.fitting_frame(_infer(v), "quota-infer"))


# --- what SQL can know of the models' results ---------------------------------------


def _shares(*columns: str):
    """True where all columns are from 0 to 1."""
    return F.forall(F.array(*columns), lambda x: (x >= 0) & (x <= 1))


@query
def churn_report_checked(v: TestViews) -> DataFrame:
    """The report's supports by class, and whether its metrics are shares."""
    report = churn_gbt_report(v)
    return report.select("class", "support", _shares("precision", "recall", "f1", "accuracy").alias("shares"))


@query
def score_customers_checked(v: TestViews) -> DataFrame:
    """Scored customers without the model's numbers: units and types restored, a class and its probability given."""
    sure = F.col("predictions").isin(0, 1) & F.col("probability").between(0.5, 1.0)
    return score_customers(v).select("customer_id", "customer_type", F.round("qty").alias("qty"), "label", sure.alias("sure"))


@query
def quota_backtest_checked(v: TestViews) -> DataFrame:
    """Back-test rows with the actual amounts, and whether the stated error follows from the prediction."""
    actual, error = F.col("y_true"), F.col("percentage_error")
    wanted = F.abs(F.try_divide(actual - F.col("y_pred"), actual)) * 100
    fits = F.when(actual == 0, error.isNull() | (error == float("inf"))).otherwise(F.abs(error - wanted) <= 1e-9 * (1 + wanted))
    return quota_backtest(v).select("test_year", *reps.KEYS, F.round("y_true", 2).alias("y_true"), fits.alias("fits"))


@query
def quota_predictions_checked(v: TestViews) -> DataFrame:
    """Next year's rows with flags and weights, without the predicted amounts."""
    return quota_predictions(v).select(
        *reps.KEYS, F.round("current_year_quota", 2).alias("current_year_quota"), "growth_potential",
        F.round("growth_adjustment_weight", 1).alias("weight"), "inactive_or_no_quota",
    )


# --- sinks -------------------------------------------------------------------------


@query
def write_overwrite_append(v: TestViews) -> DataFrame:
    """Replace a table, append to it, and read back what is there."""
    path = f"{scratch_dir(v.spark)}/revenue-{uuid.uuid4().hex}"
    revenue = customer_revenue(v)
    sinks.write_table(revenue, path)
    sinks.write_table(revenue, path)
    sinks.write_table(revenue, path, overwrite=False)
    return v.spark.read.parquet(path)


@query
def csv_round_trip(v: TestViews) -> DataFrame:
    """Revenue written as CSV and read with a declared schema."""
    path = f"{scratch_dir(v.spark)}/csv-{uuid.uuid4().hex}"
    revenue = customer_revenue(v)
    sinks.write_csv(revenue, path)
    return tables.read_csv(v.spark, path, "customer_id bigint, eur double")


@query
def clear_table(v: TestViews) -> DataFrame:
    """A written table before and after its rows were removed: the columns stay."""
    path = f"{scratch_dir(v.spark)}/cleared-{uuid.uuid4().hex}"
    sinks.write_table(customer_revenue(v), path)
    before = v.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_before"), F.max("customer_id").alias("last_before"))
    before = v.stored("before-clearing", lambda: before)
    sinks.clear_table(v.spark, path)
    after = v.spark.read.parquet(path)
    columns = ", ".join(f"{name} {kind}" for name, kind in after.dtypes)
    counted = after.agg(F.count(F.lit(1)).alias("rows_after")).withColumn("columns_after", F.lit(columns))
    return before.crossJoin(counted)  # one row each


#: Partitions of the stored tables.
LABEL_YEARS = (CURRENT_YEAR - 1, CURRENT_YEAR)


def _kept_by_year(v: TestViews, table: DataFrame, name: str) -> DataFrame:
    """A table kept by label year: both years written, then the last one alone again, and that one read."""
    path = f"{scratch_dir(v.spark)}/{name}-{uuid.uuid4().hex}"
    for year in (*LABEL_YEARS, CURRENT_YEAR):
        sinks.write_partitions(table.withColumn("label_year", F.lit(year)), path, ["label_year"])
    schema = ", ".join(f"{c} {kind}" for c, kind in [*table.dtypes, ("label_year", "int")])
    return tables.read_partitions(v.spark, path, schema, label_year=CURRENT_YEAR)


@query
def training_table_stored(v: TestViews) -> DataFrame:
    """The training table of the current year, from the table kept by year."""
    return _kept_by_year(v, v.stored("training", lambda: training_table(v)), "training-by-year").drop("label_year")


@query
def inference_table_stored(v: TestViews) -> DataFrame:
    """The rows to score of the current year, from the table kept by year."""
    return _kept_by_year(v, v.stored("inference", lambda: inference_table(v)), "inference-by-year").drop("label_year")


@query
def csv_quarantine(v: TestViews) -> DataFrame:
    """Revenue lines as a CSV in which some amounts are words and some lines lack a field: what is read, and what is
    kept aside."""
    folder = f"{scratch_dir(v.spark)}/lines-{uuid.uuid4().hex}"
    key, eur = F.col("customer_id"), F.format_string("%.2f", "eur")
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", key, F.lit("unknown")))
        .when(key % 11 == 0, key.cast("string"))
        .otherwise(F.concat_ws(",", key, eur))
    )
    customer_revenue(v).select(line.alias("value")).write.text(f"{folder}/csv")
    # the folder has no header line
    good, bad = tables.read_csv_checked(v.spark, f"{folder}/csv", "customer_id bigint, eur double", header=False)
    sinks.quarantine(bad, f"{folder}/bad", "does not fit customer_id, eur")
    kept = v.spark.read.parquet(f"{folder}/bad")
    kinds = kept.agg(
        F.count(F.lit(1)).alias("n_bad"), F.count_if(F.col("line").contains("unknown")).alias("n_words"),
        F.count_if(F.col("reason").isNull()).alias("n_without_reason"),
    )
    read = good.agg(F.count(F.lit(1)).alias("n_good"), money_sum("eur").alias("eur"))
    return read.crossJoin(kinds).select("n_good", F.round("eur", 2).alias("eur"), "n_bad", "n_words", "n_without_reason")


@query
def run_log_history(v: TestViews) -> DataFrame:
    """Five runs, one for each fold of the predictions, logged one after the other: accuracy over their dates."""
    path = f"{scratch_dir(v.spark)}/history-{uuid.uuid4().hex}"
    rows = v.predictions().withColumn("fold", F.col("customer_id") % 5)
    right = F.when(F.col("target_encoded") == F.col("predictions"), 1.0).otherwise(0.0)
    hit = F.count_if((F.col("predictions") == 1) & (F.col("target_encoded") == 1))
    sizes = F.count_if(F.col("predictions") == 1) + F.count_if(F.col("target_encoded") == 1)
    runs = rows.groupBy("fold").agg(
        F.avg(right).alias("accuracy"),
        evaluate.log_loss("target_encoded", "probability").alias("loss"),
        F.coalesce(F.try_divide(hit * 2.0, sizes * 1.0), F.lit(0.0)).alias("f1_score"),
    )
    for run in runs.orderBy("fold").collect():  # one row for each fold
        when = AS_OF + dt.timedelta(days=int(run["fold"]))
        summary = v.spark.createDataFrame([run])
        sinks.append_run_log(v.spark, path, models.run_log_entry(summary, models.MLP_LAYERS[0], 5, when))
    history = sinks.run_history(sinks.read_run_log(v.spark, path))
    return rounded(history, 6, "accuracy", "f1_score", "change", "best_so_far")


@query
def model_run_log(v: TestViews) -> DataFrame:
    """The cross-validated run of the network, as its log shows it."""
    path = f"{scratch_dir(v.spark)}/runs-{uuid.uuid4().hex}"
    summary = models.churn_mlp_run(training_table(v), FEATURES)
    sinks.append_run_log(v.spark, path, models.run_log_entry(summary, models.MLP_LAYERS[0], 5, AS_OF))
    return sinks.read_run_log(v.spark, path)

"""The retention pipeline: from customer features to the training and inference tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.functions.columns import argmax_name
from tallycrest.operators import customers
from tallycrest.operators.binning import label_encode, one_hot, one_hot_name
from tallycrest.operators.neighbours import undersample
from tallycrest.operators.scaling import column_stats, drop_outliers_z, standardize, unstandardize
from tallycrest.session import materialize

NUMERIC = [
    "recency", "frequency", "monetary", "recency_score", "frequency_score", "monetary_score", "rfm_score", "qty",
    "opportunity_amt", "backlog",
]
MODEL_NUMERIC = ["frequency_score", "monetary_score", "rfm_score", "qty", "opportunity_amt", "backlog"]
TYPE_PREFIX = "customer_"


def customer_features(
    lines: DataFrame,
    opportunities: DataFrame,
    backlog_history: DataFrame,
    backlog_current: DataFrame,
    sectors: DataFrame,
    as_of: dt.datetime,
    current_year: int,
    cutoff: dt.datetime,
) -> DataFrame:
    """All features of a customer, from raw sales lines, opportunities and backlog."""
    profile = customers.customer_profile(customers.clean_sales(lines, cutoff), as_of, current_year)
    return customers.attach_gated_amounts(
        customers.map_sector(profile, sectors),
        customers.opportunity_by_account(opportunities),
        customers.backlog_by_customer(backlog_history, backlog_current),
    )


def type_columns(types: Sequence[str]) -> list[str]:
    return [one_hot_name(t, TYPE_PREFIX) for t in types]


def model_features(types: Sequence[str]) -> list[str]:
    return MODEL_NUMERIC + type_columns(types)


def prepared(
    features: DataFrame, types: Sequence[str], digits: int | None = 6, extra: Sequence[str] = ()
) -> DataFrame:
    """Scaled and one-hot columns, without those the models do not use.

    ``extra`` keeps further numeric features, such as variability and diversity. Scaled values are rounded: the last bits of a distributed mean vary from run to run,
    and neighbours must not.
    """
    numeric = [*NUMERIC, *extra]
    scaled = standardize(features, numeric)
    if digits is not None:
        scaled = scaled.withColumns({c: F.round(c, digits) for c in numeric})
    flagged = one_hot(scaled, "customer_type", types, TYPE_PREFIX)
    return flagged.select(
        "customer_id", "cust_country", *MODEL_NUMERIC, *extra, *type_columns(types), "label"
    )


def inference_table(features: DataFrame, types: Sequence[str]) -> DataFrame:
    """The rows to score: every customer, encoded as for training."""
    return prepared(features, types)


def feature_array(types: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in model_features(types)])


def training_table(
    features: DataFrame, types: Sequence[str], threshold: float = 2.0, mode: str = "reference"
) -> DataFrame:
    """Customers without monetary outliers, encoded, and thinned near the class border.

    The prepared rows are written once, since the neighbour search reads them repeatedly.
    """
    kept = drop_outliers_z(features, ["monetary"], threshold)
    encoded = label_encode(prepared(kept, types), "label", "target_encoded")
    rows = materialize(encoded.withColumn("_vector", feature_array(types)), "training-rows")
    return undersample(rows, "customer_id", "_vector", "target_encoded", mode).drop("_vector")


def scored_output(scored: DataFrame, types: Sequence[str], stats: DataFrame) -> DataFrame:
    """Prediction, its probability, the account type as a name and the quantity in units.

    ``stats`` are the statistics of the unscaled quantity.
    """
    named = scored.withColumn("customer_type", argmax_name(type_columns(types))).drop(*type_columns(types))
    return unstandardize(named, stats, "qty", "qty", "qty")


def quantity_stats(features: DataFrame) -> DataFrame:
    return column_stats(features, ["qty"])

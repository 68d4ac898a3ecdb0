"""Scaling and outlier filters from whole-table statistics.

Statistics come from one aggregate each and enter the plan as scalar subqueries:
no join, nothing on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycrest.operators.ranking import attach_row, quantile_row


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct per column: mean, population and sample deviation, min, max."""
    return df.agg(
        *[
            F.expr(
                f"struct(avg({c}) AS mean, stddev_pop({c}) AS deviation, stddev_samp({c}) AS sample_deviation, "
                f"double(min({c})) AS low, double(max({c})) AS high) AS {c}"
            )
            for c in columns
        ]
    )


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Z-scores with population deviation; a constant column becomes 0."""
    scores = {
        f"{c}{suffix}": F.expr(f"({c} - _stats.{c}.mean) / coalesce(nullif(_stats.{c}.deviation, 0), 1)")
        for c in columns
    }
    return attach_row(df, column_stats(df, columns), "_stats").withColumns(scores).drop("_stats")


def unstandardize(df: DataFrame, stats: DataFrame, column: str, scaled: str, name: str) -> DataFrame:
    """Back to the original scale, from the kept statistics of the unscaled column."""
    s = F.col("_stats")[column]
    known = attach_row(df, stats, "_stats")
    return known.withColumn(name, F.col(scaled) * s["deviation"] + s["mean"]).drop("_stats")


def unstandardize_by_scaled(df: DataFrame, column: str) -> DataFrame:
    """Rescale by the mean and sample deviation of the already scaled column itself."""
    s = F.col("_stats")[column]
    known = attach_row(df, column_stats(df, [column]), "_stats")
    return known.withColumn(column, F.col(column) * s["sample_deviation"] + s["mean"]).drop("_stats")


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """Scale to [0, 1]; a constant column becomes null."""
    shares = {
        f"{c}{suffix}": F.expr(f"try_divide({c} - _stats.{c}.low, _stats.{c}.high - _stats.{c}.low)")
        for c in columns
    }
    return attach_row(df, column_stats(df, columns), "_stats").withColumns(shares).drop("_stats")


def drop_outliers_z(df: DataFrame, columns: Sequence[str], threshold: float = 2.0) -> DataFrame:
    """Keep rows within ``threshold`` sample deviations of the mean on every column."""
    keep = " AND ".join(
        f"abs(try_divide({c} - _stats.{c}.mean, _stats.{c}.sample_deviation)) <= {threshold}" for c in columns
    )
    return attach_row(df, column_stats(df, columns), "_stats").filter(keep).drop("_stats")


def drop_outliers_iqr(df: DataFrame, column: str, multiplier: float = 1.5) -> DataFrame:
    """Keep rows inside the quartile fences, bounds included."""
    q = F.col("_q")[column]
    margin = (q[1] - q[0]) * multiplier
    known = attach_row(df, quantile_row(df, {column: [0.25, 0.75]}), "_q")
    return known.filter((F.col(column) >= q[0] - margin) & (F.col(column) <= q[1] + margin)).drop("_q")

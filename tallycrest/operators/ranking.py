"""Exact ranks and quantiles without a single-task sort.

Values are first reduced to (value, count) pairs, so a value that fills a third of
the table becomes one row. The pairs are then cut into buckets of about equal size
by approximate split points, and counted up inside each bucket; the offsets of the
buckets are a table of at most ``groups x buckets`` rows. The split points decide
only how even the buckets are: ranks are exact whatever they say.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycrest.session import materialize

MAX_BUCKETS = 1024
HASH_SLICE_BITS = 12


def bucket_count(df: DataFrame) -> int:
    """Buckets to use: one per shuffle partition, bounded."""
    return max(2, min(MAX_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (by..., metric, value) and drop null and NaN values."""
    wide = df.selectExpr(*by, *[f"CAST({c} AS DOUBLE) AS {c}" for c in columns])
    long = wide.unpivot(list(by), list(columns), "metric", "value")
    return long.filter("value IS NOT NULL AND NOT isnan(value)")


def value_ranks(
    values: DataFrame, by: Sequence[str], extra: dict[str, Column] | None = None
) -> DataFrame:
    """Distinct ``value`` per group with its count and cumulative count.

    ``values`` holds the ``by`` columns and ``value``. ``by`` must be a small set of
    groups (metrics, labels, years), each of which may hold most of the rows.
    ``extra`` adds aggregates per distinct value. Output: by, value, cnt, extra...,
    ``cum`` (rows up to and including this value) and ``n`` (rows in the group).
    """
    by = list(by)
    extra = extra or {}
    buckets = bucket_count(values)
    shares = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    splits = values.groupBy(*by).agg(
        F.expr(f"percentile_approx(value, array({shares}), {20 * buckets}) AS splits")
    )
    counts = values.groupBy(*by, "value").agg(
        F.count(F.lit(1)).alias("cnt"), *[c.alias(name) for name, c in extra.items()]
    )
    if by == ["metric"]:  # one row per listed column; other groups are left to measured sizes
        splits = F.broadcast(splits)
    inside = Window.partitionBy(*by, "bucket").orderBy("value")
    counted = (
        counts.join(splits, by)
        .withColumn("bucket", F.expr("size(filter(splits, s -> s < value))"))
        .select(*by, "value", "cnt", *extra, "bucket", F.sum("cnt").over(inside).alias("run"))
    )
    group = Window.partitionBy(*by)
    before = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy(*by, "bucket")
        .agg(F.max("run").alias("size"))
        .select(
            *by,
            "bucket",
            F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
            F.sum("size").over(group).alias("n"),
        )
    )
    # the window has placed the rows by these keys already
    return counted.join(offsets, [*by, "bucket"]).select(
        *by, "value", "cnt", *extra, (F.col("base") + F.col("run")).alias("cum"), "n"
    )


def _interpolated(prob: float, only: str = "true") -> str:
    """Linear-interpolation quantile from ranked values, as an aggregate of the rows ``only`` selects."""
    position = f"((n - 1) * {float(prob)}D)"
    low = f"min(CASE WHEN {only} AND cum > floor({position}) THEN value END)"
    high = f"min(CASE WHEN {only} AND cum > ceil({position}) THEN value END)"
    share = f"max(CASE WHEN {only} THEN {position} - floor({position}) END)"
    # from the nearer end, so that rounding never passes the other end
    return (
        f"CASE WHEN {share} < 0.5 THEN {low} + ({high} - {low}) * {share} "
        f"ELSE {high} - ({high} - {low}) * (1 - {share}) END"
    )


def quantiles_of_ranks(ranked: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles per group from ranked values: ``n`` and array ``q``."""
    return ranked.groupBy(*by).agg(
        F.max("n").alias("n"), F.expr(f"array({', '.join(_interpolated(p) for p in probs)}) AS q")
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles: one row per (by..., metric) with ``n`` and array ``q``."""
    ranked = value_ranks(long_values(df, columns, by), [*by, "metric"])
    return quantiles_of_ranks(ranked, probs, [*by, "metric"])


def attach_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Add a one-row frame as a struct column: a scalar subquery, planned and run once."""
    return df.withColumn(name, row.select(F.struct("*")).scalar())


def quantile_row(df: DataFrame, probs: dict[str, Sequence[float]]) -> DataFrame:
    """Whole-table quantiles as one row with an array per column, in the order asked for."""
    ranked = value_ranks(long_values(df, list(probs)), ["metric"])
    cells = {c: ", ".join(_interpolated(p, f"metric = '{c}'") for p in ps) for c, ps in probs.items()}
    return ranked.agg(*[F.expr(f"array({cell}) AS {c}") for c, cell in cells.items()])


def midranks(values: DataFrame, by: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Ranked values plus ``midrank``, the mean rank that ties share."""
    return value_ranks(values, by, extra).withColumn(
        "midrank", F.col("cum") - (F.col("cnt") - 1) / F.lit(2.0)
    )


def shuffled_row_number(df: DataFrame, by: Sequence[str], key: str, name: str = "position") -> DataFrame:
    """Number the rows of each group 1..n in the order of a hash of ``key``.

    ``by`` is a small set of groups that may each hold most of the table, so rows are
    numbered inside equal slices of the hash range and shifted by the slice offsets. The
    slices are fixed, so the numbers do not depend on any session setting.
    """
    by = list(by)
    hashed = df.withColumn("_hash", F.xxhash64(key)).withColumn(
        "_slice", F.shiftrightunsigned("_hash", 64 - HASH_SLICE_BITS)
    )
    sizes = hashed.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*by, "_slice").orderBy("_hash", key)
    return (
        hashed.withColumn("_row", F.row_number().over(inside))
        .join(offsets, [*by, "_slice"])
        .withColumn(name, F.col("_base") + F.col("_row"))
        .drop("_hash", "_slice", "_row", "_base")
    )


def codes(values: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null values and their 0-based place in ascending order, for any number of values.

    Ranges of values are numbered inside and shifted by the sizes of the ranges before; which
    value lies in which range is stored, so both passes agree.
    """
    ranged = materialize(
        values.select(column).filter(F.col(column).isNotNull()).distinct().repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id()),
        "codes",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    # one row per shuffle partition
    return ranged.withColumn("_nth", nth).join(F.broadcast(bases), "_part").select(
        column, (F.col("_base") + F.col("_nth") - 1).alias(name)
    )

"""Metrics, error analysis and significance tests over predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.functions.columns import absolute_percentage_error
from tallycrest.functions.pvalues import chi2_p, normal_p, t_p
from tallycrest.operators.ranking import attach_row, long_values, midranks, quantiles

# Upper bound of the error band -> its name; the last band is open.
BANDS = [(10, "highly accurate"), (25, "good"), (50, "reasonable"), (None, "weak and inaccurate")]


def with_outcome(df: DataFrame) -> DataFrame:
    """Name each prediction: correct_0, correct_1, incorrect_0 or incorrect_1 (by predicted class)."""
    right = F.col("target_encoded") == F.col("predictions")
    kind = F.concat(F.when(right, "correct_").otherwise("incorrect_"), F.col("predictions").cast("string"))
    return df.withColumn("outcome", F.when(F.col("predictions").isin(0, 1) & F.col("target_encoded").isin(0, 1), kind))


def confusion_probabilities(
    df: DataFrame, probability: str | None = "probability", by_class: tuple[str, str] | None = None
) -> DataFrame:
    """Mean and sample deviation of the probability per outcome.

    ``by_class`` names the columns for class 0 and 1 where a model gives both.
    """
    p = (
        F.when(F.col("predictions") == 0, F.col(by_class[0])).otherwise(F.col(by_class[1]))
        if by_class
        else F.col(probability)
    )
    return (
        with_outcome(df)
        .filter(F.col("outcome").isNotNull())
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean"), F.stddev_samp(p).alias("std"))
    )


def segment_accuracy(df: DataFrame, segment: str) -> DataFrame:
    """Correct and incorrect predictions per segment, as counts and percentages."""
    right = F.count_if(F.col("target_encoded") == F.col("predictions"))
    wrong = F.count_if(F.col("target_encoded") != F.col("predictions"))
    counts = df.groupBy(segment).agg(right.alias("correct"), wrong.alias("incorrect"))
    total = F.col("correct") + F.col("incorrect")
    return counts.withColumns(
        {
            "correct_pct": F.try_divide(F.col("correct") * 100.0, total),
            "incorrect_pct": F.try_divide(F.col("incorrect") * 100.0, total),
        }
    )


def classification_report(df: DataFrame, fold: str) -> DataFrame:
    """Precision, recall, F1 and support per class and the accuracy, averaged over folds.

    Support is summed. A ratio without cases is 0, as in the usual report.
    """
    actual, predicted = F.col("target_encoded"), F.col("predictions")
    folds = df.groupBy(fold).agg(
        *[F.count_if((actual == c) & (predicted == c)).alias(f"tp{c}") for c in (0, 1)],
        *[F.count_if(predicted == c).alias(f"said{c}") for c in (0, 1)],
        *[F.count_if(actual == c).alias(f"was{c}") for c in (0, 1)],
        F.avg(F.when(actual == predicted, 1.0).otherwise(0.0)).alias("accuracy"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a * 1.0, b * 1.0), F.lit(0.0))

    rows = []
    for c in (0, 1):
        tp, said, was = F.col(f"tp{c}"), F.col(f"said{c}"), F.col(f"was{c}")
        rows.append(
            F.struct(
                F.lit(c).alias("class"), ratio(tp, said).alias("precision"), ratio(tp, was).alias("recall"),
                ratio(tp * 2, said + was).alias("f1"), was.alias("support"), F.col("accuracy"),
            )
        )
    return (
        folds.select(F.inline(F.array(*rows)))
        .groupBy("class")
        .agg(
            *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
            F.sum("support").alias("support"),
            F.avg("accuracy").alias("accuracy"),
        )
    )


def log_loss(label: str, probability_of_one: str) -> Column:
    """Mean cross-entropy as an aggregate."""
    p = F.least(F.greatest(F.col(probability_of_one), F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.avg(F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))


def regression_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MSE, MAE, median and mean percentage error and R² of ``y_pred`` against ``y_true``.

    Errors against an actual 0 are infinite: they count in the median, and the mean leaves them out.
    """
    error = F.col("y_true") - F.col("y_pred")
    rows = df.withColumn("ape", absolute_percentage_error("y_true", "y_pred"))
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(F.when(F.col("ape") < float("inf"), F.col("ape"))).alias("mean_ape"),
        F.var_pop("y_true").alias("_variance"),
    )
    middle = quantiles(rows, ["ape"], [0.5], by).select(*by, F.col("q")[0].alias("median_ape"))
    joined = sums.join(middle, list(by)) if by else attach_row(
        sums, middle, "_m"
    ).withColumn("median_ape", F.col("_m")["median_ape"]).drop("_m")
    return joined.withColumn("r2", 1 - F.try_divide("mse", "_variance")).drop("_variance")


def forecast_bands(df: DataFrame) -> DataFrame:
    """Rows and reps per error band, with the mean error of rows below 70 percent.

    An actual 0 that was not predicted is in the last band; a predicted one has no error and no band.
    """
    rows = df.withColumn("ape", absolute_percentage_error("y_true", "y_pred")).filter(F.col("ape").isNotNull())
    band = F.lit(BANDS[-1][1])
    for limit, name in reversed(BANDS[:-1]):
        band = F.when(F.col("ape") < limit, name).otherwise(band)
    counts = rows.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("sales_id").alias("n_reps")
    )
    usual = rows.filter(F.col("ape") < 70).agg(F.avg("ape").alias("mean"))
    return attach_row(counts, usual, "_usual").select(
        "band", "n_rows", "n_reps", F.col("_usual")["mean"].alias("mean_error_below_70")
    )


def t_statistics(df: DataFrame, features: Sequence[str], first: Column, second: Column) -> DataFrame:
    """Two-sample t with pooled variance per feature; the conditions select the groups."""
    sides = df.withColumn("side", F.when(first, 1).when(second, 2)).filter(F.col("side").isNotNull())

    def moment(function, side: int) -> Column:
        return function(F.when(F.col("side") == side, F.col("value")))

    stats = (
        long_values(sides, features, ["side"])
        .groupBy(F.col("metric").alias("feature"))
        .agg(
            *[moment(F.count, s).alias(f"n{s}") for s in (1, 2)],
            *[moment(F.avg, s).alias(f"m{s}") for s in (1, 2)],
            *[moment(F.var_samp, s).alias(f"v{s}") for s in (1, 2)],
        )
    )
    n1, n2 = F.col("n1"), F.col("n2")
    pooled = F.try_divide((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2"), (n1 + n2 - 2).cast("double"))
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(pooled * (1 / n1 + 1 / n2)))
    return stats.select("feature", "n1", "n2", t.alias("t"))


def t_test_bonferroni(
    df: DataFrame, features: Sequence[str], first: Column, second: Column, alpha: float = 0.05
) -> DataFrame:
    """t statistics with p-values corrected for the number of features."""
    tested = t_statistics(df, features, first, second).withColumn(
        "p", t_p(F.col("t"), (F.col("n1") + F.col("n2") - 2).cast("double"))
    )
    corrected = F.least(F.lit(1.0), F.col("p") * len(features))
    return tested.withColumn("p_corrected", corrected).withColumn("significant", F.col("p_corrected") < alpha)


def _rank_sums(df: DataFrame, columns: Sequence[str], group: str, groups: Sequence[object]) -> DataFrame:
    """Rank sum and size of each group, and the tie term, per column."""
    rows = long_values(df.filter(F.col(group).isin(list(groups))), columns, [group])
    counts = {f"n{i}": F.count_if(F.col(group) == g) for i, g in enumerate(groups)}
    cnt = F.col("cnt").cast("double")
    return (
        midranks(rows, ["metric"], counts)
        .groupBy("metric")
        .agg(
            F.max("n").cast("double").alias("n"),
            F.sum(cnt * cnt * cnt - cnt).alias("ties"),
            *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(groups))],
            *[F.sum(F.col(f"n{i}") * F.col("midrank")).alias(f"r{i}") for i in range(len(groups))],
        )
    )


def mann_whitney(df: DataFrame, columns: Sequence[str], group: str, groups: Sequence[object]) -> DataFrame:
    """U of the first group and the continuity-corrected z, corrected for ties, per column."""
    if len(groups) != 2:
        raise ValueError("the test compares two groups")
    sums = _rank_sums(df, columns, group, groups)
    n, n1, n2 = F.col("n"), F.col("n0"), F.col("n1")
    u = F.col("r0") - n1 * (n1 + 1) / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5, sigma)
    return sums.select("metric", n1.alias("size_1"), n2.alias("size_2"), u.alias("u"), z.alias("z"))


def kruskal_wallis(df: DataFrame, columns: Sequence[str], group: str, groups: Sequence[object]) -> DataFrame:
    """Tie-corrected H and its degrees of freedom per column."""
    if len(groups) < 2:
        raise ValueError("the test compares at least two groups")
    sums = _rank_sums(df, columns, group, groups)
    n = F.col("n")
    squares = sum((F.col(f"r{i}") * F.col(f"r{i}") / F.col(f"n{i}") for i in range(len(groups))), F.lit(0.0))
    h = 12.0 / (n * (n + 1)) * squares - 3 * (n + 1)
    correction = 1 - F.col("ties") / (n * n * n - n)
    return sums.select(
        "metric", n.cast("long").alias("n"), F.try_divide(h, correction).alias("h"),
        F.lit(len(groups) - 1).alias("freedom"),
    )


def rank_test(df: DataFrame, columns: Sequence[str], group: str, groups: Sequence[object]) -> DataFrame:
    """Statistic and p-value per column: Mann-Whitney for two groups, Kruskal-Wallis for more."""
    if len(groups) == 2:
        tested = mann_whitney(df, columns, group, groups)
        return tested.select("metric", F.col("u").alias("statistic"), F.least(F.lit(1.0), normal_p("z")).alias("p"))
    tested = kruskal_wallis(df, columns, group, groups)
    return tested.select(
        "metric", F.col("h").alias("statistic"), chi2_p(F.col("h"), F.col("freedom").cast("double")).alias("p")
    )

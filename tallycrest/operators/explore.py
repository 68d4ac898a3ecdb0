"""Segment rates, trends, distributions: the tables behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.operators.ranking import attach_row, long_values, quantiles, quantiles_of_ranks, value_ranks

QUARTILES = [0.25, 0.5, 0.75]


def category_counts(df: DataFrame, category: str, hue: str | None = None) -> DataFrame:
    keys = [category] if hue is None else [category, hue]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def label_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label. The window runs over the finished counts only."""
    counts = category_counts(df.filter(F.col(label).isNotNull()), label)
    return attach_row(counts, counts.agg(F.sum("n").alias("n")), "_all").select(
        label, "n", (F.col("n") / F.col("_all")["n"]).alias("share")
    )


def pivot_counts(df: DataFrame, segment: str, label: str, labels: Sequence[str]) -> DataFrame:
    """Rows per segment and label, one column per listed label."""
    return (
        df.filter(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(*[F.count_if(F.col(label) == v).alias(v) for v in labels])
    )


def label_rates(df: DataFrame, segment: str, label: str, labels: Sequence[str]) -> DataFrame:
    """Share of each label per segment, 0 where it does not occur, with the total, largest first."""
    counts = (
        df.filter(F.col(segment).isNotNull() & F.col(label).isNotNull())
        .groupBy(segment)
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(label) == v).alias(v) for v in labels])
    )
    shares = counts.select(segment, *[(F.col(v) / F.col("n")).alias(v) for v in labels])
    total = sum((F.col(v) for v in labels[1:]), F.col(labels[0]))
    return shares.withColumn("total", total).orderBy(F.desc("total"), segment)


def segment_profile(df: DataFrame, segment: str, means: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Size, means and sums per segment."""
    return (
        df.filter(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(c).alias(f"mean_{c}") for c in means],
            *[F.sum(c).alias(f"sum_{c}") for c in sums],
        )
    )


def monthly_means(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns]
    )


def monthly_trend(df: DataFrame, date: str, sums: dict[str, Column]) -> DataFrame:
    """Totals per calendar month from the first to the last month, empty months 0."""
    month = F.to_date(F.date_trunc("month", F.col(date)))
    totals = df.filter(F.col(date).isNotNull()).groupBy(month.alias("month")).agg(
        *[c.alias(n) for n, c in sums.items()]
    )
    calendar = totals.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    return calendar.join(totals, "month", "left").fillna(0, list(sums))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"), F.lit(1.0).alias("corr")) for a in columns]
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{a}|{b}`").alias("corr")))
    return row.select(F.inline(F.array(*cells)))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    basic = (
        long_values(df, columns)
        .groupBy("metric")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quart = quantiles(df, columns, QUARTILES).select(
        "metric", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")
    )
    return basic.join(quart, "metric")


def histogram(df: DataFrame, column: str, hue: str, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin and group; the last bin includes the maximum."""
    value = F.col(column).cast("double")
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = F.col("_ends")["lo"], F.col("_ends")["hi"]
    place = F.floor(F.try_divide(value - lo, hi - lo) * bins)
    return (
        attach_row(df.filter(F.col(column).isNotNull()), ends, "_ends")
        .withColumns(
            {
                "bin": F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int"),
                "_lo": lo,
                "_width": (hi - lo) / bins,
            }
        )
        .groupBy(hue, "bin", "_lo", "_width")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(hue, "bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"), "n")
    )


def box_summary(df: DataFrame, columns: Sequence[str], by: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and number of outliers per group and column.

    Whiskers end at the outermost values within ``reach`` quartile ranges. They are read
    from the ranked distinct values, so the rows are not scanned again per group.
    """
    ranked = value_ranks(long_values(df.filter(F.col(by).isNotNull()), columns, [by]), [by, "metric"])
    quart = quantiles_of_ranks(ranked, QUARTILES, [by, "metric"])
    margin = (F.col("q")[2] - F.col("q")[0]) * reach
    inside = F.col("value").between(F.col("q")[0] - margin, F.col("q")[2] + margin)
    return (
        ranked.drop("n")
        .join(quart, [by, "metric"])
        .groupBy(by, "metric")
        .agg(
            F.max("n").alias("n"),
            *[F.max(F.col("q")[i]).alias(name) for i, name in enumerate(["q25", "q50", "q75"])],
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("cnt"))).alias("outliers"),
        )
    )


def consecutive_periods(orders: DataFrame, months: int) -> DataFrame:
    """Percentage of customers with orders in two successive periods of ``months`` months.

    Period ends are month ends from the first order's month on, at the first order's
    time of day; both periods of a pair include the day after their end. An order picks
    its periods from the array of cutoffs, so there is no join on ranges.
    """
    present = orders.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    span = present.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    day = F.expr("INTERVAL 1 DAY")
    step = F.make_interval(months=F.lit(months))
    first_day = F.date_trunc("month", F.col("lo")).cast("timestamp_ntz")
    clock = F.col("lo") - F.date_trunc("day", F.col("lo")).cast("timestamp_ntz")
    starts = F.sequence(first_day, F.col("hi"), F.expr(f"INTERVAL {months} MONTH"))
    cutoffs = F.filter(
        F.transform(starts, lambda m: F.last_day(m).cast("timestamp_ntz") + F.col("clock")),
        lambda c: c <= F.col("hi"),
    )
    periods = F.transform(
        F.slice(F.col("cutoffs"), 1, F.greatest(F.size("cutoffs") - 1, F.lit(0))),
        lambda c, i: F.struct(
            i.alias("period"),
            c.alias("start"),
            F.get(F.col("cutoffs"), i + 1).alias("end"),
        ),
    )
    bounds = (
        span.withColumn("clock", clock).withColumn("cutoffs", cutoffs).select(periods.alias("periods"))
    )
    seen = (
        attach_row(present.groupBy("customer_id", "order_date").agg(F.count(F.lit(1))), bounds, "_b")
        .select("customer_id", "order_date", F.explode(F.filter(
            F.col("_b")["periods"],
            lambda p: (F.col("order_date") >= p["start"]) & (F.col("order_date") < p["end"] + step + day),
        )).alias("p"))
        .select(
            "customer_id",
            F.col("p")["period"].alias("period"),
            (F.col("order_date") < F.col("p")["end"] + day).alias("current"),
            (F.col("order_date") >= F.col("p")["end"]).alias("next"),
        )
    )
    pairs = seen.groupBy("customer_id", "period").agg(F.max("current").alias("current"), F.max("next").alias("next"))
    both = pairs.filter(F.col("current") & F.col("next")).agg(F.countDistinct("customer_id").alias("n"))
    everyone = present.agg(F.countDistinct("customer_id").alias("customers"))
    return attach_row(everyone, both, "_both").select(
        F.lit(months).alias("period_months"),
        "customers",
        F.col("_both")["n"].alias("consecutive_customers"),
        (F.col("_both")["n"] * 100.0 / F.col("customers")).alias("percentage"),
    )

"""Quantile bins, label codes and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.operators.ranking import attach_row, codes, quantile_row


def bin_of(value: str, edges: str, bins: int) -> Column:
    """Right-closed interval of ``value`` among the array of ascending edges, equal edges merged."""
    passed = [f"int({edges}[0] < {value})"] + [
        f"int({edges}[{i}] < {value} AND {edges}[{i}] <> {edges}[{i - 1}])" for i in range(1, bins + 1)
    ]
    return F.expr(f"CASE WHEN {value} IS NOT NULL THEN greatest(0, {' + '.join(passed)} - 1) END")


def bin_probs(bins: int) -> list[float]:
    """Edge probabilities as percentages divided by 100: their rounding decides on which side of
    an edge an equal value falls when the share, such as a third, has no exact form."""
    return [i * (1 / bins) * 100.0 / 100.0 for i in range(bins)] + [1.0]


def quantile_bins(df: DataFrame, bins: dict[str, int], names: dict[str, str]) -> DataFrame:
    """Add a 0-based quantile bin per column; equal values share a bin."""
    edges = quantile_row(df, {c: bin_probs(q) for c, q in bins.items()})
    return (
        attach_row(df, edges, "_edges")
        .withColumns({names[c]: bin_of(c, f"_edges.{c}", q) for c, q in bins.items()})
        .drop("_edges")
    )


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add 0-based codes in alphabetical order of the labels; null stays null.

    The labels are numbered in a pass of their own, then joined.
    """
    return df.join(codes(df, column, name).withColumn(name, F.col(name).cast("int")), column, "left")


def one_hot(df: DataFrame, column: str, categories: Sequence[str], prefix: str = "") -> DataFrame:
    """Add a 0/1 column per listed category; null and unlisted values give all zeros."""
    known = {one_hot_name(c, prefix): F.col(column).eqNullSafe(F.lit(c)).cast("int") for c in categories}
    return df.withColumns(known)


def one_hot_name(category: str, prefix: str = "") -> str:
    return f"{prefix}{category}".lower().replace(" ", "_")

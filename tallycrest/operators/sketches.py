"""Approximate quantiles and distinct counts from small states that are kept by period and merged.

A period's rows are read once; later answers over any set of periods merge the stored states and read no
rows. Both states have a bounded size whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycrest.operators.binning import bin_of, bin_probs
from tallycrest.operators.ranking import attach_row

#: Items a quantile state keeps, about; binary logarithm of the registers of a distinct state.
QUANTILE_ITEMS, DISTINCT_BITS = 800, 12


def rank_error(items: int = QUANTILE_ITEMS) -> float:
    """Largest error of a quantile's rank as a share of all rows, with 99 % confidence, whatever is merged."""
    return 2.296 / items**0.9723


def quantile_states(df: DataFrame, columns: Sequence[str], by: Sequence[str], items: int = QUANTILE_ITEMS) -> DataFrame:
    """One row for each period ``by``: a mergeable sketch of each column (named after it). Null values do not count."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), items).alias(c) for c in columns])


def merged_quantiles(states: DataFrame, probs: dict[str, Sequence[float]]) -> DataFrame:
    """One row with an array for each column: the values at the wanted ranks over all periods of ``states``."""
    merged = states.agg(*[F.kll_merge_agg_double(c).alias(c) for c in probs])

    def values(column: str, ranks: Sequence[float]) -> Column:
        wanted = F.array(*[F.lit(float(r)) for r in ranks])
        # a sketch without values has no quantiles
        known = F.kll_sketch_get_n_double(column) > 0
        return F.when(known, F.kll_sketch_get_quantile_double(column, wanted)).alias(column)

    return merged.select(*[values(c, r) for c, r in probs.items()])


def quantile_bins_approx(df: DataFrame, states: DataFrame, bins: dict[str, int], names: dict[str, str]) -> DataFrame:
    """As ``binning.quantile_bins``, with the edges from merged states: no pass over the rows to find them.

    An edge's rank is off by ``rank_error`` at most; between two values it is one of them.
    """
    edges = merged_quantiles(states, {c: bin_probs(q) for c, q in bins.items()})
    return (
        attach_row(df, edges, "_edges")
        .withColumns({names[c]: bin_of(c, f"_edges.{c}", q) for c, q in bins.items()})
        .drop("_edges")
    )


def distinct_states(df: DataFrame, column: str, by: Sequence[str], bits: int = DISTINCT_BITS) -> DataFrame:
    """One row for each ``by`` (a key and a period): a mergeable sketch ``state`` of the different values."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, bits).alias("state"))


def merged_distinct(states: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Different values per key over all its periods. Up to some hundred values the count is exact; beyond, the
    standard error is 1.04 / sqrt(2 ** bits), 1.6 % for 12 bits."""
    return states.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias(name))

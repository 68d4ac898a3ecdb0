"""Approximate states against exact answers; tables kept by partition; CSV with bad lines."""

import re

import pytest
from pyspark.sql import functions as F

from tallycrest.operators import binning, sketches
from tallycrest.sources import sinks, tables


@pytest.mark.parametrize("items", [50, 800])
def test_merged_quantiles_lie_within_the_stated_rank_error(spark, items):
    """60,000 values in skewed periods, one of which holds most of them; half of them are one value."""
    rows = spark.range(60_000).selectExpr(
        "IF(id % 10 = 0, id DIV 10 % 24, 0) AS month", "IF(id % 2 = 0, 5.0, pow(pmod(hash(id), 1000), 2)) AS x",
        "CAST(NULL AS DOUBLE) AS nothing",
    )
    states = sketches.quantile_states(rows, ["x", "nothing"], ["month"], items)
    assert states.count() == 24
    probs = [0.0, 0.1, 0.4, 0.5, 0.9, 0.99, 1.0]
    got = sketches.merged_quantiles(states, {"x": probs, "nothing": probs}).first()
    assert got["nothing"] is None
    values = sorted(r["x"] for r in rows.select("x").collect())
    error = sketches.rank_error(items)
    for p, edge in zip(probs, got["x"]):
        below, upto = sum(v < edge for v in values) / len(values), sum(v <= edge for v in values) / len(values)
        assert below - error <= p <= upto + error
    assert (got["x"][0], got["x"][-1]) == (values[0], values[-1])


def test_approximate_bins_hold_about_equal_shares(spark):
    rows = spark.range(20_000).selectExpr("id", "id % 12 AS month", "CAST(pmod(hash(id), 100000) AS DOUBLE) AS x")
    states = sketches.quantile_states(rows, ["x"], ["month"])
    binned = sketches.quantile_bins_approx(rows, states, {"x": 4}, {"x": "bin"})
    exact = binning.quantile_bins(rows, {"x": 4}, {"x": "exact"}).select("id", "exact")
    off = binned.join(exact, "id").filter("bin <> exact").count()
    assert off <= 2 * 3 * sketches.rank_error() * 20_000  # rows between an edge and its estimate, three inner edges
    assert off < binned.count() / 20


def test_distinct_counts_merge_over_periods(spark):
    """Few values are counted exactly, however often; many within four standard errors."""
    rows = spark.range(90_000).selectExpr(
        "IF(id % 3 = 0, 'few', 'many') AS k", "id % 7 AS month", "IF(id % 3 = 0, id % 20, id DIV 2) AS v"
    )
    states = sketches.distinct_states(rows, "v", ["k", "month"])
    got = {r["k"]: r["n"] for r in sketches.merged_distinct(states, ["k"], "n").collect()}
    want = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert got["few"] == want["few"] == 20
    assert abs(got["many"] / want["many"] - 1) < 4 * 1.04 / 2 ** (sketches.DISTINCT_BITS / 2)


def test_a_rerun_replaces_its_partition_only_and_readers_prune(spark, tmp_path):
    path = str(tmp_path / "kept")
    sinks.write_partitions(spark.createDataFrame([(1, 2021), (2, 2022), (3, 2022)], "id int, year int"), path, ["year"])
    sinks.write_partitions(spark.createDataFrame([(9, 2022)], "id int, year int"), path, ["year"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 2021), (9, 2022)]
    one = tables.read_partitions(spark, path, "id int, year int", year=2022)
    assert [r["id"] for r in one.collect()] == [9]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 2022\)\]", plan)


def test_bad_lines_are_kept_aside(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("id,eur\n1,2.5\n2,many\n3\n4,1.0,extra\n5,\n")
    good, bad = tables.read_csv_checked(spark, str(path), "id bigint, eur double")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2.5), (5, None)]
    assert sorted(r["line"] for r in bad.collect()) == ["2,many", "3", "4,1.0,extra"]
    for _ in range(2):
        sinks.quarantine(bad, str(tmp_path / "bad"), "columns")
    assert spark.read.parquet(str(tmp_path / "bad")).groupBy("reason").count().collect()[0]["count"] == 6


def test_history_of_runs(spark):
    log = spark.createDataFrame([(2, 0.9, 0.5), (1, 0.8, 0.4), (3, 0.7, 0.6)], "training_date int, accuracy double, f1_score double")
    rows = [(r["training_date"], r["change"], r["best_so_far"]) for r in sinks.run_history(log).orderBy("training_date").collect()]
    assert rows[0] == (1, None, 0.8) and rows[2][2] == 0.9
    assert [r[1] for r in rows[1:]] == pytest.approx([0.1, -0.2])

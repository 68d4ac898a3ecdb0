"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, by rows and by bytes (long texts)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of ids kept for measuring; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


#: A group with more than this share of all rows counts as hot; fewer than 1,000 groups can.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str]) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row for each ``key`` of ``rows``, ``copies`` of them in ``rows``).

    Groups of more than a thousandth of all rows, fewer than 1,000, are sent to all tasks, so that their
    rows stay where they are; the others are shuffled, none of them a large share. Both sides are read
    several times: store them first. ``copies`` does not come along. A null key joins nothing and its rows are left out.
    """
    keys = [key] if isinstance(key, str) else key
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col("copies") * HOT_SHARE > F.lit(total)
    hot, cold = groups.filter(is_hot).drop("copies"), groups.filter(~is_hot).drop("copies")
    if not groups.filter(is_hot).take(1):
        return rows.join(cold, keys)
    in_place = rows.join(F.broadcast(hot), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return in_place.unionByName(others.join(cold, keys))

"""Writing results: tables (replace or append), CSV, clearing a table, the training run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycrest.sources.tables import RUN_LOG_SCHEMA


def write_table(df: DataFrame, path: str, overwrite: bool = True) -> None:
    df.write.mode("overwrite" if overwrite else "append").parquet(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write a table kept by partition: those that ``df`` has rows of are replaced, the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, overwrite: bool = True, batch_size: int = 10_000,
               **connection: str) -> None:
    """Bulk insert; replacing truncates the table and keeps its definition."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", batchsize=str(batch_size), **connection)
        .mode("overwrite" if overwrite else "append")
        .save()
    )


def clear_table(spark: SparkSession, path: str) -> None:
    """Remove all rows and keep the schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def quarantine(bad: DataFrame, path: str, reason: str) -> None:
    """Keep lines that could not be read, with the reason, beside earlier ones."""
    bad.withColumn("reason", F.lit(reason)).write.mode("append").parquet(path)


def append_run_log(spark: SparkSession, path: str, run: dict[str, object]) -> None:
    """Add one training run; the columns are those of ``RUN_LOG_SCHEMA``."""
    row = spark.createDataFrame([run], RUN_LOG_SCHEMA)
    write_table(row, path, overwrite=False)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Accuracy and F1 over time, one row per run."""
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return log.withColumn("training_date", log["training_date"].try_cast("timestamp_ntz")).orderBy("training_date")


def run_history(log: DataFrame) -> DataFrame:
    """Accuracy over training dates: each run with the change since the run before and the best accuracy so far.

    The log has one row for each training, so a single window over it is small.
    """
    by_date = Window.partitionBy(F.lit(1)).orderBy("training_date")
    return log.select(
        "training_date", "accuracy", "f1_score",
        (F.col("accuracy") - F.lag("accuracy").over(by_date)).alias("change"),
        F.max("accuracy").over(by_date).alias("best_so_far"),
    )

"""Reading the input tables: parquet, CSV and JDBC, always by an explicit column list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.functions.columns import money_sum
from tallycrest.session import materialize

# The columns each pipeline reads, and the CSV layouts.
SALES_COLUMNS = [
    "order_no", "line_no", "sales_id", "customer_id", "egroup", "tran_type", "order_date",
    "efftive_date", "qty", "eur", "cust_country", "sector",
]
BACKLOG_COLUMNS = ["customer_id", "sales_id", "eur", "efftive_date"]
FUTURE_BACKLOG_SCHEMA = "tran_type string, efftive_date timestamp_ntz, eur double, sales_id bigint"
RUN_LOG_SCHEMA = (
    "training_date string, optimizer string, loss_function string, hidden_layers string, "
    "cross_validation string, accuracy double, loss double, f1_score double"
)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line and a declared schema, so no pass is spent on inference."""
    return spark.read.option("header", True).schema(schema).csv(path)


BAD_LINE = "_bad_line"


def read_csv_checked(
    spark: SparkSession, path: str, schema: str, header: bool = True, name: str = "csv-lines"
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the rows of a CSV that fit the declared schema, and the lines that do not, as text.

    A line is bad if a field cannot be read as its type or the number of fields differs. Lines are parsed once
    and stored, so both answers come from one reading.
    """
    lines = (
        spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
        .schema(f"{schema}, {BAD_LINE} string").csv(path)
    )
    stored = materialize(lines, name)
    bad = stored.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))
    return stored.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE), bad


def read_partitions(spark: SparkSession, path: str, schema: str | None = None, **partition: object) -> DataFrame:
    """A table kept by partition; ``partition`` names the values wanted, and no other folders are read."""
    table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for name, value in partition.items():
        table = table.filter(F.col(name) == F.lit(value))
    return table


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 200,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column it runs as ``partitions`` range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if partition_column:
        if not bounds:
            raise ValueError("a partitioned scan needs the bounds of the partition column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Scan a database table; see ``jdbc_options``. Filters and columns are pushed to the database."""
    table = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return table.select(*columns) if columns else table


def first_rows(df: DataFrame, count: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``count`` rows in a stated order."""
    return df.orderBy(*order).limit(count)


def revenue_by_customer(lines: DataFrame) -> DataFrame:
    """Signed revenue of all lines per customer."""
    return (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(money_sum("eur").alias("eur"))
    )

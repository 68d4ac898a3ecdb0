"""The pipeline inputs derived from the star-schema test tables (FIXTURES.md).

A view joins only the tables that the requested columns need: inner joins on keys
that always match change no rows, and the optimizer cannot drop them by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.functions.columns import MONTH_NAMES, NO_BREAK_SPACE, decimal_sum
from tallycrest.session import materialize
from tallycrest.sources.tables import BACKLOG_COLUMNS, SALES_COLUMNS

# Sector -> (master sector, account type).
SECTOR_ROWS = [
    ("AUTOMOBILE", "IIoT", "KA"),
    ("BUILDING", "SIOT", "CP"),
    ("FURNITURE", "CIOT", "AOL"),
    ("MACHINERY" + NO_BREAK_SPACE, "EIoT", "KA"),
]
CUSTOMER_TYPES = ["AOL", "CP", "KA"]
MASTER_SECTORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# The test tables' columns, declared so that no scan is spent on finding them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


class TestViews:
    """Views over the parquet tables of one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that several steps of one query share, written once."""
        if name not in self._stored:
            self._stored[name] = materialize(build(), name)
        return self._stored[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def customers(self) -> DataFrame:
        c, n = self.table("customer"), self.table("nation")
        return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("n_name").alias("cust_country"),
            F.col("c_mktsegment").alias("sector"),
        )

    def sales(self, columns: Sequence[str] = SALES_COLUMNS, only: str | None = None) -> DataFrame:
        """``only`` names a transaction type; it is filtered by the stored column, so the scan can skip rows."""
        wanted = set(columns)
        lines = self.table("lineitem")
        if only:
            status = F.col("l_linestatus")
            lines = lines.filter(status == "F" if only == "Shipment" else status != "F")
        if wanted & {"customer_id", "order_date", "cust_country", "sector"}:
            orders = self.table("orders").select(
                "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date")
            )
            if wanted & {"cust_country", "sector"}:
                orders = orders.join(self.customers(), "customer_id")
            lines = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        if "egroup" in wanted:
            part = self.table("part").select("p_partkey", F.col("p_brand").alias("egroup"))
            lines = lines.join(part, lines["l_partkey"] == part["p_partkey"])
        price = F.col("l_extendedprice")
        named = {
            "order_no": F.col("l_orderkey"),
            "line_no": F.col("l_linenumber"),
            "sales_id": F.col("l_suppkey"),
            "tran_type": F.when(F.col("l_linestatus") == "F", "Shipment").otherwise("Backlog"),
            "efftive_date": F.col("l_shipdate"),
            "qty": F.col("l_quantity"),
            "eur": F.when(F.col("l_returnflag") == "R", -price).otherwise(price),
        }
        return lines.select(*[named[c].alias(c) if c in named else F.col(c) for c in columns])

    def opportunity(self) -> DataFrame:
        orders = self.table("orders").filter(F.col("o_orderstatus") == "P")
        # only the lines of these few orders are grouped
        lines = self.table("lineitem").join(
            orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi"
        )
        reps = lines.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("rep"))
        key = F.col("o_orderkey")
        digit = F.substring("o_orderpriority", 1, 1)
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        return orders.join(reps, orders["o_orderkey"] == reps["l_orderkey"]).select(
            key.alias("opportunity_id"),
            F.col("o_custkey").alias("erp_id"),
            F.col("o_totalprice").alias("amount"),
            F.when(digit == "1", 100.0).when(digit == "2", 75.0).when(digit == "3", 50.0)
            .when(digit == "5", 0.0).alias("probability"),
            F.when(key % 101 == 0, "unknown")
            .when(key % 97 == 0, F.concat(F.lit("3024"), F.substring(day, 5, 6)))
            .otherwise(day).alias("close_date"),
            F.col("o_orderdate").alias("created_date"),
            F.when(key % 89 == 0, "n/a").otherwise(F.col("rep").cast("string")).alias("sales_code_text"),
        )

    def quota(self) -> DataFrame:
        lines, part = self.table("lineitem"), self.table("part").select("p_partkey", "p_retailprice")
        reps = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "s_name", "n_name", "r_name")
        )
        amounts = (
            lines.join(part, lines["l_partkey"] == part["p_partkey"])
            .groupBy(
                F.col("l_suppkey").alias("sales_id"),
                F.year("l_shipdate").alias("year_id"),
                F.month("l_shipdate").alias("month_id"),
            )
            .agg(decimal_sum(F.col("l_quantity") * F.col("p_retailprice"), 2).alias("total"))
        )
        name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.col("month_id"))
        return amounts.join(reps, F.col("sales_id") == F.col("s_suppkey")).select(
            "sales_id",
            F.col("s_name").alias("sales_name"),
            "year_id",
            F.when(F.col("sales_id") % 2 == 0, F.col("month_id").cast("string")).otherwise(name).alias("month"),
            (F.col("total") / 1000.0).alias("amount"),
            F.col("r_name").alias("master_sector"),
            F.col("n_name").alias("fact_entity"),
        )

    def _backlog(self) -> DataFrame:
        return self.sales(BACKLOG_COLUMNS, only="Backlog")

    def backlog_history(self) -> DataFrame:
        return self._backlog().filter(F.col("efftive_date") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
            *BACKLOG_COLUMNS
        )

    def backlog_current(self) -> DataFrame:
        return self._backlog().filter(F.col("efftive_date") >= F.lit("1999-01-01").cast("timestamp_ntz")).select(
            *BACKLOG_COLUMNS
        )

    def future_backlog(self) -> DataFrame:
        lines = self.sales(["sales_id", "eur", "tran_type", "efftive_date"], only="Backlog")
        in_2001 = "efftive_date >= TIMESTAMP_NTZ '2001-01-01' AND efftive_date < TIMESTAMP_NTZ '2002-01-01'"
        return lines.filter(in_2001).withColumn("efftive_date", F.col("efftive_date") + F.expr("INTERVAL 1 YEAR"))

    def sector_map(self) -> DataFrame:
        rows = ", ".join(f"('{s}', '{m}', '{t}')" for s, m, t in SECTOR_ROWS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(sector, master_sector, customer_type)")

    def predictions(self) -> DataFrame:
        labels, docs = self.table("labels"), self.table("documents").select("doc_id", "n_chars")
        kind = F.element_at(F.array(F.lit("KA"), F.lit("CP"), F.lit("AOL")), (F.col("doc_id") % 3 + 1).cast("int"))
        wrong = F.col("n_chars") % 5 == 0
        return labels.join(docs, "doc_id").select(
            F.col("doc_id").alias("customer_id"),
            F.col("quality").alias("target_encoded"),
            F.when(wrong, 1 - F.col("quality")).otherwise(F.col("quality")).alias("predictions"),
            (0.5 + (F.col("doc_id") % 50) / F.lit(100.0)).alias("probability"),
            kind.alias("customer_type"),
            F.col("n_chars").cast("double").alias("qty"),
        )

    def neighbours(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("customer_id"),
            F.when(F.col("label") < 7, 1).otherwise(0).alias("target_encoded"),
            F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        )

"""A demand panel made of the order tables: suppliers are centers, part types are meals, months are periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.joins import enrich
from panelwright.operators.rows import time_slice
from panelwright.operators.splits import Bounds, Holdout, holdout_split
from panelwright.spec import PanelSpec

# One row per series and month, and lines are shipped in 83 months: no series has more rows than that.
SPEC = PanelSpec(("center_id", "meal_id"), "week", "id", "num_orders", max_rows=83)
# The last ten months are the future, the ten before them the back-test; ``bounds`` reads the same from the data.
BOUNDS = Bounds(start=1, train_time=63, test_time=73, end=83)
CATEGORICAL = ("center_id", "meal_id", "category", "cuisine", "city_code", "region_code", "center_type")
PRICES = ("base_price", "checkout_price")
FLAGS = ("emailer_for_promotion", "homepage_featured")
RAW_FEATURES = (
    "center_id", "meal_id", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured",
    "city_code", "region_code", "center_type", "op_area", "category", "cuisine", "week",
)

# Part type to meal number, category and cuisine.
MEALS = (
    (1, "Core", "ECONOMY"),
    (2, "Size", "LARGE"),
    (3, "Size", "MEDIUM"),
    (4, "Deal", "PROMO"),
    (5, "Size", "SMALL"),
    (6, "Core", "STANDARD"),
)
FIRST_YEAR = 1995
# Larger than any month number and any meal number, so that ids are unique for any number of centers.
MONTHS, MEAL_NUMBERS = 1000, 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly panel of all lines; the join reads two part columns."""
    shipped = F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem")
    kind = F.lit(6)
    for number, _, p_type in reversed(MEALS[:-1]):
        kind = F.when(F.col("p_type") == p_type, number).otherwise(kind)
    parts = table(spark, sf_dir, "part").select("p_partkey", kind.cast("int").alias("meal_id"))
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        ((F.year(shipped) - FIRST_YEAR) * 12 + F.month(shipped)).cast("int").alias("week"),
        F.col("l_suppkey").cast("bigint").alias("center_id"),
        "meal_id", "l_extendedprice", "l_discount", "l_returnflag", "l_quantity",
    )
    cents = lambda c: F.round(c * 100).cast("bigint")
    grouped = rows.groupBy("week", "center_id", "meal_id").agg(
        cents(F.min("l_extendedprice")).alias("checkout_price"),
        cents(F.max("l_extendedprice")).alias("base_price"),
        F.max(F.when(F.col("l_discount") >= 0.09, 1).otherwise(0)).alias("emailer_for_promotion"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("homepage_featured"),
        F.sum("l_quantity").cast("bigint").alias("num_orders"),
    )
    row_id = (F.col("center_id") * MONTHS + F.col("week")) * MEAL_NUMBERS + F.col("meal_id")
    return grouped.select(row_id.cast("bigint").alias("id"), *grouped.columns)


def center_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    balance = F.col("s_acctbal")
    kind = F.when(balance < 2000, "TYPE_A").when(balance < 6000, "TYPE_B").otherwise("TYPE_C")
    return table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("bigint").alias("center_id"),
        F.col("s_nationkey").alias("city_code"),
        F.col("n_regionkey").alias("region_code"),
        kind.alias("center_type"),
        balance.alias("op_area"),
    )


def meal_info(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"({number}, '{category}', '{cuisine}')" for number, category, cuisine in MEALS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS m(meal_id, category, cuisine)")


def split(spark: SparkSession, sf_dir: str) -> Holdout:
    """History up to month 73, months 74-83 with their target emptied, and the true targets of those months."""
    return holdout_split(panel(spark, sf_dir), "week", "id", "num_orders", BOUNDS.end, BOUNDS.tstep)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_slice(panel(spark, sf_dir), "week", upto=BOUNDS.test_time)


def with_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and rows to forecast in one scan: the target is empty after the last known month."""
    return panel(spark, sf_dir).withColumn(
        "num_orders", F.when(F.col("week") <= BOUNDS.test_time, F.col("num_orders"))
    )


def enriched(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Panel rows with both dimensions, target last."""
    rows = panel(spark, sf_dir) if rows is None else rows
    return enrich(rows, {"center_id": center_info(spark, sf_dir), "meal_id": meal_info(spark)}, last="num_orders")

"""Outlier orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.quantiles import exact_quantiles

# Fixed values.
PLACEHOLDER_QUANTITIES = (9999, 999, 9998, 1000)
THRESHOLD = "0.99"


def order_aggregates(fact: DataFrame) -> DataFrame:
    """Totals per order; lines are combined on the map side."""
    return fact.groupBy("order_id").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total_usd").alias("total_order_value_usd"),
        F.count("*").alias("line_item_count"),
        F.max("quantity").alias("max_line_quantity"),
        F.max("line_total_usd").alias("max_line_value_usd"),
        F.avg("unit_price").alias("avg_unit_price"),
    )


def line_thresholds(fact: DataFrame, threshold: str = THRESHOLD) -> DataFrame:
    """One row: the quantity and the value that `threshold` of the lines do not exceed.

    One pass over the fact serves both measures; they are compared as doubles.
    """
    measures = F.array(
        F.struct(F.lit("quantity").alias("measure"), F.col("quantity").cast("double").alias("amount")),
        F.struct(F.lit("value").alias("measure"), F.col("line_total_usd").cast("double").alias("amount")),
    )
    rows = fact.select(F.explode(measures).alias("m")).select("m.*")
    limits = exact_quantiles(rows, "amount", [threshold], ["measure"], few_groups=True)
    return limits.agg(
        F.max(F.when(F.col("measure") == "quantity", F.col("value"))).alias("quantity"),
        F.max(F.when(F.col("measure") == "value", F.col("value"))).alias("value"),
    )


def flag_orders(fact: DataFrame, threshold: str = THRESHOLD) -> DataFrame:
    """Every order with its five flags.

    The value rule compares the order total with the 99th percentile of single lines, as the
    dashboards expect. The thresholds are one scalar subquery that runs once.
    """
    limits = line_thresholds(fact, threshold).select(F.struct("quantity", "value").alias("limits")).scalar()
    orders = order_aggregates(fact)
    quantity, value = F.col("max_line_quantity"), F.col("total_order_value_usd")

    def flag(condition):
        return F.coalesce(condition, F.lit(False))

    return (
        orders.withColumns(
            {
                "is_placeholder_quantity": flag(quantity.isin(*PLACEHOLDER_QUANTITIES)),
                "is_high_quantity_outlier": flag(quantity.cast("double") > limits["quantity"]),
                "is_high_value_outlier": flag(value.cast("double") > limits["value"]),
                "is_suspicious_pattern": flag((F.col("line_item_count") > 1) & (F.col("avg_unit_price") == 0)),
            }
        )
        .withColumn(
            "is_outlier",
            F.col("is_placeholder_quantity") | F.col("is_high_quantity_outlier") | F.col("is_high_value_outlier"),
        )
        .select(
            "order_id", "total_quantity", "total_order_value_usd", "max_line_quantity", "max_line_value_usd",
            "is_placeholder_quantity", "is_high_quantity_outlier", "is_high_value_outlier",
            "is_suspicious_pattern", "is_outlier",
        )
    )


def sales_outliers(fact: DataFrame, threshold: str = THRESHOLD, flags_only: bool = False) -> DataFrame:
    """Orders with an outlier flag; `flags_only` keeps all orders."""
    flagged = flag_orders(fact, threshold)
    return flagged if flags_only else flagged.where(F.col("is_outlier"))


def outlier_summary(outliers: DataFrame, fact: DataFrame) -> DataFrame:
    """One monitoring row: flagged orders by rule, their value, and their share of all orders."""
    total = fact.agg(F.count_distinct("order_id").alias("n")).scalar()

    def hits(flag: str):
        return F.sum(F.col(flag).cast("bigint"))

    summary = outliers.agg(
        F.count_distinct("order_id").alias("total_outlier_orders"),
        hits("is_placeholder_quantity").alias("placeholder_quantity_count"),
        hits("is_high_quantity_outlier").alias("high_quantity_count"),
        hits("is_high_value_outlier").alias("high_value_count"),
        hits("is_suspicious_pattern").alias("suspicious_pattern_count"),
        F.round(F.sum("total_order_value_usd"), 2).alias("total_outlier_revenue_usd"),
        F.round(F.avg("total_order_value_usd"), 2).alias("avg_outlier_order_value_usd"),
    )
    share = F.round(F.try_divide(F.col("total_outlier_orders") * F.lit(100.0), F.col("total_orders_in_dataset")), 2)
    return summary.withColumn("total_orders_in_dataset", total).withColumn("pct_of_total_orders", share)

"""Panels built from the driver tables.

``macro_raw``     the three provider raw tables (15 catalog series + one
                  retired series), see :mod:`panelspark.sources.derived`.
``customer_panel`` one series per customer, one row per order day
                  (scale panel: series count grows with the data).
``user_panel``     one series per user, one row per event timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import stage_iso_dates, stage_mixed_dates, stage_period_dates, union_sources
from ..sources import derived


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = derived.raw_tables(spark, sf_dir)
    return {
        "stg_iso": stage_iso_dates(raw["iso"]),
        "stg_mixed": stage_mixed_dates(raw["mixed"]),
        "stg_periods": stage_period_dates(raw["periods"]),
    }


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staged(spark, sf_dir)
    return union_sources(s["stg_iso"], s["stg_mixed"], s["stg_periods"])


def customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id BIGINT, date DATE, value DOUBLE): order value per customer and day."""
    o = derived.read_table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("series_id"), F.col("o_orderdate").cast("date").alias("date")).agg(
        derived.from_cents(F.sum(derived.cents("o_totalprice"))).alias("value")
    )


def balance_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer panel whose values are small whole numbers from -3 to 3: zero and negative denominators occur."""
    cp = customer_panel(spark, sf_dir)
    return cp.withColumn("value", (F.pmod(derived.cents("value"), F.lit(7)) - 3).cast("double"))


def defective(tall: DataFrame) -> DataFrame:
    """The tall mart with one defect for each check, so that every check both passes and fails somewhere.

    Two series lose or gain latest rows, one expected series has another id, and some rows have a category, signal
    or trend outside the lists, no value or no name.
    """
    sid, month = F.col("series_id"), F.month("date")
    hit = lambda s, m=None: (sid == s) & (month == m if m else F.lit(True))
    return tall.withColumns(
        {
            "is_latest": F.when(hit("devkum/USD1"), False).when(hit("devkum/EUR1", 1), True).otherwise(F.col("is_latest")),
            "indicator_category": F.when(hit("KEI/CHE/EX/_T/G1", 4), "housing").otherwise(F.col("indicator_category")),
            "signal": F.when(hit("KEI/CHE/PRVM/C/GY", 2), "buy").otherwise(F.col("signal")),
            "trend": F.when(hit("KEI/CHE/PRVM/C/GY", 3), "sideways").otherwise(F.col("trend")),
            "value": F.when(hit("KEI/CHE/CP/_Z/GY", 5), F.lit(None).cast("double")).otherwise(F.col("value")),
            "indicator_name": F.when(hit("KEI/CHE/TOVM/G47/GY", 6), F.lit(None).cast("string")).otherwise(F.col("indicator_name")),
            "series_id": F.when(hit("KEI/CHE/EMP/_T/_Z"), "KEI/CHE/EMP/_T/_Y").otherwise(sid),
        }
    )


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id BIGINT, ts TIMESTAMP, value DOUBLE): events per user; (user, ts) is unique."""
    ev = derived.read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("series_id"), "ts", "value")


def shipment_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot-key panel: one series per line status (two keys, about half of
    ``lineitem`` each), one row per line, ordered by ship date with
    (order, line number, price) as tie-break — unique in the driver data."""
    li = derived.read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linestatus").alias("series_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("value"),
    )

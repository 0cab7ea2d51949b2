"""High-risk regions as rows and as message lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Threshold and wording of the alert.
THRESHOLD = 0.6
REQUIRED = ("R_total", "admin_names", "risk_level")
MARKS = {"VERY_HIGH": "🔴", "HIGH": "🟠"}
OTHER_MARK = "⚠️"
HEADER = "*🚨 기상 위험 지역 알림*"
ALL_CLEAR = "✅ *기상 위험 알림* | 현재 위험 지역 없음"
SCORE_LABEL = "위험도"
TIME_LABEL = "예보"
UNKNOWN_REGION = "알 수 없음"
NO_SCORE = "-"


def alert_rows(latest: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows at or above the threshold; raises when a needed column is missing."""
    missing = [c for c in REQUIRED if c not in latest.columns]
    if missing:
        raise ValueError(f"the latest table lacks {missing}")
    return latest.where(F.col("R_total") >= threshold)


def alert_lines(latest: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The message, one row per line: the header and a line per region, or the all-clear line.

    ``part`` is 0 for the single opening line and 1 for regions.
    """
    rows = alert_rows(latest, threshold)
    mark = F.lit(OTHER_MARK)
    for level, sign in MARKS.items():
        mark = F.when(F.col("risk_level") == level, sign).otherwise(mark)
    score = F.when(F.col("R_total").isNotNull(), F.format_string("%.2f", F.col("R_total"))).otherwise(NO_SCORE)
    time = F.date_format("fcst_ts", "yyyy-MM-dd HH:mm:ss") if "fcst_ts" in rows.columns else F.lit("")
    line = F.concat(
        mark, F.lit(" *"), F.coalesce("admin_names", F.lit(UNKNOWN_REGION)),
        F.lit(f"*  |  {SCORE_LABEL}: `"), score, F.lit("` ("), F.coalesce("risk_level", F.lit("")),
        F.lit(f")  |  {TIME_LABEL}: "), F.coalesce(time, F.lit("")),
    )
    opening = latest.agg(F.count_if(F.col("R_total") >= threshold).alias("n")).select(
        F.lit(0).alias("part"), F.when(F.col("n") == 0, ALL_CLEAR).otherwise(HEADER).alias("line")
    )
    return opening.unionByName(rows.select(F.lit(1).alias("part"), line.alias("line")))


def run_summary(latest: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """High-risk and total counts of a table of regions."""
    return latest.agg(
        F.count_if(F.col("R_total") >= threshold).alias("high_risk"), F.count("*").alias("total")
    )


def feed_summary(feed: DataFrame) -> DataFrame:
    """Rows, distinct hours, and first and last time of a feed."""
    return feed.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("fcstTime").alias("hours"),
        F.min("fcstTime").alias("first_time"),
        F.max("fcstTime").alias("last_time"),
    )

"""Dashboard roll-ups over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def signal_rollup(signals: DataFrame) -> DataFrame:
    """Sessions, decisions and friction by (model, user), by model, and overall.

    `level` is 0 for (model, user) rows, 1 for model rows and 3 for the total.
    """
    return (
        signals.rollup("primary_model", "user_id")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count(F.lit(1)).alias("sessions"),
            F.sum("num_tool_decisions").alias("decisions"),
            F.sum("num_tool_rejects").alias("rejects"),
            F.sum("num_corrections").alias("corrections"),
            F.avg("human_friction_score").alias("avg_friction"),
        )
    )


def daily_scores(scores: DataFrame) -> DataFrame:
    """Sessions, cost and composite score per day of the session start."""
    return scores.groupBy(F.to_date("session_start").alias("day")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("total_cost_usd").alias("cost_usd"),
        F.avg("composite_score").alias("avg_composite"),
        F.min("composite_score").alias("min_composite"),
        F.max("composite_score").alias("max_composite"),
    )

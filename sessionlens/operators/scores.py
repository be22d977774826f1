"""Rule-based quality scores of a session, each from 0 to 100."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.arithmetic import capped, floored


def visible_error_counts(events: DataFrame) -> DataFrame:
    """Errors the person saw, per session that has any."""
    return (
        events.filter(F.col("error_category") == v.USER_VISIBLE)
        .groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("visible_error_count"))
    )


def _or(name: str, default: float) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(default))


def _interactions() -> Column:
    return F.col("num_interactions").cast("double")


def efficiency_score() -> Column:
    """Up to 60 for cache hits, up to 40 for cost; 10 cents per interaction give none of it."""
    cost = _or("total_cost_usd", 0.0) / floored(_interactions(), 1.0)
    return capped(_or("cache_hit_rate", 0.0) * 60 + floored(F.lit(40.0) - cost * 400), 100)


def productivity_score() -> Column:
    """Half for two tools per interaction, half for five interactions."""
    tools = _or("num_tool_calls", 0.0) / floored(_interactions(), 1.0) * 25
    return capped(capped(tools, 50) + capped(_interactions() * 10, 50), 100)


def quality_score() -> Column:
    """Up to 70 for tool success, up to 30 that two visible errors use up."""
    errors = floored(F.lit(30.0) - _or("visible_error_count", 0.0) * 15)
    return capped(_or("tool_success_rate", 1.0) * 70 + errors, 100)


def autonomy_score() -> Column:
    return _or("auto_accept_rate", 0.0) * 100


def engagement_score() -> Column:
    """Half for a minute of duration, half for 50 characters per prompt."""
    duration = _or("session_duration_s", 0.0) / 60 * 50
    return capped(capped(duration, 50) + capped(_or("avg_prompt_length", 0.0), 50), 100)


def rule_scores(
    summary: DataFrame,
    visible_errors: DataFrame,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Summary rows with the five rule scores and their weighted composite."""
    weights = weights or v.COMPOSITE_WEIGHTS
    composite = None
    for name, weight in weights.items():
        part = F.col(name) * F.lit(weight)
        composite = part if composite is None else composite + part
    return (
        summary.join(visible_errors, "session_id", "left")
        .withColumn("visible_error_count", F.coalesce("visible_error_count", F.lit(0)))
        .withColumns(
            {
                "efficiency_score": efficiency_score(),
                "productivity_score": productivity_score(),
                "quality_score": quality_score(),
                "autonomy_score": autonomy_score(),
                "engagement_score": engagement_score(),
            }
        )
        .withColumn("composite_score", composite)
    )

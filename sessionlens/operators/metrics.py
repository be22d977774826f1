"""Metric points -> one row per session: cost, tokens, active time, primary model.

The points are read once. A first aggregate by (session, model, effort) does all
conditional sums with map-side combine, so a session that holds most of the
points still arrives as a handful of rows; a second one folds these into the
session and picks the dearest model on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.attributes import SESSION_KEY, attr
from sessionlens.functions.arithmetic import count_when

_POINT_ATTRIBUTES = "sum.attributes"
_TOKENS = list(v.TOKEN_TYPES.values())
_ACTIVE = list(v.ACTIVE_TIME_TYPES.values())


def _points(metrics: DataFrame, *names: str) -> DataFrame:
    """Points of the named metrics that belong to a session."""
    return metrics.filter(F.col("name").isin(*names)).select(
        attr(SESSION_KEY, _POINT_ATTRIBUTES).alias("session_id"),
        "name",
        F.col("sum.value").alias("value"),
        attr("type", _POINT_ATTRIBUTES).alias("type"),
        attr("model", _POINT_ATTRIBUTES).alias("model"),
        attr("effort", _POINT_ATTRIBUTES).alias("effort"),
    ).filter(F.col("session_id").isNotNull())


def _pivot(metric: str, types: dict[str, str]) -> list[Column]:
    """One conditional sum per `type`; other types of the same metric add 0."""
    return [
        F.sum(
            F.when(
                F.col("name") == metric,
                F.when(F.col("type") == kind, F.col("value")).otherwise(F.lit(0.0)),
            )
        ).alias(column)
        for kind, column in types.items()
    ]


def _cost() -> Column:
    return F.sum(F.when(F.col("name") == v.METRIC_COST, F.col("value")))


def _dearest_model() -> Column:
    """Model and effort with the largest cost; NULL cost last, then by name."""
    candidate = F.when(
        F.col("cost_points") > 0,
        F.struct(
            F.col("cost").isNull().alias("no_cost"),
            (-F.col("cost")).alias("cost_rank"),
            F.col("model"),
            F.col("effort"),
        ),
    )
    return F.min(candidate)


def cost_by_session(metrics: DataFrame) -> DataFrame:
    return _points(metrics, v.METRIC_COST).groupBy("session_id").agg(
        _cost().alias("total_cost_usd")
    )


def token_pivot(metrics: DataFrame) -> DataFrame:
    return _points(metrics, v.METRIC_TOKENS).groupBy("session_id").agg(
        *_pivot(v.METRIC_TOKENS, v.TOKEN_TYPES)
    )


def active_time_pivot(metrics: DataFrame) -> DataFrame:
    return _points(metrics, v.METRIC_ACTIVE_TIME).groupBy("session_id").agg(
        *_pivot(v.METRIC_ACTIVE_TIME, v.ACTIVE_TIME_TYPES)
    )


def cost_by_model(metrics: DataFrame) -> DataFrame:
    """Cost per (session, model, effort)."""
    return _points(metrics, v.METRIC_COST).groupBy("session_id", "model", "effort").agg(
        _cost().alias("model_cost")
    )


def primary_model(metrics: DataFrame) -> DataFrame:
    """The (model, effort) pair each session spent most on."""
    by_model = _points(metrics, v.METRIC_COST).groupBy("session_id", "model", "effort").agg(
        _cost().alias("cost"), F.count(F.lit(1)).alias("cost_points")
    )
    best = by_model.groupBy("session_id").agg(_dearest_model().alias("best"))
    return best.select(
        "session_id",
        F.col("best.model").alias("primary_model"),
        F.col("best.effort").alias("effort_level"),
    )


def session_metrics(metrics: DataFrame) -> DataFrame:
    """One row per session with any cost, token or active-time point."""
    by_model = (
        _points(metrics, v.METRIC_COST, v.METRIC_TOKENS, v.METRIC_ACTIVE_TIME)
        .groupBy("session_id", "model", "effort")
        .agg(
            _cost().alias("cost"),
            count_when(F.col("name") == v.METRIC_COST).alias("cost_points"),
            *_pivot(v.METRIC_TOKENS, v.TOKEN_TYPES),
            *_pivot(v.METRIC_ACTIVE_TIME, v.ACTIVE_TIME_TYPES),
        )
    )
    folded = by_model.groupBy("session_id").agg(
        F.sum("cost").alias("total_cost_usd"),
        *[F.sum(column).alias(column) for column in _TOKENS + _ACTIVE],
        _dearest_model().alias("best"),
    )
    return folded.select(
        "session_id",
        "total_cost_usd",
        *_TOKENS,
        *_ACTIVE,
        F.col("best.model").alias("primary_model"),
        F.col("best.effort").alias("effort_level"),
    )

"""Order inside a session without putting a whole session into one task.

A session may hold a large share of all events, so no operator sorts the events of a
session in one group. Events are cut into time buckets of a session, and a bucket that
holds many events is cut again into leaves: the counts of its cells of 10 ms are summed up in
the order of time, and a leaf ends where `LEAF_EVENTS` are reached. Sums inside a leaf are
windows over (session, leaf); sums over earlier leaves come from one row per leaf.

Bounds: a bucket has at most `bucket_s` * 100 cells. A leaf has fewer than `LEAF_EVENTS` events and
one more cell; a cell has at most 10,000 instants, and what operators order in a leaf is
one row per instant and type, however many events it stands for. Events without a timestamp
share one instant. A session has one leaf per bucket of its life, and one more per
`LEAF_EVENTS` events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens import vocabulary as v

BUCKET_S = 60
CELL_MICROS = 10_000
LEAF_EVENTS = 5_000
# Events without a timestamp come first in a session, as NULL sorts first.
NO_TIME = -(2**62)


def micros() -> Column:
    """Position of an event in time; `NO_TIME` without a timestamp."""
    return F.coalesce(F.unix_micros("event_ts"), F.lit(NO_TIME))


def whole_second(micros_column: str) -> Column:
    """Epoch second, rounded down as a cast of the timestamp does."""
    t = F.col(micros_column)
    return F.floor((t - F.pmod(t, F.lit(1_000_000))) / F.lit(1e6))


def bucket(micros_column: Column, bucket_s: int) -> Column:
    return F.floor(micros_column / F.lit(bucket_s * 1e6))


def located(events: DataFrame, bucket_s: int) -> DataFrame:
    """Events of known sessions with their time `t` and time bucket `b`."""
    return (
        events.filter(F.col("session_id").isNotNull())
        .withColumn("t", micros())
        .withColumn("b", bucket(F.col("t"), bucket_s))
    )


def _cells(events: DataFrame, bucket_s: int) -> DataFrame:
    """Counts per (session, bucket, cell); a cell is named by its first microsecond."""
    prompt = F.col("event_type") == v.USER_PROMPT
    earlier_type = F.coalesce(F.col("event_type") < v.USER_PROMPT, F.lit(True))
    return (
        located(events.select("session_id", "event_ts", "event_type"), bucket_s)
        .groupBy("session_id", "b", (F.col("t") - F.pmod("t", F.lit(CELL_MICROS))).alias("cell"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count(F.when(prompt, F.lit(1))).alias("prompts"),
            F.min(F.when(prompt, F.col("t"))).alias("prompt_t"),
            F.min(F.when(earlier_type, F.col("t"))).alias("earlier_t"),
            F.min(F.when(~prompt & ~earlier_type, F.col("t"))).alias("later_t"),
        )
    )


def leaf_offsets(
    events: DataFrame, bucket_s: int = BUCKET_S, most: int = LEAF_EVENTS
) -> DataFrame:
    """Per (session, bucket, leaf): events and prompts before it, and session totals.

    A leaf holds the events from `leaf` up to `leaf_end`, in microseconds; the last one of a
    bucket has no end. `has_prefix` says that the session starts with something else than a
    prompt; `leaf_events` and `leaf_prompts` are the leaf's own counts. Reads three columns
    of the events and combines on the map side.
    """
    bucket_order = Window.partitionBy("session_id", "b").orderBy("cell")
    before_cell = F.coalesce(
        F.sum("events").over(bucket_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    numbered = _cells(events, bucket_s).withColumn("number", F.floor(before_cell / F.lit(most)))
    leaves = numbered.groupBy("session_id", "b", "number").agg(
        F.min("cell").alias("leaf"),
        *[F.sum(name).alias(name) for name in ("events", "prompts")],
        *[F.min(name).alias(name) for name in ("prompt_t", "earlier_t", "later_t")],
    )
    next_leaf = F.lead("leaf").over(Window.partitionBy("session_id", "b").orderBy("number"))
    leaves = leaves.withColumn("leaf_end", next_leaf)
    session = Window.partitionBy("session_id")
    before = session.orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    first_prompt = F.min("prompt_t").over(session)
    starts_earlier = (F.min("earlier_t").over(session) <= first_prompt) | (
        F.min("later_t").over(session) < first_prompt
    )
    has_prefix = F.when(first_prompt.isNull(), F.lit(True)).otherwise(
        F.coalesce(starts_earlier, F.lit(False))
    )
    return leaves.select(
        "session_id",
        "b",
        "leaf",
        "leaf_end",
        F.coalesce(F.sum("events").over(before), F.lit(0)).alias("events_before"),
        F.coalesce(F.sum("prompts").over(before), F.lit(0)).alias("prompts_before"),
        F.col("events").alias("leaf_events"),
        F.col("prompts").alias("leaf_prompts"),
        has_prefix.cast("long").alias("has_prefix"),
        (F.sum("prompts").over(session) + has_prefix.cast("long")).alias("num_interactions"),
    )


def in_leaves(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Rows that `located` has placed, with the columns of their leaf's offsets."""
    leaf = offsets.withColumnsRenamed({"session_id": "_session", "b": "_b"})
    inside = (F.col("t") >= F.col("leaf")) & (
        F.col("leaf_end").isNull() | (F.col("t") < F.col("leaf_end"))
    )
    same = (F.col("session_id") == F.col("_session")) & (F.col("b") == F.col("_b"))
    return rows.join(leaf, same & inside).drop("_session", "_b")

"""A bounded text replay of each session.

The first and last `keep` interactions are printed line by line, each interaction
between them becomes one compressed line, and the text is cut at `budget`
characters.

Interactions and positions only depend on the instant and the type of an event, so the
events are first combined into slots: one row per (session, instant, type), and one per
prompt and its copies, as every prompt starts an interaction. Slots are placed in the
session by the sums of their leaf (see `ordering`). The compressed lines come from
slots alone. Text is read for the lines that are printed: the first events of
each slot in the order of their details, as many as can be printed at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.text import (
    fixed_point,
    shortest_number,
    text_or_none,
    timestamp_text,
)
from sessionlens.operators.ordering import (
    BUCKET_S,
    LEAF_EVENTS,
    NO_TIME,
    in_leaves,
    leaf_offsets,
    located,
    micros,
)

# Columns that order the events of a session after their time and type.
_DETAILS = (
    "detail_name",
    "model",
    "input_tokens",
    "output_tokens",
    "cost_usd",
    "error_category",
    "content_preview",
    "duration_ms",
)
COLUMNS = ("session_id", "event_ts", "event_type", *_DETAILS)
_HEAD, _MIDDLE, _TAIL = 0, 1, 2
# Copies are expanded in steps, so no array grows with their number.
_EXPANSION_STEP = 100_000


def event_line(event_ts: Column | None = None) -> Column:
    """One event as `time [type] name model=… tokens=in/out cost=$… err=… | preview`."""
    event_ts = F.col("event_ts") if event_ts is None else event_ts
    return F.concat(
        text_or_none(timestamp_text(event_ts)),
        F.lit(" ["),
        text_or_none(F.col("event_type")),
        F.lit("] "),
        text_or_none(F.col("detail_name")),
        F.lit(" model="),
        text_or_none(F.col("model")),
        F.lit(" tokens="),
        F.coalesce("input_tokens", F.lit(0)).cast("string"),
        F.lit("/"),
        F.coalesce("output_tokens", F.lit(0)).cast("string"),
        F.lit(" cost=$"),
        fixed_point(F.coalesce("cost_usd", F.lit(0.0)), 4),
        F.lit(" err="),
        F.coalesce("error_category", F.lit("")),
        F.lit(" | "),
        F.substring(
            F.coalesce("content_preview", F.lit("")), 1, v.REPLAY_PREVIEW_CHARS
        ),
    )


# Length of a line whose variable parts are as short as they get, and its newline.
SHORTEST_LINE = len("None [] None model= tokens=0/0 cost=$0.0000 err= | ") - len("None") + 1


def lines_within(budget: int) -> int:
    """Number of lines that can begin at or before the end of the budget.

    The line right at the end shows no character, but its newline does.
    """
    return budget // SHORTEST_LINE + 1


def _is_prompt() -> Column:
    return F.coalesce(F.col("event_type") == v.USER_PROMPT, F.lit(False))


def _slots(events: DataFrame, bucket_s: int) -> DataFrame:
    """One row per (session, instant, type), and one per prompt and its copies.

    `n` events cost `usd` and took `ms` together. Only prompts keep their details. Combined
    before any shuffle.
    """
    rows = located(events.select(*COLUMNS), bucket_s)
    details = [F.when(_is_prompt(), F.col(name)).alias(name) for name in _DETAILS]
    return rows.groupBy("session_id", "b", "t", "event_type", *details).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(rows["cost_usd"]).alias("usd"),
        F.sum(rows["duration_ms"]).alias("ms"),
    )


def _with_tail_end(offsets: DataFrame, keep: int) -> DataFrame:
    """`tail_end`: events up to the end of the leaf in which the tail begins.

    The tail begins before it, so no line `max_lines` or more behind it can show.
    """
    last_index = F.col("has_prefix") + F.col("prompts_before") + F.col("leaf_prompts") - 1
    reached = last_index >= F.col("num_interactions") - keep
    end = F.when(reached, F.col("events_before") + F.col("leaf_events"))
    return offsets.withColumn("tail_end", F.min(end).over(Window.partitionBy("session_id")))


def _placed_slots(
    events: DataFrame, bucket_s: int, keep: int | None = None, most: int = LEAF_EVENTS
) -> DataFrame:
    """Slots with the numbers of their interactions.

    `first_index` and `last_index` are the interactions a slot belongs to: they differ only
    for copies of a prompt, as each starts its own. `events_before` counts the events of
    the session that come before the slot.
    """
    offsets = leaf_offsets(events, bucket_s, most)
    if keep is not None:
        offsets = _with_tail_end(offsets, keep)
    earlier = (
        Window.partitionBy("session_id", "b", "leaf")
        .orderBy("t", "event_type", *_DETAILS)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    prompts = F.when(_is_prompt(), F.col("n")).otherwise(F.lit(0))
    begun = F.col("has_prefix") + F.col("prompts_before") + F.col("prompts_in_leaf")
    return (
        in_leaves(_slots(events, bucket_s), offsets)
        .withColumns(
            {
                "prompts_in_leaf": F.coalesce(F.sum(prompts).over(earlier), F.lit(0)),
                "events_in_leaf": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            }
        )
        .withColumns(
            {
                "first_index": F.when(_is_prompt(), begun).otherwise(begun - 1),
                "last_index": F.when(_is_prompt(), begun + F.col("n") - 1).otherwise(begun - 1),
                "events_before": F.col("events_before") + F.col("events_in_leaf"),
            }
        )
        .drop("b", "leaf", "leaf_end", "leaf_events", "leaf_prompts", "prompts_before")
        .drop("prompts_in_leaf", "events_in_leaf", "has_prefix")
    )


def _with_events(slots: DataFrame, events: DataFrame, t: str, kind: str, *more: Column):
    """`slots` with the events at instant `t` of type `kind`; others keep one row.

    The columns of an event come with a leading underscore. Instants and types name one slot
    each, so the join splits a slot with very many events, never a session.
    """
    events = events.withColumnsRenamed({name: f"_{name}" for name in events.columns})
    same = (
        (F.col("session_id") == F.col("_session_id"))
        & (F.col(t) == F.col("_t"))
        & F.col(kind).eqNullSafe(F.col("_event_type"))
    )
    for condition in more:
        same = same & condition
    return slots.join(events, same, "left")


def _others(events: DataFrame) -> DataFrame:
    """Events of known sessions that are not prompts, with their instant `t`."""
    rows = events.select(*COLUMNS).filter(F.col("session_id").isNotNull() & ~_is_prompt())
    return rows.withColumn("t", micros()).drop("event_ts")


def _explode_range(frame: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """One row per whole number of [low, high], none for an empty range."""
    step = F.lit(_EXPANSION_STEP).cast("long")
    return (
        frame.withColumns({"_low": low, "_high": high})
        .filter(F.col("_low") <= F.col("_high"))
        .withColumn("_step", F.explode(F.sequence("_low", "_high", step)))
        .withColumn(
            name,
            F.explode(
                F.sequence("_step", F.least("_high", F.col("_step") + (_EXPANSION_STEP - 1)))
            ),
        )
        .drop("_low", "_high", "_step")
    )


def _event_ts() -> Column:
    return F.when(F.col("t") > NO_TIME, F.timestamp_micros("t"))


def with_interaction_index(
    events: DataFrame, bucket_s: int = BUCKET_S, most: int = LEAF_EVENTS
) -> DataFrame:
    """Every event (replay columns) with the number of its interaction in the session.

    A new interaction starts at each prompt; events before the first prompt form
    interaction 0 of their own.
    """
    slots = _placed_slots(events, bucket_s, most=most)
    # Prompts have a slot of their own; the slots of all others meet their events.
    slots = slots.withColumn("other_t", F.when(~_is_prompt(), F.col("t")))
    rows = _with_events(slots, _others(events), "other_t", "event_type")
    rows = _explode_range(rows, F.col("first_index"), F.col("last_index"), "interaction_index")
    details = [F.when(_is_prompt(), F.col(d)).otherwise(F.col(f"_{d}")).alias(d) for d in _DETAILS]
    return rows.select(
        "session_id", _event_ts().alias("event_ts"), "event_type", *details, "interaction_index"
    )


def _shares(placed: DataFrame) -> DataFrame:
    """Events, cost and time that a slot adds to each interaction it belongs to."""
    each = F.when(_is_prompt(), F.col("n")).otherwise(F.lit(1))
    return placed.withColumns(
        {
            "share_ms": F.col("ms") / each,
            "share_usd": F.when(_is_prompt(), F.col("cost_usd")).otherwise(F.col("usd")),
            "share_n": F.when(_is_prompt(), F.lit(1)).otherwise(F.col("n")),
        }
    )


def _sum_up(shares: DataFrame, *keys: str) -> DataFrame:
    """Sum shares by `keys`; `compressed` is the one-line summary of each group."""
    by_type = shares.groupBy(*keys, "event_type").agg(
        F.sum("share_n").alias("n"),
        F.min("t").alias("first_t"),
        F.sum("share_usd").alias("usd"),
        F.sum("share_ms").alias("ms"),
    )
    # Most frequent type first, ties in the order of their first event.
    by_frequency = F.sort_array(
        F.collect_list(
            F.struct((-F.col("n")).alias("rank"), "first_t", "event_type", F.col("n").alias("n"))
        )
    )
    summed = by_type.groupBy(*keys).agg(
        F.sum("n").alias("num_events"),
        F.round(F.coalesce(F.sum("usd"), F.lit(0.0)), 9).alias("usd"),
        F.coalesce(F.sum("ms"), F.lit(0.0)).alias("ms"),
        by_frequency.alias("types"),
    )
    types = F.transform(
        "types", lambda kind: F.concat(text_or_none(kind["event_type"]), F.lit("="), kind["n"])
    )
    compressed = F.concat(
        F.lit("--- [compressed: "),
        F.col("num_events"),
        F.lit(" events, types: "),
        F.array_join(types, " "),
        F.lit(", cost=$"),
        fixed_point(F.col("usd"), 4),
        F.lit(", duration="),
        shortest_number(F.col("ms")),
        F.lit("ms] ---"),
    )
    first_type = F.col("types")[0]["event_type"].alias("first_type")
    return summed.select(*keys, "num_events", compressed.alias("compressed"), first_type)


def compressed_interactions(
    events: DataFrame, bucket_s: int = BUCKET_S, most: int = LEAF_EVENTS
) -> DataFrame:
    """One summary line for every interaction of every session."""
    indexed = _explode_range(
        _shares(_placed_slots(events, bucket_s, most=most)),
        F.col("first_index"),
        F.col("last_index"),
        "interaction_index",
    )
    lines = _sum_up(indexed, "session_id", "interaction_index").drop("first_type")
    return lines.withColumnRenamed("compressed", "line")


def _parts(keep: int, max_lines: int) -> Column:
    """The lines an event takes part in, as ranges of positions in each part.

    Head and tail lines are numbered by the events before them, compressed ones
    by their interaction. A range ends before it starts if the event has no line
    in the part, and none is longer than `max_lines`.
    """
    first, last, n = F.col("first_index"), F.col("last_index"), F.col("n")
    before, tail_index = F.col("events_before"), F.col("num_interactions") - keep
    whole = F.col("num_interactions") <= 2 * keep

    def copies_below(index: Column) -> Column:
        """How many of the copies belong to interactions before `index`."""
        some = F.greatest(F.lit(0), F.least(n, index - first))
        return F.when(_is_prompt(), some).otherwise(F.when(first < index, n).otherwise(F.lit(0)))

    in_head = F.when(whole, n).otherwise(copies_below(F.lit(keep)))
    before_tail = F.when(whole, n).otherwise(copies_below(tail_index))

    def span(part: int, low: Column, high: Column) -> Column:
        return F.struct(
            F.lit(part).alias("part"),
            low.cast("long").alias("low"),
            F.least(high, low + (max_lines - 1)).cast("long").alias("high"),
        )

    head = span(_HEAD, before, F.least(before + in_head - 1, F.lit(max_lines - 1)))
    middle = span(
        _MIDDLE,
        F.greatest(first, F.lit(keep)),
        F.when(~whole, F.least(last, tail_index - 1, F.lit(keep + max_lines - 1))).otherwise(-1),
    )
    tail_limit = F.col("tail_end") + (max_lines - 1)
    tail = span(_TAIL, before + before_tail, F.least(before + n - 1, tail_limit))
    return F.array(head, middle, tail)


def _first_events(events: DataFrame, max_lines: int) -> DataFrame:
    """The lines of the first `max_lines` events of each slot without prompts, and their `rank`.

    Events that print the same are interchangeable, so only what a line prints orders them.
    The limit holds before the shuffle: no task gives more of a slot than can be printed.
    """
    printed = [name for name in _DETAILS if name not in ("content_preview", "duration_ms")]
    short = F.substring("content_preview", 1, v.REPLAY_PREVIEW_CHARS).alias("content_preview")
    slot = ["session_id", "t", "event_type"]
    rows = _others(events).select(*slot, *printed, short)
    order = Window.partitionBy(*slot).orderBy(*printed, "content_preview")
    first = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_lines)
    return first.select(*slot, "rank", event_line(_event_ts()).alias("line"))


def replay_lines(
    events: DataFrame,
    keep: int = v.KEEP_INTERACTIONS,
    budget: int = v.REPLAY_CHAR_BUDGET,
    bucket_s: int = BUCKET_S,
    most: int = LEAF_EVENTS,
) -> DataFrame:
    """The lines of each replay as (session_id, part, position, line).

    `part` is 0 for the head, 1 for compressed interactions, 2 for the tail. Only
    lines that begin inside the budget are kept. As every line has a least
    length, none after the first `lines_within(budget)` of a part can: this bound,
    which does not rely on the optimizer, holds back the rest of a long session
    before it is shuffled, and drops no text.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    max_lines = lines_within(budget)
    parts = (
        _shares(_placed_slots(events, bucket_s, keep, most))
        .select("*", F.inline(_parts(keep, max_lines)))
        .filter(F.col("low") <= F.col("high"))
    )
    # Copies of a prompt, and interactions, take a line each. Any other slot that is printed
    # keeps one row here, and meets the texts of its events when the sums are done.
    is_slot = (F.col("part") != _MIDDLE) & ~_is_prompt()
    taking_part = parts.select(
        "*",
        F.explode(
            F.sequence("low", F.when(is_slot, F.col("low")).otherwise(F.col("high")))
        ).alias("position"),
        F.when(is_slot, F.col("t")).alias("slot_t"),
        F.when(is_slot, F.col("high")).alias("slot_high"),
        F.when(
            (F.col("part") != _MIDDLE) & _is_prompt(),
            F.substring(event_line(_event_ts()), 1, budget),
        ).alias("verbatim"),
    )
    keys = ("session_id", "part", "position", "slot_t", "slot_high", "verbatim")
    rows = _sum_up(taking_part, *keys)
    texts = _first_events(events, max_lines)
    position = F.col("position") + F.coalesce(F.col("_rank") - 1, F.lit(0))
    rows = _with_events(rows, texts, "slot_t", "first_type", position <= F.col("slot_high"))
    lines = rows.select(
        "session_id",
        "part",
        position.alias("position"),
        F.coalesce(
            F.substring("_line", 1, budget), "verbatim", F.substring("compressed", 1, budget)
        ).alias("line"),
    )
    in_text = Window.partitionBy("session_id").orderBy("part", "position")
    begins_at = F.sum(F.length("line") + 1).over(
        in_text.rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        lines.withColumn("number", F.row_number().over(in_text))
        .filter(F.col("number") <= max_lines)
        .withColumn("begins_at", F.coalesce(begins_at, F.lit(0)))
        .filter(F.col("begins_at") <= budget)
        .drop("number", "begins_at")
    )


def session_replay(
    events: DataFrame,
    keep: int = v.KEEP_INTERACTIONS,
    budget: int = v.REPLAY_CHAR_BUDGET,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """One replay text of at most `budget` characters per session with events."""
    ordered = F.sort_array(F.collect_list(F.struct("part", "position", "line")))
    text = F.array_join(F.transform(ordered, lambda row: row["line"]), "\n")
    return (
        replay_lines(events, keep, budget, bucket_s)
        .groupBy("session_id")
        .agg(F.substring(text, 1, budget).alias("replay_text"))
    )

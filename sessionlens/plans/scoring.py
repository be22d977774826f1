"""Silver -> gold: replay, rule scores and judgment of completed sessions."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from sessionlens import vocabulary as v
from sessionlens.operators import scores, worksets
from sessionlens.operators.judge import PROMPT_SUBJECT, Judge, session_scores, with_prompt
from sessionlens.operators.replay import COLUMNS as REPLAY_COLUMNS
from sessionlens.operators.replay import session_replay
from sessionlens.operators.signals import completed_sessions
from sessionlens.plans import timeline_days
from sessionlens.plans.answers import remembered
from sessionlens.sinks import tables
from sessionlens.sources import schemas

logger = logging.getLogger(__name__)


def prompted_sessions(
    sessions: DataFrame,
    events: DataFrame,
    keep_interactions: int = v.KEEP_INTERACTIONS,
    replay_char_budget: int = v.REPLAY_CHAR_BUDGET,
    subject: str = PROMPT_SUBJECT,
) -> DataFrame:
    """Summary rows with rule scores, replay and prompt.

    `events` may hold other sessions too; only those of `sessions` are returned.
    """
    scored = scores.rule_scores(sessions, scores.visible_error_counts(events))
    replays = session_replay(events, keep_interactions, replay_char_budget)
    return with_prompt(scored, replays, subject)


def score_sessions(
    spark: SparkSession,
    silver_schema: str,
    gold_schema: str,
    judge: Judge,
    replay_char_budget: int = v.REPLAY_CHAR_BUDGET,
    keep_interactions: int = v.KEEP_INTERACTIONS,
    as_of=None,
    idle: str = v.IDLE_COMPLETION,
    grace: str | None = None,
    subject: str = PROMPT_SUBJECT,
    answers: str | None = None,
) -> int:
    """Score completed sessions that have no score yet; returns their number.

    A score is never changed, unless `grace` allows to score a session again that
    went on within this interval after its score. Sessions whose judgment failed
    are not written and come up again in the next run. With `answers`, a table of
    the gold schema, no prompt that has been answered is asked again.
    """
    scores_table = f"{gold_schema}.{v.GOLD_SCORES}"
    summary = spark.table(f"{silver_schema}.{v.SILVER_SUMMARY}")
    completed = completed_sessions(summary, as_of, idle)
    tables.recover(spark, scores_table)
    if tables.exists(spark, scores_table):
        scored = spark.table(scores_table)
        if grace is None:
            due = worksets.unscored_sessions(completed, scored)
        else:
            due = worksets.due_sessions(completed, scored, grace)
    else:
        due = completed
    tables.ensure_schema(spark, gold_schema)
    with tables.Staging(spark, gold_schema) as staging:
        due = staging.keep(due)
        count = due.count()
        if count == 0:
            logger.info("no sessions to score")
            return 0
        timeline = timeline_days.timeline_of(f"{silver_schema}.{v.SILVER_EVENTS}", due)
        timeline = timeline.select(*REPLAY_COLUMNS)
        # Finding the events may take a shuffle, and they are read three times.
        events = staging.keep(worksets.events_of(timeline, due))
        prompted = prompted_sessions(due, events, keep_interactions, replay_char_budget, subject)
        if answers is not None:
            prompted = staging.keep(prompted)
            judge = remembered(judge, f"{gold_schema}.{answers}")
        # A judge is asked once per session: its answers are stored before the
        # parser and the filter, which would otherwise each evaluate it.
        judged = staging.keep(judge(prompted))
        gold = session_scores(judged, as_of)
        tables.ensure_table(spark, scores_table, schemas.SESSION_SCORES)
        if grace is None:
            tables.append(gold, scores_table)
        else:
            tables.upsert(gold, scores_table, ["session_id"])
        written = gold.count()
    logger.info("scored %d of %d sessions", written, count)
    return written

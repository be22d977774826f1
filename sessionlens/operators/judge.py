"""The judge stage: render a prompt, ask a judge, parse its structured answer.

The judge itself is the caller's: any function that adds an `ai_response` column
with JSON text. `column_judge` makes one from a Column expression, be it a SQL
function of the platform or a vectorised UDF, `batch_judge` from a Python function.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.functions.text import fixed_point, text_or_none
from sessionlens.operators.signals import as_column
from sessionlens.sources.schemas import JUDGMENT, SESSION_SCORES

Judge = Callable[[DataFrame], DataFrame]

logger = logging.getLogger(__name__)

# The wording of the prompt, as judges have been given it so far.
# `{subject}` and the values in the replay and metrics sections are filled in.
PROMPT_SUBJECT = "an AI agent session"
PROMPT_TASK = "You are evaluating {subject}. Score each dimension 0-100.\n\n"
PROMPT_EXCUSED = (
    "IMPORTANT: INTERNAL_ERROR, BACKGROUND_ABORTED, and USER_ABORTED events are normal "
    "operational events - do NOT penalize for them.\n\n"
)
PROMPT_DIMENSIONS = (
    "Score dimensions (0-100):\n"
    "- task_clarity (15%): how clearly defined and focused was the task?\n"
    "- agent_effectiveness (25%): did the agent accomplish its goals?\n"
    "- tool_strategy (25%): were tools used efficiently and appropriately?\n"
    "- error_handling (15%): how well were errors managed?\n"
    "- cost_efficiency (20%): was token/cost usage appropriate?\n"
    "- overall_score: weighted summary of the above\n"
    "- summary: one paragraph\n"
    "- recommendations: actionable suggestions\n\n"
)
PROMPT_ANSWER = "Return JSON only."
NO_EVENTS = "(no events)"


def judge_prompt(subject: str = PROMPT_SUBJECT) -> Column:
    """Prompt text from `replay_text` and the summary columns of a session."""

    def number(name: str, scale: float = 1.0) -> Column:
        # Nine decimals hide in which order the parts of a sum were added.
        return F.round(F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(scale), 9)

    # An empty replay counts as none.
    replay = F.coalesce(F.nullif("replay_text", F.lit("")), F.lit(NO_EVENTS))
    return F.concat(
        F.lit(PROMPT_TASK.format(subject=subject)),
        F.lit(PROMPT_EXCUSED),
        F.lit("Session replay:\n"),
        replay,
        F.lit("\n\nSession metrics:\n- interactions: "),
        text_or_none(F.col("num_interactions")),
        F.lit(", cost: $"),
        fixed_point(number("total_cost_usd"), 4),
        F.lit(", cache_hit_rate: "),
        fixed_point(number("cache_hit_rate", 100.0), 2),
        F.lit("%\n- tool_success_rate: "),
        fixed_point(number("tool_success_rate"), 2),
        F.lit(", auto_accept_rate: "),
        fixed_point(number("auto_accept_rate"), 2),
        F.lit("\n\n"),
        F.lit(PROMPT_DIMENSIONS),
        F.lit(PROMPT_ANSWER),
    )


def with_prompt(scored: DataFrame, replays: DataFrame, subject: str = PROMPT_SUBJECT) -> DataFrame:
    """Scored sessions with their `full_prompt`; both inputs hold one row per session."""
    return scored.join(replays, "session_id", "left").withColumn(
        "full_prompt", judge_prompt(subject)
    )


def response_format() -> str:
    """Type of the structured answer, for judges that take it as an argument."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in JUDGMENT)
    return f"STRUCT<judgment STRUCT<{fields}>>"


def column_judge(ask: Callable[[Column], Column]) -> Judge:
    """Judge that answers with a Column of the prompt."""
    return lambda prompted: prompted.withColumn("ai_response", ask(F.col("full_prompt")))


def batch_judge(
    ask: Callable[[list[str]], list[str | None]],
    batch: int = 16,
    retries: int = 2,
    wait_s: float = 1.0,
) -> Judge:
    """Judge that answers prompts in batches, in Python, with bounded retries.

    `ask` gets at most `batch` prompts and returns an answer, or None, for each. Prompts
    without an answer, and those of a call that fails, are asked again up to `retries` times, each
    time after twice the wait; the last time one by one, so that a prompt that breaks its
    call takes no other with it. What is left without an answer is NULL.
    """

    @F.pandas_udf("string")
    def answers(prompts: pd.Series) -> pd.Series:
        return pd.Series(_answers(ask, prompts.tolist(), batch, retries, wait_s), dtype=object)

    return column_judge(answers.asNondeterministic())


def _answers(ask, prompts: list, batch: int, retries: int, wait_s: float) -> list:
    found = [None] * len(prompts)
    left = [place for place, prompt in enumerate(prompts) if prompt is not None]
    for attempt in range(retries + 1):
        if attempt and left:
            time.sleep(wait_s * 2 ** (attempt - 1))
        size = 1 if attempt == retries and retries else batch
        for start in range(0, len(left), size):
            places = left[start:start + size]
            try:
                some = list(ask([prompts[place] for place in places]))
            except Exception:  # whatever the caller's client raises
                logger.warning("a call for %d prompts failed", len(places), exc_info=True)
                continue
            if len(some) == len(places):
                for place, answer in zip(places, some):
                    found[place] = answer
        left = [place for place in left if found[place] is None]
    return found


def rule_judge(prompted: DataFrame) -> DataFrame:
    """Deterministic stand-in: grades derived from the rule scores of the session."""

    def grade(name: str) -> Column:
        return F.floor(F.round(name, 6)).cast("int")

    answer = F.to_json(
        F.struct(
            grade("engagement_score").alias("task_clarity"),
            grade("productivity_score").alias("agent_effectiveness"),
            grade("productivity_score").alias("tool_strategy"),
            grade("quality_score").alias("error_handling"),
            grade("efficiency_score").alias("cost_efficiency"),
            grade("composite_score").alias("overall_score"),
            F.lit("graded by rule").alias("summary"),
            F.when(F.col("quality_score") < 70, F.lit("look into the errors"))
            .otherwise(F.lit("none"))
            .alias("recommendations"),
        )
    )
    return prompted.withColumn("ai_response", answer)


def parse_judgment(response: Column) -> Column:
    """Struct of grades from a JSON answer, bare or wrapped in a `judgment` object.

    Anything that is not of this form leaves the fields NULL.
    """
    either = T.StructType([*JUDGMENT.fields, T.StructField("judgment", JUDGMENT)])
    parsed = F.from_json(response, either)
    return F.struct(
        *[
            F.coalesce(parsed[f.name], parsed["judgment"][f.name]).alias(f.name)
            for f in JUDGMENT
        ]
    )


def session_scores(judged: DataFrame, as_of=None) -> DataFrame:
    """Gold rows of the judged sessions; failed judgments are left out.

    A left-out session has no gold row and is judged again by the next run.
    """
    graded = judged.withColumn("judgment", parse_judgment(F.col("ai_response")))
    scored_at = as_column(as_of)
    first = F.col("first_scored_at") if "first_scored_at" in judged.columns else F.lit(None)
    made = {
        **{f"llm_{f.name}": F.col("judgment").getField(f.name) for f in JUDGMENT},
        "scored_at": scored_at,
        "scored_session_end": F.col("session_end"),
        "first_scored_at": F.coalesce(first.cast("timestamp"), scored_at),
    }
    columns = [made.get(name, F.col(name)).alias(name) for name in SESSION_SCORES.fieldNames()]
    return graded.select(*columns).filter(F.col("llm_overall_score").isNotNull())

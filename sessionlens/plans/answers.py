"""Answers of a judge, kept by the prompt, so that no prompt is asked twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.operators.judge import Judge, parse_judgment
from sessionlens.sinks import tables

SCHEMA = T.StructType(
    [
        T.StructField("prompt_hash", T.StringType()),
        T.StructField("ai_response", T.StringType()),
        T.StructField("answered_at", T.TimestampType()),
    ]
)


def remembered(judge: Judge, answers_table: str) -> Judge:
    """A judge that looks a prompt up among earlier answers before it asks.

    Equal prompts are asked once. Only answers that can be parsed are kept; the other prompts
    stay without an answer and are asked again by the next run. The prompts are read
    twice, so pass them materialized.
    """

    def ask(prompted: DataFrame) -> DataFrame:
        spark = prompted.sparkSession
        tables.ensure_table(spark, answers_table, SCHEMA)
        keyed = prompted.withColumn("prompt_hash", F.sha2("full_prompt", 256))
        known = spark.table(answers_table).select("prompt_hash").distinct()
        new = keyed.join(known, "prompt_hash", "left_anti").dropDuplicates(["prompt_hash"])
        answered = judge(new).select("prompt_hash", "ai_response")
        # One evaluation: the judge is behind a generator, below which no filter is moved.
        answered = answered.select(F.inline(F.array(F.struct("prompt_hash", "ai_response"))))
        usable = parse_judgment(F.col("ai_response"))["overall_score"].isNotNull()
        kept = answered.filter(usable).withColumn("answered_at", F.current_timestamp())
        tables.append(kept, answers_table)
        answers = spark.table(answers_table).groupBy("prompt_hash")
        answers = answers.agg(F.max("ai_response").alias("ai_response"))
        return keyed.join(answers, "prompt_hash", "left").drop("prompt_hash")

    return ask

"""Corpus pipeline: toxic documents and repeated passages go, sources are mixed, and what
is left is encoded. Every stage takes (spark, docs, sf_dir), works on all of `docs`, and
all but the last return the columns of the documents table.

Defined cases: empty tables give empty results; null texts count as empty; extra columns
of the documents are carried along, also those with the name of a column that a stage computes for
itself; only the last stage's ids and n_tokens replace such columns; a document whose text line dedup takes away in whole
is a copy and goes. SQL cannot express the boosted trees and the encoding; the tests
compare the pipeline with a brute-force version.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sessionlens.llm import (  # noqa: E402
    jaccard_join,
    line_dedup,
    mixing,
    pieces,
    staging,
    toxicity,
)
from sessionlens.llm.queries import PIECE_MODEL, table  # noqa: E402
from sessionlens.llm.texts import set_aside  # noqa: E402

#: Every document stays at least once; smaller sources are repeated up to twice.
MIX_TARGET = mixing.Target(entropy=0.98, max_repeats=2.0, min_passes=1.0)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named, back = set_aside(docs, ["_toxicity"])
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = model.score(named, "_toxicity").filter(F.col("_toxicity") < toxicity.REJECT)
    return scored.drop("_toxicity").withColumnsRenamed(back).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named, back = set_aside(docs, ["n_chunks", "n_removed"])
    cleaned = line_dedup.deduplicate(named)
    # A filter on computed columns would be moved below them and repeat the whole nested
    # computation many times; it is not moved below a generator.
    computed = ("text", "n_removed")
    others = [c for c in cleaned.columns if c not in computed]
    cleaned = cleaned.select(*others, F.inline_outer(F.array(F.struct(*computed))))
    emptied = (F.col("n_removed") > 0) & (F.col("text") == "")
    kept = cleaned.filter(~emptied)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(kind))
        kept = kept.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return kept.drop("n_chunks", "n_removed").withColumnsRenamed(back).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each_class(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named, back = set_aside(docs, ["mix_pass", "mix_block"])
    made = mixing.mix(named, MIX_TARGET).drop("mix_pass", "mix_block")
    return made.withColumnsRenamed(back).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    made = pieces.encode(docs, PIECE_MODEL, keep=kept)
    return made.select(*kept, F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs, made = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if made is not None:
            staging.discard(made)
        made = docs
    return docs

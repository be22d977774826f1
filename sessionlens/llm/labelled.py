"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.texts import id_remainder, text_or_empty


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """(doc_id, text, label, part): at most `most` labelled documents, by a hash of the id.

    `usable` tells on the labels' doc_id which rows may be learnt from; `part` is the
    remainder of crc32(doc_id) by 5. Of several labels of a document the greatest
    counts. At most `most` ids are broadcast, whatever the size of the tables.
    """
    rows = labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        rows.groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    found = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    return found.withColumn("part", id_remainder(5))

"""The registered queries against their SQL counterparts, and the pipeline by hand."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle_check
from sessionlens.llm import jaccard_join, line_dedup, mixing, queries, toxicity

from .conftest import SF, needs_model, needs_tables
from .test_line_dedup import _brute as plain_dedup

pytestmark = [needs_tables, needs_model]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(compiled, name):
    frame = queries.queries()[name](compiled, SF)
    sql = queries.oracle_sql()[name]
    assert oracle_check.difference(frame, oracle_check.connect(SF), sql) is None


def test_pipeline_keeps_what_its_stages_decide(compiled):
    spark = compiled
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    model = toxicity.fit(docs, queries.table(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in model.score(docs).select("doc_id", "score").collect()}
    calm = {r.doc_id: r for r in docs.collect() if scores[r.doc_id] < toxicity.REJECT}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, frames[-1], SF).cache()
        assert made.columns == columns
        frames.append(made)
    kept, cleaned, single, repeated = (f.collect() for f in frames[1:])
    assert {r.doc_id for r in kept} == set(calm)
    plain = plain_dedup([(d, r.text) for d, r in calm.items()])
    assert {r.doc_id: r.text for r in cleaned} == {
        d: text for d, text, _, gone in plain if text or not gone
    }
    assert all(r.n_chars == len(r.text) for r in cleaned)
    classes = jaccard_join.jaccard_classes(frames[2]).collect()
    assert {r.doc_id for r in single} == {r.class_id for r in classes}
    assert {r.doc_id for r in repeated} == {r.doc_id for r in single}
    last = corpus_pipeline.STAGES[-1][1](spark, frames[4], SF)
    assert last.columns == [*columns, "n_tokens", "ids"]
    assert last.count() == len(repeated) and last.filter("n_tokens <> size(ids)").count() == 0
    assert mixing.Target() and line_dedup.LEAST_LINES == 2


def test_pipeline_runs_as_a_query(compiled):
    assert corpus_pipeline.run(compiled, SF).filter("text IS NULL").count() == 0


def test_all_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))


def test_pipeline_carries_columns_with_names_of_its_own(compiled, tmp_path):
    spark = compiled
    extra = {"ids": "x", "n_tokens": 7, "N_removed": 8, "_toxicity": 9.0, "n_chunks": 3, "mix_pass": 1}
    for name in ("documents", "labels"):
        frame = queries.table(spark, SF, name)
        if name == "documents":
            frame = frame.withColumns({c: F.lit(v) for c, v in extra.items()})
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path))
    kept = {c: v for c, v in extra.items() if c not in ("ids", "n_tokens")}
    assert made.count() > 0
    assert {tuple(r) for r in made.select(*kept).distinct().collect()} == {tuple(kept.values())}
    assert made.filter("n_tokens <> size(ids)").count() == 0


def test_pipeline_of_empty_tables(compiled, tmp_path):
    spark = compiled
    for name in ("documents", "labels"):
        queries.table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

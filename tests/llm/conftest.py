from __future__ import annotations

import os

import pytest

from sessionlens.llm.queries import PIECE_MODEL

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
needs_model = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no piece model")


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (number, row, "en", "a")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def compiled(spark):
    """Generated code is on: the SQL functions of these operators are many."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield spark
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")

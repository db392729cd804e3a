from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text[, source])``, with further columns whose names clash with
    those of intermediate and result columns."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if clash:
            df = df.selectExpr("*", "'x' AS score", "1L AS fp", "2L AS node", "3L AS component_id", "'h' AS host",
                               "'l' AS line", "0 AS toxic", "'i' AS ids", "7L AS item_id", "array(1) AS words")
        return df

    return make

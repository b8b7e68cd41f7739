from __future__ import annotations

import pytest

#: Columns whose names clash with those the operators use inside.
CLASHING = "row int, score double, copies int, target string, places array<int>, component long, uid string, fp string"


@pytest.fixture()
def documents(spark):
    """A small table of documents: documents([(doc_id, text, source), ...])."""

    def make(rows, lang="en"):
        full = [(i, text, lang, source, len(text or "")) for i, text, source in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture()
def clashing(spark):
    """The same table with further columns of clashing names."""

    def add(docs):
        names = [part.strip().split(" ", 1) for part in CLASHING.split(",")]
        return docs.selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in names if name not in docs.columns])

    return add

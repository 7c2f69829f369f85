from __future__ import annotations

import pytest

from ledgerloom.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) or (id, text, lang, source) rows."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build

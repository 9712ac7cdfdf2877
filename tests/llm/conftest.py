import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_prose import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A DataFrame of documents from (id, text) or (id, text, source) rows, with odd further columns."""

    def of(rows):
        full = [(i, t, "en", s[0] if s else "a", len(t or "")) for i, t, *s in rows]
        df = spark.createDataFrame(full, SCHEMA)
        # Names that operators use themselves.
        return df.selectExpr("*", "1 as h", "'x' as row", "2 as label", "3 as _row", "4 as kept", "5 as _out", "6 as size")

    return of


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = prose(5, 30_000, 5_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, prose(1, 80)), (5, prose(1, 80)), (5, prose(1, 80)), (6, long), (7, long + " end"),
        (None, prose(1, 80)), (None, prose(2, 70)), (8, prose(2, 70)), (9, "one"), (10, "ONE"), (11, "é ü x\x1cy"),
    ]

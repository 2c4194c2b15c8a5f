import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_prose import prose  # noqa: E402

#: Columns that operators use inside, here as columns of the input.
CLASHES = ("node", "key", "rid", "word", "block", "tokens", "gone", "passes", "before", "fold", "label", "n", "component_id", "_source")


@pytest.fixture(scope="session")
def as_docs(spark):
    """Documents from (doc_id, text, lang, source), with more columns than any operator asks for."""

    def build(rows):
        full = [(i, t, lang, source, len(t) if t else None, *range(len(CLASHES))) for i, t, lang, source in rows]
        columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} bigint" for c in CLASHES)
        return spark.createDataFrame(full, columns).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, other scripts, broken lines."""
    long = " ".join(prose(1, 30_000))
    same = " ".join(prose(2, 60))
    return [
        (1, None, None, None),
        (2, "", "en", ""),
        (3, " \t\n", "en", "a"),
        (4, same, "en", "a"),
        (5, same.replace(" ", "\n"), "en", "a"),
        (6, same + " ", None, "b"),
        (7, long, "en", "b"),
        (7, long, "en", "b"),
        (8, "Ünïcode ñandú   \U0001f600 ещё", "de", None),
        (9, "word", "en", "c"),
        (10, "WORD", "en", "c"),
        (None, same, "en", "a"),
        (None, "alone " * 3, None, "a"),
        (11, same.upper() + " tail", "en", "a"),
    ]

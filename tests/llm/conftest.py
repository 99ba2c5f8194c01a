import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from keepsight.session import local_session  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score string, row int"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source), with columns whose names clash."""

    def make(rows, parts=2):
        full = [(i, t, la, s, 1, "x", 2) for i, t, la, s in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture
def table(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


#: Null ids and texts, blanks, odd characters, a very long word and text, repeated rows.
ODD = [
    (None, "a b c", None, None),
    (1, None, None, "s"),
    (2, "", "en", None),
    (3, " \t\n ", "en", "s"),
    (4, "!!! 123 ???", "en", "s"),
    (5, "x" * 50_000, "en", "s"),
    (6, "wörd – ünï\u0301 \u2028 <|endoftext|> " * 2000, "de", "s"),
    (7, "same words in here twice over", "en", "s"),
    (7, "same words in here twice over", "en", "s"),
    (None, None, None, None),
]

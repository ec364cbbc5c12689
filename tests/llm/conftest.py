import hashlib
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Nulls, empty texts, ties, repeated rows, and columns named like those the operators make.
SCHEMA = "doc_id long, text string, source string, size string, digits string, host string, words string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source)."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", None, "h", "w") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


def words(text):
    return WORD.findall(text or "")


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def as_dicts(df):
    return [r.asDict() for r in df.collect()]

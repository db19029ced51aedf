import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    """Words of a text, A-Z lower-cased."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with clashing extra columns."""
    def make(pairs, extra=("kept", "key", "label", "n", "source_", "words")):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), *("x" for _ in extra)) for i, t in pairs]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(rows, schema + "".join(f", {c} string" for c in extra))
    return make

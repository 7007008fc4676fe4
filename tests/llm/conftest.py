"""Small document tables with every awkward value."""

import pytest

#: Column names that the operators use themselves.
CLASHING = ["digest", "key", "size", "score", "row", "frame", "did", "tag", "anchor", "node", "runs", "label", "bucket", "tie", "_row", "_spoken", "_quality_score"]


@pytest.fixture
def table(spark):
    """``rows`` of (doc_id, text, lang, source) with more columns whose names clash."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
        full = [(*row, len(row[1]) if row[1] is not None else None, *(["x"] * len(CLASHING))) for row in rows]
        return spark.createDataFrame(full, schema)

    return make


WORDS = [f"word{i:03d}" for i in range(400)]


@pytest.fixture
def awkward(table):
    long = " ".join(WORDS[(i * i + 7 * i) % 400] + str(i) for i in range(30_000))
    near = " ".join(WORDS[:120])
    return table([
        (1, near, "en", "a"), (2, near, "en", "a"), (2, near, "en", "a"), (3, near + " one more word", "en", None),
        (4, None, None, None), (5, "", "en", "b"), (6, " \t\n ", "de", "b"), (None, None, None, None),
        (None, near, None, "a"), (7, "x", "en", ""), (8, "ein kurzer Text", "de", "é"), (9, long, "en", "a"),
        (10, "\x00\x01 odd ퟿ text", "fr", "b"), (10, "other text, same id", "fr", "b"), (11, "!!! 123 ???", "en", "b"),
    ])

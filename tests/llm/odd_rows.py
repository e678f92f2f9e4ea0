"""Fixtures for the tests of this folder."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double, "
          "spans string, component_id long, text_hash string, fp string, kind string, part string, p string, "
          "length string, rank string, kept string")


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [(1, None), (1, None), (2, ""), (2, ""), (None, "alpha beta gamma"), (None, None), (3, "long word " * 12000),
            (4, " \n\t "), (5, "the same text is here now"), (6, "the same text is here now"),
            (7, "password=abcdef123456"), (7, "password=abcdef123456"), (8, "x" * 3000), (2, "other text of 2")]
    return spark.createDataFrame([(i, t, None if n % 2 else "en", None, None, *["clash"] * 1, 0.5, "s", 1, "h", "f", "k",
                                   "q", "p", "l", "r", "t") for n, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="session")
def none_at_all(odd):
    return odd.limit(0)

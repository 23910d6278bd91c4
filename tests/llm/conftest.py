"""Small tables with the awkward cases every operator must handle."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) with extra columns whose
    names operators use inside."""

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"x-{c}") for c in ("k1", "k2", "fp", "u", "v", "first", "n_words", "kept", "line_no", "shard", "gram", "t")})
        return df

    return make


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t\n"), (None, "a text without an id but with words"), (None, None),
    (4, "same text twice in the table"), (4, "same text twice in the table"), (4, "other text of the same id"),
    (5, "é ü ñ \U0001F600 \u00a0 \x1c \x85 odd ! $$$ characters"), (6, "word " * 30_000), (7, "x" * 200_000),
    (8, "no language", None, None),
]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

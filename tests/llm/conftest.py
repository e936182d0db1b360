import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\n ", "en", "b", 4), (4, "word", "en", None, 4), (None, "no id here at all but some words", "en", "a", 3),
        (None, None, None, None, None), (5, "same text in two rows of one id", "en", "a", 9), (5, "same text in two rows of one id", "en", "a", 9), (6, "lang " * 30_000, "en", "a", 150_000), (7, "x" * 100_000, "en", "c", 100_000),
        (8, "Ünïcödé wörds über alles 😀 ſ", None, "b", 3), (9, "|||| 12345 !!! ???", "de", "b", 3),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture
def make(spark):
    """Documents from texts, or from (id, text) or (id, text, source) rows."""

    def of(rows):
        rows = [(i, r) if isinstance(r, str) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows], DOC)

    return of


@pytest.fixture
def clash():
    """Add columns named like those that operators make or use inside."""
    from pyspark.sql import functions as F

    names = ["n_lines", "n_dropped", "h1", "h2", "id", "line", "k", "w", "t", "x", "rank", "score", "size", "target", "taken", "label", "start", "end", "words", "bands", "removed", "found", "key", "t1", "t2", "seed", "pos", "v", "q1", "kind"]
    names += ["__lost", "__lines", "__kept", "__id", "__own", "__rank", "__alone", "__key", "__h1", "__t1", "__pd_id", "__pd_cuts"]

    def add(df):
        return df.withColumns({n: F.lit(f"old {n}") for n in names})

    return add

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) pairs or of whole rows."""
    def make(rows, partitions=3):
        whole = [r if len(r) == 5 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(whole, DOCS).repartition(partitions)
    return make


@pytest.fixture()
def awkward(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, clashing extra columns."""
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
    rows = [(1, None, None, None, None), (None, "some words of a text without an id", "en", "a", 3), (2, "", "en", None, 0),
            (3, " \t\n ", "de", "b", 4), (4, long, "en", "a", len(long)), (5, "twice the same row", "en", "a", 18),
            (5, "twice the same row", "en", "a", 18), (6, "nul \x00 byte and é\U0001F600 letters", "fr", "b", 9),
            (7, "twice the same row", "en", None, 18), (5, "the same id with another text", "en", "b", 2),
            (None, None, None, None, None)]
    extra = ("key", "row", "fp", "k1", "size", "tokens", "score", "stretch", "id", "y", "root", "ranges")
    schema = DOCS + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

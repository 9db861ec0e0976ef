import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(rows, extra=None):
        data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, SCHEMA)
        for name in extra or ():
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with extra columns of clashing names."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if extra:
            for name in ("node", "component", "bucket", "digest", "first", "score", "k1", "t1", "kept", "weight", "part"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make

import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """A table from tuples; columns that inputs of the operators may also have, under clashing names."""

    def make(data, schema="doc_id bigint, text string", clash=False):
        df = spark.createDataFrame(data, schema)
        if clash:
            for name in ("score", "id", "n", "key", "row", "kind", "_hash", "size", "host", "ids", "n_lines"):
                if name not in df.columns:
                    df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make

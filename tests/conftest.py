import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from emberlog.session import build_session, drop_stages  # noqa: E402


# column expressions in test modules need a running session at import
SESSION = build_session(
    "emberlog-tests",
    master="local[4]",
    spark__sql__shuffle__partitions=4,
    spark__ui__enabled="false",
    spark__ui__showConsoleProgress="false",
    spark__driver__memory="4g",
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    drop_stages(SESSION)
    SESSION.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate column expressions over one text column and return the rows as tuples."""

    def run(texts, *columns, schema="x string"):
        rows = [t if isinstance(t, tuple) else (t,) for t in texts]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
        out = df.coalesce(1).orderBy("i").select(*columns).collect()
        return [tuple(r) if len(columns) > 1 else r[0] for r in out]

    return run

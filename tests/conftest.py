import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewire.session import local_session  # noqa: E402
from tidewire.streaming import jobs  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield jobs.prepare(session)
    session.stop()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df, *columns):
    """Sorted tuples of the given columns."""
    rows = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(rows, key=repr)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tablemill.operators.staging import drop_scratch, scratch_database
from tablemill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app_name="tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def target(spark, request):
    """A table name in the scratch database that is not taken."""
    import uuid

    return f"{scratch_database(spark)}.t_{uuid.uuid4().hex}"


@pytest.fixture
def rows():
    """Sorted plain rows, with None first."""
    def plain(df):
        return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])

    return plain

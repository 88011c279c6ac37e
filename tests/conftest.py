import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strataflow.config import Layers  # noqa: E402
from strataflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(tmp_path):
    return Layers(str(tmp_path))


def rows(df, *columns):
    """A frame's rows as sorted tuples; NULL sorts first."""
    found = (tuple(r) for r in (df.select(*columns) if columns else df).collect())
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])

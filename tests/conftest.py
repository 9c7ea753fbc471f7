import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rivermart.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("test tables not found")
    return str(TESTDATA)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(row) for row in picked.collect()),
                      key=lambda row: tuple((value is None, str(value)) for value in row))
    return collect

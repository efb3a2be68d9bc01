import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridwarden.session import build_session  # noqa: E402

SAMPLE = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_dir():
    if not SAMPLE.exists():
        pytest.skip("sample tables are not here")
    return str(SAMPLE)

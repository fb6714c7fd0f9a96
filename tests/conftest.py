import pytest

from strata.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("tests", master="local[4]", shuffle_partitions=4,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import logging

import pytest

from threadlake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    logging.getLogger("py4j").setLevel(logging.ERROR)
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "threadlake-tests",
        "local[4]",
        conf_map={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.retainedJobs": "50",
            "spark.ui.retainedStages": "50",
            "spark.sql.ui.retainedExecutions": "20",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    from threadlake.sources.layout import Lake

    return Lake(str(tmp_path))

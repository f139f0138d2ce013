import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# tests write partitioned tables and checkpoints only below pytest's own temporary folders
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyline.session import get_session

    session = get_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "2",
            # tests look for paths in plans: long temporary folders must not be cut there
            "spark.sql.maxMetadataStringLength": "2000",
            # tiny inputs: compiling generated code would take most of the time
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from tallyline.sources.adapters import adapted_tables

    return adapted_tables(spark, sf_dir)

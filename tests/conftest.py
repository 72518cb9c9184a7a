from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from fareweather.session import build_session

SMALL = "/root/testdata/sf0.001"


def local_session(cores: str = "8") -> SparkSession:
    folder = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "fareweather-tests",
        {
            "spark.master": f"local[{cores},2]",  # a task may fail once
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={folder}",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)

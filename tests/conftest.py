from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from terracelake.session import get_session


def local_session() -> SparkSession:
    return get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.log.level": "ERROR",
    })


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return local_session()

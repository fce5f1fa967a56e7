from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


def new_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tokenframe-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.tokenframe.inputPartitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def model(spark):
    from registry.inputs import model

    return model(spark)


@pytest.fixture(scope="session")
def join_model(spark):
    """The same word lists, too long for a plan as far as the model is told."""
    from registry.inputs import DEFINITIONS, WORD_LISTS
    from tokenframe import Model

    return Model.from_values(
        spark, DEFINITIONS, WORD_LISTS, lookup="join"
    )


@pytest.fixture(scope="session")
def table_model(spark):
    from registry.inputs import DEFINITIONS, WORD_LISTS
    from tokenframe import Model

    return Model.from_values(spark, DEFINITIONS, WORD_LISTS, max_inline_entries=0)

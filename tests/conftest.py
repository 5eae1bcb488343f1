import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderlens.sources.schemas import SCHEMAS, Marketplace  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def shop(spark):
    """Build a marketplace from partial rows (dicts); missing columns are NULL, missing tables empty."""

    def build(**tables) -> Marketplace:
        def open_table(name):
            schema = SCHEMAS[name]
            rows = [tuple(row.get(f.name) for f in schema) for row in tables.get(name, [])]
            return spark.createDataFrame(rows, schema)

        return Marketplace(open_table)

    return build

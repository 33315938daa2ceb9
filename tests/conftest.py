import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    yield session
    session.stop()


@pytest.fixture
def pages_of(spark):
    """Hand-made pages as a DataFrame; the page id is the position."""

    def make(*htmls, url="http://host.example/dir/{}"):
        rows = [(i, url.format(i), h) for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, "page_id bigint, url string, html string")

    return make

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

COLUMNS = "case_key string, operation string, field string, old_value string, " \
          "new_value string, actor string, logged_at string, ingest_ord bigint"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def audit(spark):
    """Make an audit log from (case, operation, field, new value, time) rows."""

    def build(*rows, actor="A"):
        full = [
            (case, operation, field, "", value, actor, time, place)
            for place, (case, operation, field, value, time) in enumerate(rows)
        ]
        return spark.createDataFrame(full, COLUMNS)

    return build

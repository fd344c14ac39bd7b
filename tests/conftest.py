from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("recordops")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine, so a local folder is shared
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortlake.config import SESSION


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SESSION.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from pyspark.sql import SparkSession  # noqa: E402

from marginfold.session import configured  # noqa: E402


def make_spark():
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = (
        configured(SparkSession.builder.master("local[8]"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_spark()
    yield session
    session.stop()

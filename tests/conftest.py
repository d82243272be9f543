import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# workers import the library and functions of the tests
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE.parent), str(HERE), str(HERE / "llm"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

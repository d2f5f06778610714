import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    conf = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted((DATA / "sf0.001").iterdir()):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return con

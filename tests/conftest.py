from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def panel(spark):
    """A panel from ``{id: (first date, [values])}``, monthly unless dates are given."""
    import datetime

    def build(series: dict, start: str = "2024-01-01"):
        rows = []
        for key, values in series.items():
            year, month, day = (int(x) for x in start.split("-"))
            for i, y in enumerate(values):
                if isinstance(y, tuple):
                    date, y = datetime.date.fromisoformat(y[0]), y[1]
                else:
                    index = year * 12 + month - 1 + i
                    date = datetime.date(index // 12, index % 12 + 1, day)
                rows.append((key, date, None if y is None else float(y)))
        return spark.createDataFrame(rows, "unique_id string, ds date, y double")

    return build

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from daystrata.schema import DAILY_LOG_FIELDS, daily_log_schema  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("daystrata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


GOOD_ROW = {
    "user_id": 1,
    "age": 30,
    "gender": "M",
    "date": "2024-09-06",
    "steps": 8000,
    "heart_rate_avg": 70.0,
    "sleep_hours": 7.5,
    "calories_burned": 2300.0,
    "exercise_minutes": 45.0,
    "stress_level": 5,
    "weight_kg": 81.0,
    "bmi": 25.0,
}


@pytest.fixture(scope="session")
def make_log(spark):
    """Frame of daily-log rows, each a valid row with the given changes."""

    def make(*changes: dict):
        rows = [tuple((GOOD_ROW | change)[c] for c in DAILY_LOG_FIELDS) for change in changes]
        return spark.createDataFrame(rows, daily_log_schema())

    return make


@pytest.fixture(scope="session")
def write_csv_rows():
    """CSV file with a header and rows of the daily log, each a valid row with the given changes."""

    def write(path: Path, *changes: dict, header: list[str] | None = None) -> str:
        names = header or list(DAILY_LOG_FIELDS)
        lines = [",".join(names)]
        for change in changes:
            row = GOOD_ROW | change
            lines.append(",".join("" if row.get(n) is None else str(row.get(n)) for n in names))
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventloom.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tuned(
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

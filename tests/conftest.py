import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from carespan.plans import skew  # noqa: E402
from carespan.plans.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staged")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def hot(monkeypatch):
    """Every key with more than two rows counts as hot."""
    monkeypatch.setattr(skew, "rows_a_task", lambda facts: 2)


def rows(df, *columns):
    """Rows as a sorted list of tuples, with None first."""
    df = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in df.collect()),
        key=lambda t: [(v is not None, str(type(v)), v if v is not None else 0) for v in t],
    )

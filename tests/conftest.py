import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
        spark_sql_warehouse_dir=str(root / "warehouse"),
        spark_checkpoint_dir=str(root / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark, request):
    """A database of its own, so that table tests do not meet."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    spark.sql(f"CREATE DATABASE {name}")
    spark.catalog.setCurrentDatabase(name)
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, NULLs first."""

    def collect(df, *cols):
        data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect

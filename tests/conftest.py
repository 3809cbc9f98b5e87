import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    warehouse = tempfile.mkdtemp(prefix="vigilo-warehouse-")
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("vigilo-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from vigilo.session import checkpoint_root

    checkpoint_root(session)  # a local checkpoint folder only when the session names none
    yield session
    session.stop()


@pytest.fixture
def raw_dir(tmp_path):
    return tmp_path


def write_text(path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)

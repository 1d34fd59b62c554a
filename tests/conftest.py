import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
sys.path.insert(0, str(ROOT / "tests"))

@pytest.fixture(scope="session")
def scratch() -> Path:
    """A fresh scratch folder for this test run (never reused, never cleared)."""
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture(scope="session")
def spark(scratch):
    from pyspark.sql import SparkSession

    from eventlake import session

    s = (
        SparkSession.builder.master("local[4]")
        .appName("eventlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    session.configure(s)
    yield s
    s.stop()


@pytest.fixture()
def folder(scratch):
    """A new sub-folder of the scratch folder per test."""
    return Path(tempfile.mkdtemp(dir=scratch))

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keypanel.session import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="keypanel-tests-")
    builder = (SparkSession.builder.master("local[8]").appName("keypanel-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
               .config("spark.driver.memory", "8g"))
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain tuples, in order."""
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return collect

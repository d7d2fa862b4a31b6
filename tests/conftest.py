import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from respira.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def cut_series(spark):
    """Force the split plans: nothing counts as small and a segment is 60 rows."""
    spark.conf.set("respira.small.bytes", "0")
    spark.conf.set("respira.series.rows", "60")
    yield
    spark.conf.unset("respira.small.bytes")
    spark.conf.unset("respira.series.rows")


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")

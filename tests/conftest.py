import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallgrass.plans.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    yield session
    session.stop()


@pytest.fixture
def plan_of(spark):
    """The executed plan as text."""

    def explain(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        return df._jdf.queryExecution().explainString(mode)

    return explain


@pytest.fixture
def as_set():
    """Rows as a set of tuples in a fixed column order."""

    def collect(df, *columns):
        chosen = columns or df.columns
        return {tuple(r[c] for c in chosen) for r in df.collect()}

    return collect

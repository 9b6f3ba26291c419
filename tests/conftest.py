import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from spendlight.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small DataFrame from rows and a DDL schema."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


AD_EVENTS = "campaign_id string, event_date date, event_type string, cost_usd double"
CONVERSIONS = "campaign_id string, conversion_date date, conversion_value_usd double, is_new_customer int"
CAMPAIGNS = (
    "campaign_id string, campaign_name string, channel string, campaign_type string, status string,"
    " start_date date, end_date date, daily_budget_usd int"
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

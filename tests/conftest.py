import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from adperf.settings import configure

    scratch = tempfile.mkdtemp(prefix="adperf-test-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("adperf-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from tests.compare import duck

    return duck(SMALL)


@pytest.fixture
def elements(spark):
    """Builds element rows from (day, hour, campaign, creative, impressions, clicks, cost, conversions)."""
    from datetime import date, datetime

    from adperf.sources.schema import ELEMENT_COLUMNS

    schema = (
        "report_date date, pulled_ts timestamp, campaign_id string, campaign_name string, campaign_status string, "
        "daily_budget double, unit_cost double, creative_id string, impressions bigint, clicks bigint, cost double, "
        "conversions bigint, unique_impressions bigint"
    )

    def build(rows):
        out = []
        for day, hour, campaign, creative, impressions, clicks, cost, conversions in rows:
            d = date.fromisoformat(day)
            out.append(
                (
                    d, datetime(d.year, d.month, d.day, hour), campaign, campaign.upper(), "ACTIVE", 100.0, 5.0,
                    creative, impressions, clicks, cost, conversions, impressions,
                )
            )
        return spark.createDataFrame(out, schema).select(*ELEMENT_COLUMNS)

    return build

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clearbook.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def separate_partitions(spark):
    """Keep small shuffles in several partitions, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def eight_rows(spark):
    """Customer A has 800, B 150 and C 50 of a total of 1000. Fixed values."""
    rows = [
        ("T1", "A", "East", "Paper", 200.0, "2024-01-02"),
        ("T2", "A", "East", "Paper", 200.0, "2024-01-09"),
        ("T3", "A", "West", "Paper", 200.0, "2024-01-16"),
        ("T4", "A", "West", "Paper", 200.0, "2024-01-23"),
        ("T5", "B", "East", "Mining", 50.0, "2024-01-02"),
        ("T6", "B", "West", "Mining", 50.0, "2024-01-09"),
        ("T7", "B", "East", "Mining", 50.0, "2024-01-16"),
        ("T8", "C", "West", "Paper", 50.0, "2024-01-23"),
    ]
    names = (
        "transaction_id customer_name_clean region_clean industry_segment_clean revenue_usd_clean order_date_clean"
    ).split()
    df = spark.createDataFrame(rows, names)
    return df.withColumn("order_date_clean", df.order_date_clean.cast("date"))

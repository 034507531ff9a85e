import datetime as dt
import random

import pytest

from clearbook import schemas
from clearbook.operators.cleaning import clean_values
from clearbook.operators.measures import to_measures
from clearbook.operators.weekly import weekly_revenue
from clearbook.sources.mapping_table import read_mapping
from clearbook.streaming.names import follow_names
from clearbook.streaming.weekly import follow_weeks, read_weeks, weekly_totals


def write_names(spark, folder, names):
    rows = [(str(i), name, "NE", "chem", None, "2024-01-02", "1", "$5", None, None) for i, name in enumerate(names)]
    spark.createDataFrame(rows, schemas.RAW).write.mode("append").json(folder)


def test_arriving_files_extend_the_mapping(spark, tmp_path):
    folder, mapping, checkpoint = (str(tmp_path / name) for name in ("in", "mapping", "checkpoint"))
    write_names(spark, folder, ["Acme Industrial Corp", "acme industrial corp"])
    raw = spark.readStream.schema(schemas.RAW).json(folder)
    follow_names(raw, mapping, checkpoint).awaitTermination()
    write_names(spark, folder, ["Acme Industral Corp", "Oakwood Materials Inc", "Acme Industrial Corp"])
    follow_names(raw, mapping, checkpoint).awaitTermination()
    found = {r.dirty: r.clean for r in read_mapping(spark, mapping, "customers").collect()}
    assert found["Acme Industral Corp"] == found["acme industrial corp"] == found["Acme Industrial Corp"]
    assert found["Oakwood Materials Inc"] == "Oakwood Materials Inc" and len(found) == 4


def test_row_level_cleaning_works_on_streams(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_names(spark, folder, ["a", "b"])
    cleaned = clean_values(spark.readStream.schema(schemas.RAW).json(folder))
    query = cleaned.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.table("cleaned").collect()
    assert {(r.region_clean, r.industry_segment_clean, r.revenue_usd_clean) for r in rows} == {
        ("Northeast", "Chemical Processing", 5.0)
    }


CLEAN = (
    "transaction_id string, customer_name_clean string, region_clean string, industry_segment_clean string, "
    "order_date_clean date, revenue_usd_clean double"
)


def clean_rows(days):
    rng = random.Random(len(days))
    amounts = [5.25, 0.1, -3.0, 1e20, None, float("nan")]
    return [(str(i), "c", "r", "s", day, rng.choice(amounts)) for i, day in enumerate(days)]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_streamed_weeks_equal_the_batch(spark, tmp_path, zone):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("in", "weeks", "checkpoint"))
    rng = random.Random(3)
    first = dt.date(2024, 1, 1)  # a Monday
    for file in range(4):
        # a file reaches back by up to two weeks, and some weeks have no rows
        days = [first + dt.timedelta(days=20 * file + rng.randint(-10, 10)) for _ in range(40)] + [None]
        days = [day for day in days if day is None or day.isocalendar().week not in (4, 5)]
        spark.createDataFrame(clean_rows(days), CLEAN).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(CLEAN).parquet(folder)
        follow_weeks(stream, path, checkpoint, "21 days").awaitTermination()
        batch = weekly_revenue(to_measures(spark.read.parquet(folder)))
        assert weekly_revenue(read_weeks(spark, path)).collect() == batch.collect()
    assert spark.read.parquet(path).count() > 8


def test_rows_for_closed_weeks_are_left_out(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("in", "weeks", "checkpoint"))

    def arrive(*days):
        rows = [(str(day), "c", "r", "s", day, 1.0) for day in days]
        spark.createDataFrame(rows, CLEAN).coalesce(1).write.mode("append").parquet(folder)
        follow_weeks(spark.readStream.schema(CLEAN).parquet(folder), path, checkpoint, "7 days").awaitTermination()
        return {r.order_date_clean: r.priced_rows for r in read_weeks(spark, path).collect()}

    monday = dt.date(2024, 1, 1)
    assert arrive(monday, monday + dt.timedelta(days=6)) == {dt.date(2024, 1, 7): 2}
    later = arrive(monday + dt.timedelta(days=20))
    assert later == {dt.date(2024, 1, 7): 2, dt.date(2024, 1, 21): 1}
    # the first week ended more than seven days before the latest row, the second did not
    late = arrive(monday + dt.timedelta(days=3), monday + dt.timedelta(days=13))
    assert late == {dt.date(2024, 1, 7): 2, dt.date(2024, 1, 14): 1, dt.date(2024, 1, 21): 1}


def test_weekly_totals_of_a_batch(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    found = weekly_totals(spark.createDataFrame([(str(d), "c", "r", "s", d, 1.5) for d in days], CLEAN)).collect()
    assert {(str(r.order_date_clean), int(r.revenue_cents)) for r in found} == {
        ("2023-12-31", 150), ("2024-01-07", 300), ("2024-01-14", 150),
    }

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from clearbook.operators import breakdown, pareto, report_tables, summary, weekly
from clearbook.operators.measures import analyzable, exclusion_counts, roll_up, to_measures


def sales(spark, rows):
    """Clean transactions from (customer, revenue[, day]) tuples."""
    data = [
        (f"T{i}", r[0], None if r[1] is None else float(r[1]), r[2] if len(r) > 2 else dt.date(2024, 1, 2))
        for i, r in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data, "transaction_id string, customer_name_clean string, revenue_usd_clean double, order_date_clean date"
    )
    return df.withColumns({"region_clean": F.lit("R"), "industry_segment_clean": F.lit("S")})


def table(spark, rows, **options):
    found = pareto.customer_pareto(to_measures(sales(spark, rows)), **options)
    return [r.asDict() for r in found.orderBy("rank").collect()]


def test_eight_rows_pareto(eight_rows):
    rows = pareto.customer_pareto(to_measures(eight_rows)).orderBy("rank").collect()
    assert [r.customer_name_clean for r in rows] == ["A", "B", "C"]
    assert [r.revenue for r in rows] == [800.0, 150.0, 50.0]
    assert [r.cumulative_pct for r in rows] == [80.0, 95.0, 100.0]
    assert [r.is_pareto_80 for r in rows] == [True, False, False]
    assert [r.avg_order_value for r in rows] == [200.0, 50.0, 50.0]
    top = pareto.top_customers(to_measures(eight_rows), 2).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in rows[:2]]


def test_eight_rows_summaries(eight_rows):
    measures = to_measures(eight_rows)
    found = pareto.pareto_summary(pareto.customer_pareto(measures)).first()
    assert (found.total_customers, found.pareto_customers, found.pareto_customer_pct) == (3, 1, 33.3)
    assert (found.top_1_customer, found.top_1_revenue_pct, found.pareto_revenue_pct) == ("A", 80.0, 80.0)
    dataset = summary.dataset_summary(measures).first()
    assert dataset.asDict() == {
        "total_revenue": 1000.0, "total_transactions": 8, "date_range_start": "2024-01-02",
        "date_range_end": "2024-01-23", "unique_customers": 3, "unique_segments": 2, "unique_regions": 2,
    }


def test_eight_rows_breakdowns(eight_rows):
    segments = [tuple(r) for r in breakdown.segment_breakdown(to_measures(eight_rows)).collect()]
    assert segments == [("Paper", 850.0, 5, 2, 85.0), ("Mining", 150.0, 3, 1, 15.0)]
    regions = [tuple(r) for r in breakdown.region_breakdown(to_measures(eight_rows)).collect()]
    assert regions == [("East", 500.0, 4, 2, 50.0), ("West", 500.0, 4, 3, 50.0)]
    assert breakdown.top_rows(breakdown.region_breakdown(to_measures(eight_rows)), 1).first().region_clean == "East"


def test_results_do_not_depend_on_the_grain(eight_rows):
    fine = to_measures(eight_rows)
    coarse = roll_up(fine, "customer_name_clean", "region_clean", "industry_segment_clean")
    for operator in (pareto.customer_pareto, breakdown.segment_breakdown, summary.dataset_summary):
        assert sorted(map(str, operator(fine).collect())) == sorted(map(str, operator(coarse).collect()))


def test_ten_equal_customers_give_a_tier_of_eight(spark):
    rows = table(spark, [(f"c{i}", 10) for i in range(10)])
    assert sum(r["is_pareto_80"] for r in rows) == 8
    assert [r["customer_name_clean"] for r in rows] == sorted(r["customer_name_clean"] for r in rows)


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.8, 1.0, 1.5])
def test_ranks_and_tier_against_brute_force(spark, separate_partitions, threshold):
    rng = random.Random(int(threshold * 10))
    # a third of the customers tie at one amount, some are negative, some zero
    for case, amounts in enumerate(
        [
            [rng.choice([7, 7, 7, 0, -3, rng.randint(-50, 500)]) for _ in range(300)],
            [-rng.randint(0, 9) for _ in range(60)],
            [0] * 40,
            [5, -5],
            [12],
        ]
    ):
        names = [f"c{i:04d}" for i in range(len(amounts))]
        found = table(spark, list(zip(names, amounts)), threshold=threshold)
        ordered = sorted(zip(names, amounts), key=lambda p: (-p[1], p[0]))
        total, running, crossed = sum(amounts), 0, False
        assert [r["customer_name_clean"] for r in found] == [p[0] for p in ordered]
        assert [r["rank"] for r in found] == list(range(1, len(amounts) + 1))
        for row, (_, amount) in zip(found, ordered):
            running += amount
            assert row["is_pareto_80"] == (not crossed), (case, row)
            share = None if total == 0 else Fraction(running, total)
            crossed = crossed or (share is not None and share >= Fraction(str(threshold)))
            if total:
                assert row["cumulative_pct"] == pytest.approx(float(share) * 100, abs=0.006)


def test_unnamed_customers_are_left_out_but_count_in_breakdowns(spark):
    df = sales(spark, [("A", 60), (None, 40)])
    assert [r["pct_of_total"] for r in table(spark, [("A", 60), (None, 40)])] == [100.0]
    no_region = df.withColumn("region_clean", F.when(F.col("customer_name_clean") == "A", "East"))
    assert [tuple(r) for r in breakdown.region_breakdown(to_measures(no_region)).collect()] == [
        ("East", 60.0, 1, 1, 60.0)
    ]


def test_empty_input(spark):
    measures = to_measures(sales(spark, [("A", 1)]).limit(0))
    assert pareto.customer_pareto(measures).count() == 0
    assert pareto.pareto_summary(pareto.customer_pareto(measures)).first().top_1_customer is None
    assert weekly.weekly_summary(weekly.weekly_revenue(measures)).count() == 0
    assert breakdown.region_breakdown(measures).count() == 0


def test_analyzable_rows_and_their_counts(spark):
    df = sales(spark, [("A", 1), ("A", 0), ("A", -1), ("A", None)])
    assert analyzable(df).count() == 2
    assert analyzable(df, include_refunds=True).count() == 3
    assert exclusion_counts(df).first().asDict() == {
        "rows": 4, "null_revenue": 1, "oversized_revenue": 0, "negative_revenue": 1, "analyzable": 2,
    }
    assert exclusion_counts(df, include_refunds=True).first().analyzable == 3


def test_weeks_without_sales_are_kept(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 22), None]
    rows = weekly.weekly_revenue(to_measures(sales(spark, [("A", 10, d) for d in days]))).orderBy(
        "order_date_clean"
    ).collect()
    assert [r.order_date_clean.isoformat() for r in rows] == ["2024-01-07", "2024-01-14", "2024-01-21", "2024-01-28"]
    assert [r.revenue for r in rows] == [20.0, 0.0, 0.0, 10.0]
    assert [r.transactions for r in rows] == [2, 0, 0, 1]
    assert [r.wow_change_pct for r in rows] == [None, -100.0, None, None]


def test_eight_rows_weekly(eight_rows):
    weeks = weekly.weekly_revenue(to_measures(eight_rows))
    rows = weeks.orderBy("order_date_clean").collect()
    assert len(rows) == 4 and sum(r.revenue for r in rows) == 1000.0
    assert [r.wow_change_pct for r in rows] == [None, 0.0, 0.0, 0.0]
    found = weekly.weekly_summary(weeks).first()
    assert (found.weeks_covered, found.best_week_revenue, found.worst_week_revenue) == (4, 250.0, 250.0)


FOUR_WEEKS = [
    (dt.date(2024, 1, 7), 250.0, 3, None),
    (dt.date(2024, 1, 14), 300.0, 3, 20.0),
    (dt.date(2024, 1, 21), 250.0, 2, -16.67),
    (dt.date(2024, 1, 28), 200.0, 1, -20.0),
]


def test_incomplete_weeks_are_noted_and_left_out_of_the_chart(spark):
    weeks = spark.createDataFrame(
        FOUR_WEEKS, "order_date_clean date, revenue double, transactions long, wow_change_pct double"
    )
    rows = report_tables.weekly_report(weeks).orderBy("week_ending").collect()
    # the median is 2.5 transactions, so fewer than 1 would be incomplete
    assert [r.is_partial for r in rows] == [False] * 4
    assert [r.wow_change for r in rows] == [None, 0.2, -16.67 / 100, -0.2]
    busy = weeks.withColumn("transactions", F.col("transactions") * F.when(F.col("revenue") > 200, 10).otherwise(1))
    rows = report_tables.weekly_report(busy).orderBy("week_ending").collect()
    assert [r.is_partial for r in rows] == [False, False, False, True]
    assert (rows[3].wow_change, rows[3].note, rows[0].note) == (None, "Incomplete week", "")
    assert report_tables.weekly_complete(busy).count() == 3


def test_trend_arrows(spark):
    changes = spark.createDataFrame([(5.0,), (-2.5,), (0.0,), (None,)], "latest_wow_change double")
    found = [(r.arrow, r.size_pct) for r in weekly.trend(changes).collect()]
    assert found == [("▲", 5.0), ("▼", 2.5), ("▼", 0.0), (None, None)]


def test_report_texts(spark):
    dataset = spark.createDataFrame([(1234567.5, 1000, 3)], "total_revenue double, total_transactions long, unique_customers long")
    tier = spark.createDataFrame(
        [(1, 33.3, 80.0, "Customer A", 80.25)],
        "pareto_customers long, pareto_customer_pct double, pareto_revenue_pct double, top_1_customer string, "
        "top_1_revenue_pct double",
    )
    weeks = spark.createDataFrame([(250.0,)], "avg_weekly_revenue double")
    tiles = report_tables.kpi_tiles(dataset, tier, weeks).orderBy("position").collect()
    assert [r.value for r in tiles] == ["$1,234,568", "1,000", "3", "1 customers", "80.0% of revenue", "$250"]
    sentence = report_tables.takeaway(tier).first().takeaway
    assert sentence == (
        "1 customer(s), 33.3 % of them all, bring 80.0 % of the revenue; Customer A alone brings 80.2 % "
        "and is the account to look after first."
    )

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clearbook.operators import breakdown, measures, quantiles, summary
from clearbook.operators.measures import CUSTOMER, REGION, SEGMENT


def sales(spark, n=20_000):
    """A third of all rows belongs to one region, and some values are null."""
    i = F.col("id")
    return measures.to_measures(
        spark.range(n).repartition(7).select(
            i.cast("string").alias("transaction_id"),
            F.when(i % 97 != 0, F.concat(F.lit("c"), (i * 7919 % 4001).cast("string"))).alias(CUSTOMER),
            F.when(i % 3 == 0, "hot").when(i % 50 != 0, F.concat(F.lit("r"), (i % 40).cast("string"))).alias(REGION),
            F.concat(F.lit("s"), (i % 5).cast("string")).alias(SEGMENT),
            F.lit(dt.date(2024, 1, 1)).alias(measures.DAY),
            (i % 1000 / 7.0).alias("revenue_usd_clean"),
        )
    )


def test_all_breakdowns_in_one_pass(spark, separate_partitions):
    rows = sales(spark)
    found = breakdown.breakdowns(rows, [SEGMENT, REGION])
    for dimension in (SEGMENT, REGION):
        expected = [tuple(r) for r in breakdown.revenue_by(rows, dimension).collect()]
        assert [tuple(r) for r in breakdown.one_breakdown(found, dimension).collect()] == expected
        assert breakdown.one_breakdown(found, dimension).columns[0] == dimension
    with pytest.raises(ValueError):
        breakdown.breakdowns(rows, [CUSTOMER])
    assert breakdown.breakdowns(rows.limit(0), [SEGMENT]).count() == 0


def test_one_scan_feeds_all_breakdowns(spark, tmp_path, monkeypatch):
    sales(spark).write.parquet(str(tmp_path / "sales"))
    plans = []
    staged = breakdown.stage

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(breakdown, "stage", noted)
    breakdown.breakdowns(spark.read.parquet(str(tmp_path / "sales")), [SEGMENT, REGION])
    # AQE shows the plan twice at most: as it is and as it began
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "Expand" in plans[0]


def test_sketches_roll_up(spark):
    rows = sales(spark)
    fine = measures.roll_up(rows, REGION, SEGMENT, sketched=[CUSTOMER])
    exact = {r[0]: r.n for r in rows.groupBy(REGION).agg(F.count_distinct(CUSTOMER).alias("n")).collect()}
    coarse = measures.roll_up(fine, REGION)
    found = {r[0]: r.n for r in coarse.select(REGION, measures.distinct_estimate(CUSTOMER).alias("n")).collect()}
    assert set(found) == set(exact)
    assert all(abs(found[key] - n) <= 0.05 * n for key, n in exact.items())
    whole = measures.roll_up(coarse).select(measures.distinct_estimate(CUSTOMER).alias("n")).first().n
    assert abs(whole - 4001) < 0.05 * 4001
    about = breakdown.one_breakdown(breakdown.breakdowns(rows, [REGION, SEGMENT], approximate=True), REGION)
    sure = {r[0]: r for r in breakdown.revenue_by(rows, REGION).collect()}
    for r in about.collect():
        assert (r.revenue, r.transactions, r.pct_of_total) == (sure[r[0]].revenue, sure[r[0]].transactions, sure[r[0]].pct_of_total)
        assert abs(r.unique_customers - sure[r[0]].unique_customers) <= 0.05 * sure[r[0]].unique_customers


def test_approximate_summary(spark):
    rows = sales(spark)
    exact, about = (summary.dataset_summary(rows, approximate=a).first() for a in (False, True))
    assert exact.asDict().keys() == about.asDict().keys()
    assert about[:4] == exact[:4] and about.unique_segments == 5 and about.unique_regions == exact.unique_regions
    assert abs(about.unique_customers - 4001) < 0.05 * 4001
    plan = summary.dataset_summary(rows, approximate=True)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    nothing = summary.dataset_summary(rows.limit(0), approximate=True).first()
    assert (nothing.total_revenue, nothing.unique_customers) == (None, 0)


def test_quantile_ranks(spark, separate_partitions):
    amount = (F.col("id") * 7919 % 100_003).cast("double")
    rows = spark.range(100_003).repartition(9).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 4).cast("string")).alias("g"),
        (F.col("id") % 10).alias("part"),
        F.when(F.col("id") % 11 != 0, amount).alias("amount"),
    )
    sketches = quantiles.amount_sketches(rows, ["g", "part"], F.col("amount"))
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {r.g: r for r in quantiles.quantiles(quantiles.unite(sketches, "g"), shares).collect()}
    for g, row in found.items():
        values = sorted(r.amount for r in rows.where((F.col("g") == g) & F.col("amount").isNotNull()).collect())
        assert row.priced_rows == len(values)
        for share, value in zip(shares, row.quantiles, strict=True):
            rank = sum(v <= value for v in values) / len(values)
            assert abs(rank - share) <= quantiles.RANK_ERROR + 1 / len(values), (g, share)
        assert (row.quantiles[0], row.quantiles[-1]) == (values[0], values[-1])
    assert quantiles.amount_sketches(rows.where("false"), ["g"], F.col("amount")).count() == 0

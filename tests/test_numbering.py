from pyspark.sql import functions as F

from clearbook.operators.numbering import numbered


def test_numbers_follow_the_order_without_gaps(spark, separate_partitions):
    df = spark.range(10_000).repartition(13).select("id", (F.col("id") % 7).alias("part"), F.lit("x").alias("before"))
    rows = numbered(df, [F.col("id").desc()], "n").collect()
    assert [r.n for r in sorted(rows, key=lambda r: -r.id)] == list(range(10_000))
    assert rows[0].before == "x" and set(rows[0].asDict()) == {"id", "part", "before", "n"}


def test_nulls_ties_and_no_rows(spark, separate_partitions):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), (None,)], "v string").repartition(3)
    found = [r.v for r in sorted(numbered(df, ["v"]).collect(), key=lambda r: r.number)]
    assert found == [None, None, "a", "b", "b"]
    assert numbered(df.where("v = 'z'"), ["v"]).count() == 0

import pytest
from pyspark.sql import functions as F

from clearbook.operators import mapping, packing, resolver
from clearbook.operators.cleaning import clean_transactions
from clearbook.plans.cleaning import clean_with_mappings, refresh_names
from clearbook.sources.mapping_table import append_mapping, read_mapping

ROWS = [("1", "a"), ("2", "a"), ("3", "b"), ("4", "c"), ("5", " "), ("6", None), ("7", "7")]


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(ROWS, "id string, v string")


@pytest.mark.parametrize("with_counts", [False, True])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lookup_falls_back_to_the_value(spark, dirty, with_counts, threshold):
    pairs = [("a", "A", 1000), ("b", "B", 1), ("7", "seven", 1000)]
    known = spark.createDataFrame(pairs, "dirty string, clean string, n long")
    counts = known.select("dirty", "n") if with_counts else None
    # a repeated and a conflicting pair: the smallest clean value wins, and no row is doubled
    known = known.drop("n").union(spark.createDataFrame([("a", "A"), ("b", "C")], "dirty string, clean string"))
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = mapping.apply_mapping(dirty, "v", known, "clean_v", spread_by="id", counts=counts).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    # row 6 is spread by its id, which must not be looked up as a value
    assert {r.id: r.clean_v for r in found} == {
        "1": "A", "2": "A", "3": "B", "4": "c", "5": " ", "6": None, "7": "seven",
    }
    assert len(found) == len(ROWS) and found[0].asDict().keys() == {"id", "v", "clean_v"}


def test_no_column_name_is_reserved(spark, dirty):
    known = spark.createDataFrame([("a", "A")], "dirty string, clean string")
    extra = ["_key", "_open", "_hot", "_hot_clean", "_dirty", "_clean", "hot", "Hot_Clean", "open", "KEY", "other", "other_clean"]
    named = dirty.select("*", *[F.lit(name).alias(name) for name in extra])
    found = mapping.apply_mapping(named, "v", known, "clean_v", spread_by="id")
    assert found.columns == [*named.columns, "clean_v"]
    assert all([r[name] for name in extra] == extra for r in found.collect())
    assert found.where("clean_v = 'A'").count() == 2


def test_only_hot_values_are_broadcast(spark):
    rows = spark.range(10).select(F.col("id"), F.col("id").cast("string").alias("v"))
    known = spark.range(5000).select(F.col("id").cast("string").alias("dirty"), F.lit("x").alias("clean"))
    counts = known.select("dirty", F.lit(1).cast("long").alias("n"))
    hot = counts.where(F.col("n") >= counts.agg(F.sum("n")).scalar() * mapping.HOT_SHARE)
    assert hot.count() == 0
    assert mapping.apply_mapping(rows, "v", known, "c", "id", counts).where("c = 'x'").count() == 10


def test_rows_without_a_spreading_id_are_spread_by_themselves(spark):
    rows = spark.range(50).select(F.lit(None).cast("string").alias("id"), F.col("id").cast("string").alias("v"))
    known = spark.createDataFrame([("1", "one")], "dirty string, clean string")
    found = mapping.apply_mapping(rows, "v", known, "c", "id")
    assert found.where("c = 'one'").count() == 1 and found.count() == 50


def test_conflicting_appends_leave_one_pair(spark, tmp_path):
    path = str(tmp_path / "mapping")
    # two jobs that have both read the empty mapping
    for clean, at in (("B", "2024-01-02"), ("A", "2024-01-03")):
        pair = spark.createDataFrame([("regions", "x", clean)], "domain string, dirty string, clean string")
        pair.withColumn("stored_at", F.lit(at).cast("timestamp")).write.mode("append").partitionBy("domain").parquet(path)
    assert [(r.dirty, r.clean) for r in read_mapping(spark, path, "regions").collect()] == [("x", "B")]
    twice = spark.createDataFrame([("y", "2"), ("y", "1"), ("x", "C")], "dirty string, clean string")
    append_mapping(twice, path, "regions")
    assert {tuple(r) for r in read_mapping(spark, path).collect()} == {("regions", "x", "B"), ("regions", "y", "1")}


def test_values_of_several_columns(spark, dirty):
    rows = dirty.withColumns({"w": F.when(F.col("id") > 3, "b").otherwise(F.col("v")), "x": F.lit(None).cast("string")})
    found = mapping.values_of(rows, ["v", "w", "x"])
    for column, values in found.items():
        expected = mapping.distinct_values(rows, column).collect()
        assert sorted(map(tuple, values.collect())) == sorted(map(tuple, expected))


def test_values_in_order(spark, dirty):
    assert [(r.dirty, r.n) for r in mapping.sorted_values(dirty, "v").collect()] == [("7", 1), ("a", 2), ("b", 1), ("c", 1)]


def test_unmapped_merge_and_vocabulary(spark, dirty):
    stored = spark.createDataFrame([("a", "A")], "dirty string, clean string")
    assert {(r.dirty, r.n) for r in mapping.unmapped_values(dirty, "v", stored).collect()} == {
        ("b", 1), ("c", 1), ("7", 1),
    }
    new = spark.createDataFrame([("a", "other"), ("b", "B")], "dirty string, clean string")
    assert {tuple(r) for r in mapping.merge_mapping(stored, new).collect()} == {("a", "A"), ("b", "B")}
    assert {r.dirty for r in mapping.out_of_vocabulary(dirty, "v", ["a", "b"]).collect()} == {"c", "7"}


def test_stored_mapping_grows_and_keeps_what_it_has(spark, tmp_path):
    path = str(tmp_path / "mapping")
    assert read_mapping(spark, path, "regions").count() == 0
    append_mapping(spark.createDataFrame([("NE", "Northeast")], "dirty string, clean string"), path, "regions")
    later = spark.createDataFrame([("NE", "wrong"), ("SE", "Southeast")], "dirty string, clean string")
    append_mapping(later, path, "regions")
    append_mapping(later, path, "segments")
    assert {(r.dirty, r.clean) for r in read_mapping(spark, path, "regions").collect()} == {
        ("NE", "Northeast"), ("SE", "Southeast"),
    }
    assert read_mapping(spark, path).count() == 4


def test_a_rerun_resolves_only_new_names(spark, tmp_path):
    path = str(tmp_path / "names")
    first = spark.createDataFrame(
        [("Acme Industrial Corp",), ("ACME INDUSTRIAL CORP",), ("Acme Industrial Corp",)], "customer_name string"
    )
    assert {r.clean for r in refresh_names(first, path).collect()} == {"Acme Industrial Corp"}
    files = sorted(p.name for p in (tmp_path / "names").rglob("*.parquet"))
    refresh_names(first, path)
    assert read_mapping(spark, path, "customers").count() == 2
    second = first.union(spark.createDataFrame([("Acme Industral Corp",)], "customer_name string"))
    assert {(r.dirty, r.clean) for r in refresh_names(second, path).collect()} == {
        (name, "Acme Industrial Corp")
        for name in ("Acme Industrial Corp", "ACME INDUSTRIAL CORP", "Acme Industral Corp")
    }
    assert set(files) <= {p.name for p in (tmp_path / "names").rglob("*.parquet")}


def test_resolver_batches_and_defaults(spark):
    values = spark.createDataFrame([(f"name {i}",) for i in range(158)], "dirty string").coalesce(1)

    def answer(batch):
        return {batch[0]: f"first of {len(batch)}"}

    found = resolver.resolve_batches(values, answer).collect()
    assert sorted(r.clean for r in found if r.clean.startswith("first")) == ["first of 50"] * 3 + ["first of 8"]
    assert sum(r.clean.startswith("Name ") for r in found) == 154


def test_answers_in_json(spark):
    rows = [("a", '{"mapping": {"a": "A"}}'), ("b co", '{"mapping"'), ("c", "{}"), ("d", '{"mapping": {"x": "X"}}')]
    df = spark.createDataFrame(rows, "dirty string, answer string")
    assert {tuple(r) for r in resolver.answers_for(df, "dirty", "answer").collect()} == {
        ("a", "A", True), ("b co", "B Co", False), ("c", "C", False), ("d", "D", False),
    }
    assert sorted(map(str, (r.dirty for r in resolver.mapping_rows(df, "answer").collect()))) == ["None", "None", "a", "x"]


def test_rows_are_moved_to_their_names_without_the_other_clean_columns(spark):
    columns = ["transaction_id", "customer_name", "region", "industry_segment", "order_date", "revenue_usd"]
    raw = spark.createDataFrame([("1", "acme  co", "NE", "Timber", "03/15/2024", "$ 5")], ", ".join(f"{c} string" for c in columns))
    names = spark.createDataFrame([("acme  co", "Acme Co", 1)], "dirty string, clean string, n long")
    regions = spark.createDataFrame([("NE", "Northeast", 1)], "dirty string, clean string, n long")
    segments = spark.createDataFrame([("Timber", "Mining", 1)], "dirty string, clean string, n long")
    plain = clean_transactions(raw, names)
    mapped = clean_with_mappings(raw, names, {"regions": regions, "segments": segments})
    for cleaned, segment in ((plain, "Wood Products"), (mapped, "Mining")):
        clean = ["region_clean", "industry_segment_clean", "order_date_clean", "revenue_usd_clean", "customer_name_clean"]
        assert cleaned.columns == columns + clean
        [row] = cleaned.select(*clean).collect()
        assert (row[0], row[1], str(row[2]), row[3], row[4]) == ("Northeast", segment, "2024-03-15", 5.0, "Acme Co")
        lines = cleaned._jdf.queryExecution().optimizedPlan().toString().splitlines()
        first_join = next(i for i, line in enumerate(lines) if "Join" in line)
        assert not any("order_date_clean" in line for line in lines[first_join:])


def test_packed_texts_come_back_as_they_were(spark):
    rows = [("a", "x", None, ""), ("b", None, "\x1f", "\x1e"), ("c", "", " ", "�"), ("d", None, None, None), ("e", "\x1e", "", None)]
    df = spark.createDataFrame(rows, "id string, p string, q string, r string")
    bad = F.when(F.col("id") == "a", F.unhex(F.lit("61C3")).cast("string")).otherwise(F.col("r"))  # bytes that are no text
    df = df.withColumn("r", bad)
    packed = df.select("id", packing.pack([F.col(c) for c in "pqr"]).alias("packed"))
    found = packing.unpack(packed, "packed", ["p", "q", "r"])
    assert found.columns == ["id", "p", "q", "r"]
    # the bytes of each text, and its absence
    hexes = [F.hex(F.col(c).cast("binary")).alias(c) for c in df.columns]
    assert sorted(map(tuple, found.select(hexes).collect()), key=str) == sorted(map(tuple, df.select(hexes).collect()), key=str)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_packed_lookup_gives_the_same_rows(spark, dirty, threshold):
    known = spark.createDataFrame([("a", "A", 1000), ("b", "B", 1)], "dirty string, clean string, n long")
    rows = dirty.withColumns({"packed": F.lit("p"), "parts": F.upper("v"), "number": F.lit(1)}).select("number", "parts", "v", "id", "packed")
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain, packed = (
            mapping.apply_mapping(rows, "v", known, "clean_v", "id", counts=known, packed=packed) for packed in (False, True)
        )
        assert packed.schema == plain.schema
        assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        # a text that is the target as well is replaced
        assert mapping.apply_mapping(rows, "v", known, "v", "id", counts=known, packed=True).where("v = 'A'").count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_rows_meet_their_names_with_packed_texts(spark):
    raw = spark.createDataFrame([("1", "acme  co", "NE", "Timber", "03/15/2024", "$ 5")],
                                "transaction_id string, customer_name string, region string, industry_segment string, "
                                "order_date string, revenue_usd string")  # fmt: skip
    names = spark.createDataFrame([("acme  co", "Acme Co", 1)], "dirty string, clean string, n long")
    plan = clean_transactions(raw, names)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    moved = plan.children().head().output().mkString(" ")
    assert "packed" in moved and not any(c in moved for c in ("region", "industry_segment", "order_date", "revenue_usd"))

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearbook.operators import mapping
from clearbook.sources.mapping_store import MappingStore


@pytest.fixture
def joins_by_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "dirty string, clean string")


def stored(store, domain=None):
    return {tuple(r) for r in store.read(domain).collect()}


def test_stored_pairs_win(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "store"), buckets=4)
    assert stored(store) == set() and store.read().columns == ["domain", "dirty", "clean"]
    store.compact()
    store.append(pairs(spark, ("a", "A"), ("b", "B"), ("b", "C"), (None, "x")), "names")
    store.append(pairs(spark, ("a", "other"), ("c", "C")), "names")
    store.append(pairs(spark, ("a", "Asia")), "regions")
    expected = {("names", "a", "A"), ("names", "b", "B"), ("names", "c", "C"), ("regions", "a", "Asia")}
    assert stored(store) == expected and stored(store, "regions") == {("regions", "a", "Asia")}
    # a session that knows nothing of it
    for table in spark.catalog.listTables():
        if table.name.startswith("mapping_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = MappingStore(spark, str(tmp_path / "store"), buckets=99)
    again.append(pairs(spark, ("d", "D"), ("c", "no")), "names")
    assert stored(again) == expected | {("names", "d", "D")}


def test_compaction(spark, tmp_path):
    path = tmp_path / "store"
    store = MappingStore(spark, str(path), buckets=4)
    for part in range(3):
        store.append(spark.range(part * 50, part * 50 + 100).selectExpr("'v' || id AS dirty", f"'{part}' AS clean"), "names")
    # two jobs side by side that both stored a value
    table = store._table(*store._versions()[-1])
    twice = spark.createDataFrame([("names", "v1", "late")], "domain string, dirty string, clean string")
    twice.withColumn("stored_at", F.expr("current_timestamp() + interval 1 day")).write.insertInto(table)
    before = stored(store)
    assert len(before) == 200 and ("names", "v1", "0") in before
    store.compact()
    assert stored(store) == before
    files = list(path.glob("version-1-buckets-4/*.parquet"))
    assert len(files) == 4 and spark.read.parquet(*map(str, files)).count() == 200
    store.compact(buckets=2)
    store.append(pairs(spark, ("new", "N"), ("v1", "no")), "names")
    assert stored(store) == before | {("names", "new", "N")}
    assert [v for v, _ in store._versions()] == [0, 1, 2]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "store"), buckets=2)
    store.append(pairs(spark, ("a", "A")), "names")
    store.compact()
    Path(tmp_path / "store" / "version-1-buckets-2" / "_SUCCESS").unlink()
    assert store._versions() == [(0, 2)] and stored(store) == {("names", "a", "A")}


def exchanges_below_the_stored_side(df):
    """The plan's lines from each scan of the store up to the join above it, as far as they are exchanges."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found = []
    for at, line in enumerate(plan):
        if "FileScan" not in line or "Bucketed: true" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        for above in reversed(plan[:at]):
            own = len(above) - len(above.lstrip(" :+-"))
            if own < depth:
                depth = own
                if "Join" in above:
                    break
                found += [above] if "Exchange" in above else []
    assert any("Bucketed: true" in line for line in plan)
    return found


def test_the_stored_side_stays_where_it_is(spark, tmp_path, joins_by_shuffle):
    store = MappingStore(spark, str(tmp_path / "store"), buckets=16)
    store.append(spark.range(1000).selectExpr("'v' || id AS dirty", "'V' || id AS clean"), "names")
    store.append(spark.range(500, 1500).selectExpr("'v' || id AS dirty", "'V' || id AS clean"), "names")
    rows = spark.range(3000).selectExpr("id", "'v' || (id % 2000) AS v")
    counts = mapping.distinct_values(rows, "v")
    looked_up = mapping.apply_mapping(rows, "v", store.read("names"), "clean_v", "id", counts=counts)
    new = mapping.only_new(counts, store.read("names"))
    assert looked_up.where("clean_v = upper(v)").count() == 2500 and new.count() == 500
    for df in (looked_up, new):
        assert exchanges_below_the_stored_side(df) == []
    store.compact()
    assert exchanges_below_the_stored_side(mapping.only_new(counts, store.read("names"))) == []

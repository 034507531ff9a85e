import random
import time

import pytest
from pyspark.sql import functions as F

from clearbook.operators import names


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def counted(spark, pairs):
    return spark.createDataFrame(list(pairs), "dirty string, n long")


TRUE_NAMES = ["Harbour Lights Trading Corp", "Blue Fern & Sons Inc", "Stone Mill Bakery", "Quartz Optics Group", "Delta 7 Freight"]


def test_spellings_of_some_companies(spark):
    truth = {}
    for name in TRUE_NAMES:
        written = {name, name.swapcase(), f" {name}\t", name.replace(" ", "   "), name.replace("&", "and"), name.replace(" ", "-")}
        lost = {name[:i] + name[i + 1 :] for i, c in enumerate(name) if not c.isdigit()}
        doubled = {name[:i] + "e" + name[i:] for i in range(2, len(name))}
        truth |= {spelling: name for spelling in written | lost | doubled}
    counts = [(s, 50 if s == t else 1) for s, t in truth.items()]
    found = names.canonical_names(counted(spark, counts)).collect()
    assert len(found) == len(truth) > 200
    assert {r.dirty: r.clean for r in found} == truth
    assert {r.merged_by for r in found} == {"same", "spelling", "edit"}


def test_frequent_near_equal_companies_stay_apart(spark):
    pairs = [("Bartec Industries", 1000), ("Bartek Industries", 990), ("Cargo Air Lines", 500), ("Cargo Aid Lines", 500), ("Cargo Air Line", 2)]
    found = {r.dirty: (r.clean, r.merged_by) for r in names.canonical_names(counted(spark, pairs)).collect()}
    assert found == {
        "Bartec Industries": ("Bartec Industries", "same"), "Bartek Industries": ("Bartek Industries", "same"),
        "Cargo Air Lines": ("Cargo Air Lines", "same"), "Cargo Aid Lines": ("Cargo Aid Lines", "same"),
        "Cargo Air Line": ("Cargo Air Lines", "edit"),
    }
    merged = names.canonical_names(counted(spark, pairs[:2]), ratio=1.0).collect()
    assert {r.clean for r in merged} == {"Bartec Industries"}


def test_names_that_differ_in_digits_stay_apart(spark):
    pairs = [("Customer#000000001", 3), ("Customer#000000002", 9), ("customer #000000001", 1), ("Custmer#000000002", 1)]
    found = {r.dirty: r.clean for r in names.canonical_names(counted(spark, pairs)).collect()}
    assert found == {
        "Customer#000000001": "Customer#000000001", "customer #000000001": "Customer#000000001",
        "Customer#000000002": "Customer#000000002", "Custmer#000000002": "Customer#000000002",
    }


def test_short_names_are_listed_and_not_matched_fuzzily(spark):
    counts = counted(spark, [("Abcde", 9), ("Abcd", 1), (" ", 5), (None, 5)])
    found = {r.dirty: (r.clean, r.merged_by) for r in names.canonical_names(counts).collect()}
    assert found == {"Abcde": ("Abcde", "short"), "Abcd": ("Abcd", "short")}
    found = {r.dirty: (r.clean, r.merged_by) for r in names.canonical_names(counts, min_length=4).collect()}
    assert found == {"Abcde": ("Abcde", "same"), "Abcd": ("Abcde", "edit")}


def test_nothing_is_merged_over_more_than_one_edit(spark):
    chain = [("abcdefghij"[:n], 10**n) for n in range(6, 11)]
    found = {r.key: r.parent for r in names.nearest_names(spark.createDataFrame(chain, "key string, n long")).collect()}
    assert found == {**{key: key for key, _ in chain}, "abcdefghi": "abcdefghij"}


def edits(a, b):
    """The least number of edits that touch no digit; None if there is no way."""
    far = 99
    row = [0]
    for y in b:
        row.append(far if y.isdigit() else row[-1] + 1)
    for x in a:
        previous, row[0] = row[0], far if x.isdigit() else row[0] + 1
        for j, y in enumerate(b, 1):
            swap = previous + (0 if x == y else far if x.isdigit() or y.isdigit() else 1)
            gone, come = (far if x.isdigit() else row[j] + 1), (far if y.isdigit() else row[j - 1] + 1)
            previous, row[j] = row[j], min(far, gone, come, swap)
    return row[-1]


def wishes_by_all_pairs(keys, known, ratio, distance):
    wish = {}
    for key in keys:
        near = [k for k in keys if k == key or (len(key) >= 6 and len(k) >= 6 and edits(key, k) <= distance)]
        best = min(near, key=lambda k: (k not in known, -keys[k], k))
        if best != key and key not in known and (best in known or keys[best] >= ratio * keys[key]):
            wish[key] = best
    return wish


def chained(keys, known, wish, head_share):
    def root(key):
        return root(wish[key]) if key in wish else key

    rows = {}
    for key, n in keys.items():
        rows[root(key)] = rows.get(root(key), 0) + n
    whole = {r for r, n in rows.items() if r in known or keys[r] >= head_share * n}
    direct = {key: wish[key] if key in wish and wish[key] not in wish else key for key in keys}
    return {key: root(key) if root(key) in whole else direct[key] for key in keys}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ratio", [1.0, 2.0])
@pytest.mark.parametrize("distance", [1, 2])
def test_nearest_names_against_all_pairs(spark, separate_partitions, seed, ratio, distance):
    rng = random.Random(seed)
    letters = "ab1" if distance == 1 else "abcde1"
    keys = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 8))): rng.randint(1, 9) for _ in range(250)}
    known = {key for key in keys if rng.random() < 0.05}
    rows = spark.createDataFrame([(key, n, key in known) for key, n in keys.items()], "key string, n long, known boolean")
    found = names.nearest_names(rows, ratio=ratio, distance=distance)
    wish = wishes_by_all_pairs(keys, known, ratio, distance)
    expected = {key: wish[key] if key in wish and wish[key] not in wish else key for key in keys}
    assert {r.key: r.parent for r in found.collect()} == expected
    assert seed or expected != {key: key for key in keys}


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("head_share", [0.0, 0.4])
def test_chains_against_following_every_wish(spark, separate_partitions, distance, head_share):
    rng = random.Random(distance)
    keys = {"".join(rng.choice("abc1") for _ in range(rng.randint(5, 9))): int(3 ** rng.uniform(0, 8)) for _ in range(300)}
    known = set(rng.sample(sorted(keys), 3))
    rows = spark.createDataFrame([(key, n, key in known) for key, n in keys.items()], "key string, n long, known boolean")
    found = names.nearest_names(rows, ratio=1.5, distance=distance, chains=True, head_share=head_share)
    wish = wishes_by_all_pairs(keys, known, 1.5, distance)
    expected = chained(keys, known, wish, head_share)
    assert {r.key: r.parent for r in found.collect()} == expected
    assert any(wish.get(wish.get(key)) == parent for key, parent in expected.items())


def test_a_long_chain(spark):
    chain = [("abcdefghijklmnopqr"[:n], 4**n) for n in range(6, 19)]
    df = spark.createDataFrame(chain, "key string, n long")
    assert {r.parent for r in names.nearest_names(df, chains=True).collect()} == {chain[-1][0]}
    alone = names.nearest_names(df.withColumn("n", F.when(F.length("key") == 18, 3).otherwise(1)), ratio=1.0, chains=True, head_share=0.9)
    assert {r.key: r.parent for r in alone.collect()}["abcdefghijklmnopq"] == chain[-1][0]
    assert len({r.parent for r in alone.collect()}) > 5


def test_two_edits_of_names(spark):
    name = "Harbour Lights Trading Corp"
    pairs = [(name, 50), ("Harbor Lights Tradng Corp", 1), ("Harbeur Lights Tradeng Corp", 1), ("Harbur Lights Tradding Corp", 1),
             ("Harbr Lights Tradng Corp", 1), ("Harbour Lights Trading Corp 2", 1)]
    found = {r.dirty: r.clean for r in names.canonical_names(counted(spark, pairs), distance=2).collect()}
    assert sorted(d for d, c in found.items() if c != name) == ["Harbour Lights Trading Corp 2", "Harbr Lights Tradng Corp"]
    one = names.canonical_names(counted(spark, pairs)).collect()
    assert {r.dirty for r in one if r.clean == name} == {name}
    with pytest.raises(ValueError, match="one edit or two"):
        names.nearest_names(spark.createDataFrame([("abcdef", 1)], "key string, n long"), distance=3)


def test_ties_go_by_the_whole_key(spark):
    start = "x" * 80
    keys = [(f"{start}{end}", 9) for end in ("qqc", "qqa", "qqb")] + [(f"{start}qq", 1)]
    found = {r.key: r.parent for r in names.nearest_names(spark.createDataFrame(keys, "key string, n long")).collect()}
    assert found[f"{start}qq"] == f"{start}qqa"


def test_known_names_attract_new_spellings(spark):
    known = spark.createDataFrame([("Acme Industrial Corp",)], "clean string")
    counts = counted(spark, [("Acme Industral Corp", 10**13), ("New Name Works", 1)])
    found = names.canonical_names(counts, known).collect()
    assert {r.dirty: r.clean for r in found} == {
        "Acme Industral Corp": "Acme Industrial Corp", "New Name Works": "New Name Works",
    }


def test_very_long_names_take_linear_room(spark):
    rng = random.Random(1)
    long = ["".join(rng.choices("abcdefgh", k=20_000)) for _ in range(40)]
    counts = [(name, 10) for name in long] + [(name[:777] + name[778:], 1) for name in long]
    started = time.time()
    found = names.canonical_names(counted(spark, counts))
    assert found.where("merged_by = 'edit'").count() == 40
    assert time.time() - started < 120


def test_a_single_name(spark):
    found = names.nearest_names(
        spark.range(1).select(F.lit("abcdefgh").alias("key"), F.lit(1).cast("long").alias("n"))
    )
    assert found.count() == 1


@pytest.mark.parametrize("distance", [1, 2])
def test_keys_are_dealt_to_tasks_and_their_parts_sorted_once(spark, distance):
    keys = spark.range(20_000).select("id", F.concat(F.lit("customer"), F.col("id").cast("string")).alias("key"))
    ranked = keys.withColumnRenamed("id", "rank").coalesce(1)
    plan = names._best_neighbours(ranked, distance)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    assert "hashpartitioning(rank" in plan.split("MapInArrow")[1]

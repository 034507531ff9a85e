import random
import re
from itertools import combinations

import pytest
import xxhash
from conftest import SMALL

from clearbook.llm import queries, simhash
from clearbook.llm.components import components


def fingerprint(text, size=3):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            ones[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if shingles and 2 * ones[bit] > len(shingles))


def classes(numbers, links):
    parent = {n: n for n in numbers}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in numbers}


def expected_rows(docs, radius):
    prints = [fingerprint(d.text) for d in docs]
    distinct = sorted(set(prints))
    near = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= radius]
    root = classes(distinct, near)
    lowest = {}
    for doc, value in zip(docs, prints):
        if doc.doc_id is not None:
            lowest[root[value]] = min(lowest.get(root[value], doc.doc_id), doc.doc_id)
    return sorted(f"{d.doc_id} {p:016x} {lowest.get(root[p])}" for d, p in zip(docs, prints))


def test_messy_rows(messy):
    found = simhash.near_duplicates(messy, shingle=3, radius=2).collect()
    assert sorted(f"{r.doc_id} {r.fingerprint} {r.component_id}" for r in found) == expected_rows(messy.collect(), 2)


def test_query(spark):
    found = queries.op4_simhash(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert sorted(f"{r.doc_id} {r.fingerprint} {r.component_id}" for r in found) == expected_rows(docs, 2)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_some_mask_avoids_any_positions(radius):
    masks = simhash.covering_masks(radius)
    for bits in combinations(range(64), min(radius, 3)):
        assert any(not any(mask >> bit & 1 for bit in bits) for mask in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_against_all_pairs(spark, radius):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(8)]
    numbers = {c for c in centres}
    for _ in range(150):
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        numbers.add(value)
    signed = {n - (1 << 64) if n >= 1 << 63 else n: n for n in numbers}
    frame = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    links = [(signed[r.a], signed[r.b]) for r in simhash.near_links(frame, radius).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in links)
    near = [(a, b) for a, b in combinations(sorted(numbers), 2) if (a ^ b).bit_count() <= radius]
    assert classes(numbers, links) == classes(numbers, near)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(messy, empty):
    messy = messy.where("doc_id IS NULL OR doc_id <> 7")  # two texts of one id would share a component's name
    kept = simhash.one_of_each(messy, 3, 2)
    assert kept.columns == messy.columns
    survivors = {str(r.doc_id) for r in kept.collect()}
    named = simhash.near_duplicates(messy, 3, 2).collect()
    assert kept.count() == len({str(r.component_id) for r in named})
    assert survivors == {str(r.component_id) for r in named}
    assert simhash.one_of_each(empty, 3, 2).count() == simhash.near_duplicates(empty, 3, 2).count() == 0

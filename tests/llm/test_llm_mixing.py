import heapq
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from clearbook.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_of(sizes, weights, share, passes):
    """Reshare the excess by weight until no source is above its bound."""
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = {s: weights[s] for s in sizes if s not in capped}
        left = total - sum(capped.values())
        found = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        above = {s: float(passes * sizes[s]) for s, t in found.items() if t > passes * sizes[s]}
        if not above:
            return capped | found
        capped |= above


def seats_of(values, house, most=None):
    """Seat by seat to the highest quotient, the smaller key first."""
    quotas = dict.fromkeys(values, 0)
    bids = [(-float(v), key) for key, v in values.items() if v > 0 and (most is None or most[key])]
    heapq.heapify(bids)
    for _ in range(house):
        _, key = heapq.heappop(bids)
        quotas[key] += 1
        if most is None or quotas[key] < most[key]:
            heapq.heappush(bids, (-float(values[key]) / (2 * quotas[key] + 1), key))
    return quotas


@pytest.mark.parametrize("seed", range(4))
def test_seats_against_the_auction(spark, seed):
    rng = np.random.default_rng(seed)
    values = {f"={i}": float(v) for i, v in enumerate(rng.choice([0, 1, 2, 3, 10, 17.5, 400, 1e5], 12))}
    houses = [0, 1, 2, 5, 11, 12, 13, 40, 333, 1000]
    rows = spark.createDataFrame(list(values.items()), "key string, v double")
    found = defaultdict(dict)
    for r in mixing.apportion(rows, houses, "v").collect():
        found[r.number][r.key] = r.quota
    for number, house in enumerate(houses):
        assert found[number] == seats_of(values, house)


def test_quotas_stop_at_all_passes(spark):
    sources = [("=a", 10, 20.0), ("=b", 33, 66.0), ("=c", 1, 2.0), ("=d", 1000, 900.0), ("=e", 64, 128.0), ("", 0, 0.0)]
    df = spark.createDataFrame(sources, "key string, size long, target double")
    rows = {r.key: r for r in mixing.quotas(df, 32, 2, 5).collect()}
    most = {k: 2 * -(-s // 32) for k, s, _ in sources}
    house = round(sum(t for *_, t in sources) / 32)
    assert {k: r.quota for k, r in rows.items()} == seats_of({k: t for k, _, t in sources}, house, most)
    for shard in range(5):
        expected = seats_of({k: r.quota for k, r in rows.items()}, house * (shard + 1) // 5)
        assert {k: r.by_shard[shard] for k, r in rows.items()} == expected


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097])
def test_permutations(count):
    found = [mixing.permuted(np.arange(count), count, key) for key in (1, 2)]
    assert all(sorted(f.tolist()) == list(range(count)) for f in found)
    assert count < 60 or (found[0] != found[1]).mean() > 0.5
    if count == 4097:  # no block is favoured
        firsts = Counter(b for key in range(300) for b in np.argsort(mixing.permuted(np.arange(50), 50, key))[:25].tolist())
        assert min(firsts.values()) > 100 and max(firsts.values()) < 200


def check(spark, documents, shards=7, block=32):
    """Targets, quotas and pieces of a table against the definitions, word by word."""
    weights = mixing.by_rank(documents, [3, 1, 2])
    mixed = mixing.mix(documents, weights, 1.5, 2, block, shards)
    rows, docs = mixed.collect(), documents.collect()
    names = sorted({d.source for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    given = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    assert {r.source: r.weight for r in weights.collect()} == given
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    sizes = {s: sizes[s] for s in names}
    targets = targets_of(sizes, given, 1.5, 2)
    key = {s: "" if s is None else f"={s}" for s in names}
    most = {key[s]: 2 * -(-sizes[s] // block) for s in names}
    house = min(round(sum(targets.values()) / block), sum(most.values()))
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(d.doc_id), len(WORD.findall(d.text or ""))) for d in docs)
    assert {r.source: r.target for r in rows} == pytest.approx(targets)
    targets |= {r.source: r.target for r in rows}  # equal but for the last bit, which would settle ties
    quotas = seats_of({key[s]: targets[s] for s in names}, house, most)
    taken, seats, shard_of = Counter(), defaultdict(Counter), {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        times = np.zeros(r.size, dtype=int)
        for p in r.pieces:
            assert 0 <= p.begin < p.end <= r.size
            times[p.begin : p.end] += 1
            seats[r.source][p.seat] += p.end - p.begin
            assert shard_of.setdefault((r.source, p.seat), p.shard) == p.shard
        assert not r.size or times.max() <= 2
        taken[r.source] += int(times.sum())
    for s in names:
        assert set(seats[s]) == set(range(quotas[key[s]]))
        blocks = -(-sizes[s] // block)
        short = {n for n, words in seats[s].items() if words != block}
        assert short <= {n for n in range(quotas[key[s]]) if n % blocks == blocks - 1}
        assert abs(taken[s] - targets[s]) <= 2 * block
        for shard in range(shards):
            expected = seats_of(quotas, house * (shard + 1) // shards)[key[s]]
            assert sum(shard_of[s, n] <= shard for n in range(quotas[key[s]])) == expected
    return rows


def test_documents_against_the_definitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = check(spark, docs)
    again = mixing.mix(docs.repartition(5), mixing.by_rank(docs, [3, 1, 2]), shards=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    other = mixing.mix(docs, mixing.by_rank(docs, [3, 1, 2]), shards=7, seed=1).collect()
    assert sorted(map(str, other)) != sorted(map(str, rows))


def test_messy_rows(spark, messy, empty):
    rows = check(spark, messy)
    assert {"lang", "n_chars", "key", "_part"} <= set(rows[0].asDict())
    assert mixing.mix(empty, mixing.by_rank(empty, [3, 1, 2])).count() == 0
    no_words = messy.withColumn("text", F.lit(" "))
    found = mixing.mix(no_words, mixing.by_rank(no_words, [3, 1, 2])).collect()
    assert len(found) == messy.count() and all(r.pieces == [] and r.target == 0 for r in found)


def test_sources_without_a_weight_give_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    weights = spark.createDataFrame([("src0", 1.0), ("src1", 2.0), ("src0", 0.5)], "source string, weight double")
    taken = mixing.mix(docs, weights, share=0.05).groupBy("source", "target").agg(F.sum(mixing.words_taken()).alias("taken"))
    found = {r.source: (r.target, r.taken) for r in taken.collect()}
    assert all(v == (0, 0) for s, v in found.items() if s not in ("src0", "src1"))
    assert abs(found["src1"][0] - 2 * found["src0"][0]) < 1e-6
    assert all(abs(t - n) <= 64 for t, n in found.values())


def test_query(spark):
    rows = queries.op11_mixing(spark, SMALL).collect()
    docs = {d.doc_id: d for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in rows:
        assert r.size == len(WORD.findall(docs[r.doc_id].text)) and r.taken <= 2 * r.size
        taken[docs[r.doc_id].source] += r.taken
        target[docs[r.doc_id].source] = r.target
    assert len(rows) == len(docs)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(abs(taken[s] - t) <= max(64, 0.02 * t) for s, t in target.items())

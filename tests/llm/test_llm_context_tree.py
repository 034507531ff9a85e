import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from clearbook.llm import context_tree, queries


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def path(byte):
    node = 1
    for shift in range(7, -1, -1):
        yield node, byte >> shift & 1
        node = 2 * node + (byte >> shift & 1)


class Tree:
    """Context-tree weighting node by node, by its definition."""

    def __init__(self, texts, depth):
        self.depth, self.count, self.children, self.known = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for text in texts:
            symbols = self.symbols(text)
            for at in range(depth, len(symbols)):
                for d in range(depth + 1):
                    context = tuple(symbols[at - d : at])
                    for node, bit in path(symbols[at]):
                        self.count[context, node][bit] += 1
                        if d:
                            self.children[context[1:], node].add((context, node))

    def symbols(self, text):
        return [255] * self.depth + list(fold(text).encode()) + [255]

    def own(self, key):
        a, b = self.count.get(key, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, key):
        if key not in self.known:
            value = self.own(key)
            if len(key[0]) < self.depth:
                below = sum(self.weighted(child) for child in self.children[key])
                value = math.log(0.5) + max(value, below) + math.log1p(math.exp(-abs(value - below)))
            self.known[key] = value
        return self.known[key]

    def one(self, context, node, d=0):
        key = (context[self.depth - d :], node)
        a, b = self.count.get(key, (0, 0))
        mine = (b + 0.5) / (a + b + 1)
        if d == self.depth:
            return mine
        weight = 0.5 * math.exp(self.own(key) - self.weighted(key))
        return weight * mine + (1 - weight) * self.one(context, node, d + 1)

    def score(self, text):
        symbols, total = self.symbols(text), 0.0
        for at in range(self.depth, len(symbols)):
            for node, bit in path(symbols[at]):
                one = self.one(tuple(symbols[at - self.depth : at]), node)
                total += math.log10(one if bit else 1 - one)
        return total


def base(docs, learned):
    words = [re.findall(r"[^\x20\x09-\x0D]+", fold(text)) + [""] for _, text in docs]
    count = Counter(w for ws, (i, _) in zip(words, docs) if i in learned for w in ws)
    total, distinct = sum(count.values()), len(count)
    return [
        (len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws))
        for ws in words
    ]


def table(spark, path, docs):
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_scores_against_the_definition(spark, tmp_path, depth):
    rng = random.Random(depth)
    pieces = ["the ", "of", "A", "B", "é", " ", "\n", "xyz ", "", "\t", "中", "\x00"]
    docs = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 25)))) for i in range(50)]
    docs += [(100, None), (101, ""), (102, "the of"), (103, "the of")]
    frame = table(spark, str(tmp_path / "docs"), docs)
    found = {r.doc_id: r for r in context_tree.score(frame, F.col("doc_id") % 3 != 0, depth=depth, block_bytes=200).collect()}
    learned = {i for i, _ in docs if i % 3}
    tree = Tree([t for i, t in docs if i in learned], depth)
    assert len(found) == len(docs)
    for (i, text), (tokens, known, total, score) in zip(docs, base(docs, learned)):
        row = found[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (tokens, known, total)
        assert math.isclose(row.base_score, score, rel_tol=1e-9) and math.isclose(row.score, tree.score(text), rel_tol=1e-7)
        assert math.isclose(row.bits_per_byte, -row.score * math.log2(10) / (len(fold(text).encode()) + 1))


def test_messy_and_empty_tables(messy, empty):
    rows = context_tree.score(messy, F.col("doc_id") > 5, block_bytes=50_000).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in messy.collect())
    assert all(r.score < 0 and r.n_tokens > 0 for r in rows)
    same = [r.score for r in rows if r.doc_id is None]
    assert len(set(same)) == 2  # two rows without id share their text, one has none
    assert context_tree.score(empty, F.lit(True)).count() == 0
    untrained = context_tree.score(messy, F.lit(None).cast("boolean")).collect()
    assert all(math.isclose(r.bits_per_byte, 8) and r.train_tokens == 0 for r in untrained)


def test_probabilities_of_all_next_bytes_add_to_one(spark):
    rng = random.Random(0)
    counts = Counter(rng.randrange(4) << 16 | rng.randrange(4) << 8 | rng.randrange(97, 123) for _ in range(300))
    asked = {2 << 16 | 3 << 8 | byte: counts.pop(2 << 16 | 3 << 8 | byte, 0) for byte in range(256)}
    frame = spark.createDataFrame(list((counts | asked).items()), "gram long, n long")
    found = {r.gram: r.logp for r in context_tree.probabilities(frame, depth=2).collect()}
    assert math.isclose(sum(10 ** found[g] for g in asked), 1)


def test_query(spark):
    rows = queries.op5_context_tree(spark, SMALL).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    learned = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 != 2}
    expected = dict(zip([i for i, _ in docs], base(docs, learned)))
    assert {r.doc_id for r in rows if not r.held_out} == learned
    for row in rows:
        assert (row.n_tokens, row.n_known, row.train_tokens) == expected[row.doc_id][:3]
        assert math.isclose(row.base_score, expected[row.doc_id][3], rel_tol=1e-9)
    # text of the same kind costs less than half of plain bytes
    assert sorted(r.bits_per_byte for r in rows if r.held_out)[len(rows) // 20] < 4

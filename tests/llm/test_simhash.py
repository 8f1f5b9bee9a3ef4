import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL, read, rows
from tickwright.llm import simhash


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_pairs(x, y, same):
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= 3)
    return {(a, b) for a, b in zip(i.tolist(), j.tolist()) if not same or a < b}


def brute_components(prints, ids):
    """Smallest id reachable from each place."""
    values = np.array(sorted(set(prints)), np.uint64)
    parent = list(range(len(values)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, j in brute_pairs(values, values, True):
        parent[root(i)] = root(j)
    place = {int(v): root(i) for i, v in enumerate(values)}
    least = {}
    for p, i in zip(prints, ids):
        least[place[p]] = min(least.get(place[p], i), i)
    return [least[place[p]] for p in prints]


@pytest.fixture(scope="module")
def crowd():
    """Scattered fingerprints, chains of near ones, and a crowd around one value."""
    rng = np.random.default_rng(1)

    def near(base, n):
        bit = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        return base ^ bit ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))

    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    parts = [base, near(base, 200), near(near(base, 200), 200), near(np.uint64(0xABCDEF), 400)]
    return np.unique(np.concatenate(parts))


@pytest.mark.parametrize(
    "text", ["A b c d e f", "x", "", None, "É a É\x0b q r", "the " * 70_000, "a\tb\r\nc"]
)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) % 2**64 == plain_fingerprint(text)


def test_trie_pairs(crowd):
    other = np.unique(crowd[::3] ^ np.uint64(5))
    for x, y in ((crowd, crowd), (crowd, other)):
        got = [p for i, j in simhash.close_pairs(x, y, 3) for p in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got))
        assert set(got) == brute_pairs(x, y, x is y)


@pytest.mark.parametrize("leaf", [20, 5000])
def test_links_connect_what_is_close(spark, crowd, leaf):
    values = crowd.view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.links(nodes, leaf=leaf).collect()
    assert len(found) < 40 * len(values)
    roots = {r.u: r.root for r in simhash.components(simhash.links(nodes, leaf=leaf)).collect()}
    assert [roots.get(v, v) for v in values] == brute_components(crowd.tolist(), values)


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_documents(spark):
    docs = read(spark, SMALL, "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [plain_fingerprint(t) for _, t in texts]
    least = brute_components(prints, [i for i, _ in texts])
    expected = sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(texts, prints, least))
    assert rows(simhash.near_dedup(docs), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(i,) for i in sorted(set(least))]


def test_nulls_repeats_and_clashing_columns(spark):
    cases = [(3, None), (3, None), (None, ""), (2, "b c d"), (2, "b c d"), (2, "B C d"), (None, "q"), (None, "Q")]
    docs = spark.createDataFrame(cases, "doc_id long, text string").withColumns(
        {"root": F.lit(1), "fp": F.lit(2), "address": F.lit("x"), "component_id": F.lit(0)}
    )
    found = rows(simhash.near_dedup(docs), "doc_id", "component_id")
    assert found == [(None, None), (None, None), (None, 3), (2, 2), (2, 2), (2, 2), (3, 3), (3, 3)]
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(None,), (2,), (3,)]
    assert simhash.first_of_each(docs.limit(0)).count() == 0


def test_tries_are_gone_down_a_bounded_front_at_a_time(monkeypatch):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 63, (60, 30)).astype(np.uint64)
    x = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel()]))

    def found():
        return sorted(p for i, j in simhash.close_pairs(x, x, 3) for p in zip(i.tolist(), j.tolist()))

    whole = found()
    monkeypatch.setattr(simhash, "_FRONT", 7)
    assert found() == whole
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 3
    assert whole == [(i, j) for i, j in zip(*np.nonzero(near)) if i < j]


def test_copies_per_fingerprint_at_two_depths(spark):
    """Sets of random fingerprints that are closed at depth 4 and at depth 8: how often each is sent."""
    rng = np.random.default_rng(2)
    prints = [(int(v),) for v in rng.integers(-(1 << 63), 1 << 63, 4000)]
    nodes = spark.createDataFrame(prints, "fp long").distinct().cache()
    copies = {}
    for leaf in (400, 40):
        sent, depths = 0, []
        for depth, pairs in simhash.node_pairs(nodes, 3, leaf):
            counts = nodes.groupBy(simhash._prefix(F.col("fp"), depth).alias("b")).count()
            sent += pairs.join(counts, "b").agg(F.sum("count")).first()[0] or 0
            depths += [depth] * (not pairs.isEmpty())
        copies[max(depths)] = sent / nodes.count()
    # of 16 nodes 15 are within three bits, of 256 there are 93; a pair is sent to one of its nodes
    assert copies.keys() == {4, 8}
    assert copies[4] <= 8.5 and copies[8] <= 48
    nodes.unpersist()

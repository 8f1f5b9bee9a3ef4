"""Codes and codebooks against a plain reading of the rules, in Python's integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import MIDDLE, SMALL, duck, read, rows
from tickwright.llm import quantize

SHOWN = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
MOST = 2**63 - 1


def brute(cases, parts=8, entries=16, rounds=6):
    """Rows (vec_id, code, error, label_error, digest) of (vec_id, vector, label)."""
    kept = []
    for i, v, label in cases:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            scaled = [math.floor(max(min(4096.0 * x, 2.0**62), -(2.0**62))) for x in v]
            kept.append((i, scaled, label))
    if not kept:
        return []
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    full = [v + [0] * (parts * size - len(v)) for _, v, _ in kept]
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in full]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))
    books = [[cut[n][p] for n in order[:entries]] for p in range(parts)]

    def assigned():
        return [
            [min((sum((x - y) ** 2 for x, y in zip(own, e)), i) for i, e in enumerate(books[p])) for p, own in enumerate(v)]
            for v in cut
        ]

    for _ in range(rounds):
        near = assigned()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [v[p] for v, found in zip(cut, near) if found[p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    near = assigned()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [min(MOST, sum(d for d, _ in found)) for found in near]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    out = [
        (i, "".join(f"{e:02x}" for _, e in found), error, min(MOST, by_label[label]), digest)
        for (i, _, label), found, error in zip(kept, near, errors)
    ]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def frame(spark, cases):
    return spark.createDataFrame(cases, "vec_id long, embedding array<double>, label int")


@given(
    st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-6, 6), min_size=2, max_size=2), min_size=1, max_size=20),
    st.sampled_from([1, 1 << 33]),
)
@settings(max_examples=300, deadline=None)
def test_orchard_equals_looking_at_every_entry(entries, points, unit):
    """Ties, repeated entries and numbers whose squares need more than 64 bits."""
    entries, points = np.array(entries, np.int64) * unit, np.array(points, np.int64) * unit
    code, distance = quantize.Orchard(entries).nearest(points)
    for p, c, d in zip(points.tolist(), code, distance):
        assert (d, c) == min((sum((x - y) ** 2 for x, y in zip(p, e)), i) for i, e in enumerate(entries.tolist()))


def test_orchard_does_not_look_at_far_entries():
    """Near one of two clusters of entries, the other's are ruled out by the sorted lists."""
    entries = np.array([[i] for i in range(8)] + [[10_000 + i] for i in range(8)], np.int64)
    search = quantize.Orchard(entries)
    looked = []
    search.entries = type("Seen", (np.ndarray,), {
        "__getitem__": lambda self, key: looked.append(key) or np.ndarray.__getitem__(self, key)
    })
    search.entries = entries.view(search.entries)
    assert search.nearest(np.array([[3]]))[0].tolist() == [3]
    assert all(np.max(key, initial=0) < 8 for key in looked)


@pytest.mark.parametrize("few", [quantize.FEW_LABELS, 0])
def test_clusters_equal_brute_force(spark, few):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 24))
    points = centres[rng.integers(0, 5, 220)] + rng.normal(size=(220, 24)) * 0.1
    cases = [(int(i) * 3, np.round(p, 2).tolist(), int(i) % 4 or None) for i, p in zip(rng.permutation(220), points)]
    found = quantize.compress(frame(spark, cases).repartition(7), few_labels=few)
    assert rows(found, *SHOWN) == brute(cases)


def test_given_tables_equal_brute_force_and_sql(spark):
    given_rows = read(spark, SMALL, "embeddings").select("vec_id", "embedding", "label").collect()
    found = rows(quantize.compress(read(spark, SMALL, "embeddings")), *SHOWN)
    assert found == brute([tuple(r) for r in given_rows])
    middle = rows(quantize.compress(read(spark, MIDDLE, "embeddings")), *SHOWN)
    assert middle == sorted(duck(MIDDLE).execute(f"SELECT {', '.join(SHOWN)} FROM ({quantize.compress_sql()})").fetchall())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (5, [0.1] * 9, 1), (5, [0.1] * 9, 1), (5, [0.2] * 9, 1), (None, [0.3, -0.00001], None), (None, None, 1),
        (6, [], None), (7, [nan, 1.0], 2), (8, [None, 1.0], 2), (9, [1.0, -inf], 2), (10, [-0.0], 2),
        (-3, [1e30, -1e300, 0.5], 3), (11, [3e9, -2e12], 3),
    ]
    many = [*odd, *((100 + i, [i / 7, -i / 3, (i * i) % 11 / 5], i % 2) for i in range(30))]
    for cases in (odd, many, odd[:1], [(1, [], 0)], odd[3:4]):
        own = frame(spark, cases).withColumns({c: F.lit("x") for c in ("id", "v", "code", "error", "same", "n")})
        assert rows(quantize.compress(own), *SHOWN) == brute(cases)
    for cases in ([], odd[4:5], odd[6:9]):
        assert quantize.compress(frame(spark, cases)).count() == 0


def test_codes_decode(spark):
    cases = [(i, [float(i % 3)] * 8, 0) for i in range(20)]
    whole = quantize.whole_vectors(frame(spark, cases).toDF("id", "vector", "label"), "vector", 4096)
    books = quantize.fit(whole)
    for r in quantize.encode(whole, books).collect():
        assert books.decode(r.code) == [4096 * (r.id % 3)] * 8 and r.error == 0

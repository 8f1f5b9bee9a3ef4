import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tickwright.llm.knn import top_k

SHOWN = ("query_id", "rank", "vec_id", "score")


def brute(vectors, every, top):
    """By rows: every row but the query's own is a candidate, one without an id comes last in a tie."""
    whole = [(i, np.floor(1024 * np.array(v, float)).astype(object)) for i, v in vectors]
    out = []
    for n, (q, v) in enumerate(whole):
        if q is not None and q % every == 0:
            best = sorted((-int(v @ w), i is None, i or 0) for m, (i, w) in enumerate(whole) if m != n)[:top]
            out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(best, 1)]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("blocks", [(7 * 64, 2 * 64), (1 << 20, 1 << 20), (40 * 64, 4 * 64)])
@pytest.mark.parametrize("kind", ["clusters", "copies"])
def test_equals_brute_force(spark, blocks, kind):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8)) * 3
    noise = 0.01 if kind == "copies" else 0.3
    points = centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, 8)) * noise
    if kind == "copies":
        points = np.round(points, 1)
    # ids repeat with other vectors and with the same one, and some rows have none
    ids = [i if i % 7 else 20 * (i // 70) for i in range(300)]
    vectors = [(None if i % 31 == 5 else n, p.tolist()) for i, (n, p) in enumerate(zip(ids, points))]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = top_k(frame, every=20, pivots=5, data_bytes=blocks[0], query_bytes=blocks[1])
    assert rows(found, *SHOWN) == brute(vectors, 20, 10)


def test_rows_of_one_id_are_all_candidates(spark):
    frame = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [5.0, 0.0])], "vec_id long, embedding array<double>"
    )
    assert rows(top_k(frame), *SHOWN) == [(0, 1, 1, 5 * 2**20), (0, 2, 1, 2**20)]


def test_far_cells_are_not_sent(spark, monkeypatch):
    """Queries near one pivot do not need the vectors that point the other way; the others come once."""
    from tickwright.llm import knn

    sent = []
    plain = knn._needed
    monkeypatch.setattr(knn, "_needed", lambda *a: sent.append(plain(*a)) or sent[-1])
    rng = np.random.default_rng(2)
    near, far = rng.normal(size=(60, 4)) * 0.01 + 5, rng.normal(size=(400, 4)) * 0.01 - 5
    vectors = [(i, v.tolist()) for i, v in zip([*range(0, 600, 10), *range(1, 4000, 10)], [*near, *far])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = top_k(frame, every=10, pivots=8)
    assert rows(found, *SHOWN) == brute(vectors, 10, 10)
    assert sent[0].select("row").distinct().count() == sent[0].count() == 60


def test_nulls_ties_and_huge_components(spark):
    nan, inf = float("nan"), float("inf")
    cases = [
        (0, [1.0, 2.0]),
        (1, [1.0, 2.0]),
        (2, [1.0]),
        (None, [9.0, 9.0]),
        (3, None),
        (4, [None, 1.0]),
        (5, [nan, 1.0]),
        (6, [1.0, -inf]),
        (100, [0.5, 0.5]),
        (100, [0.5, 0.5]),
        (200, []),
    ]
    frame = spark.createDataFrame(cases, "vec_id long, embedding array<double>").withColumns(
        {"id": F.lit(1), "cell": F.lit(2), "distance": F.lit("x"), "row": F.lit(3), "group": F.lit(4)}
    )
    finite = [(i, [*v, 0.0, 0.0][:2]) for i, v in cases if v is not None and all(x is not None and abs(x) < inf for x in v)]
    assert len(finite) == 7
    assert rows(top_k(frame), *SHOWN) == brute(finite, 100, 10)
    huge = spark.createDataFrame([(0, [1e9]), (1, [1e9]), (2, [-1e9])], "vec_id long, embedding array<double>")
    assert rows(top_k(huge), "vec_id", "score") == [(1, 2**63 - 1), (2, -(2**63))]
    exact = spark.createDataFrame([(0, [1e5, 3e-3]), (1, [1e5, 1e-3])], "vec_id long, embedding array<double>")
    assert rows(top_k(exact), "score") == [(102_400_000**2 + 3,)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert top_k(none).count() == 0
    alone = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<double>")
    assert top_k(alone).count() == 0
    assert top_k(alone.withColumn("vec_id", F.lit(7))).count() == 0

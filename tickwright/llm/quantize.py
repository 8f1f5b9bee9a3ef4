"""Product quantisation of vectors in whole numbers, with Orchard's search for the nearest entry.

Vectors are scaled to whole numbers and cut into equal parts. Each part position has a codebook of
a few entries. An entry keeps a list of all others, sorted by their distance from it. The search
walks the list of the best entry so far, jumps to the list of any entry that is better, marks
what it has seen, and stops once the list is farther than twice the current distance: by the
triangle inequality no entry beyond can be nearer.

The vectors are written once. A round is one pass of tasks that assign their vectors and give
back sums per entry; Spark adds them up, and what reaches the driver has the size of the codebooks.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Scaled components are kept within this on either side of zero, and sums of squares within MOST.
WIDEST, MOST = 1 << 62, (1 << 63) - 1
#: So many labels, two numbers each, are sent to every task; beyond that the join shuffles.
FEW_LABELS = 500_000
#: Numbers that a task unfolds at once.
AT_ONCE = 1 << 22


def _exact(values: np.ndarray, width: int) -> np.ndarray:
    """Python's integers instead of 64 bits where four times a sum of squares might not fit."""
    most = max((abs(int(values.min())), abs(int(values.max()))), default=0) if values.size else 0
    return values if 16 * max(1, width) * most * most < 1 << 63 else values.astype(object)


class Orchard:
    """Nearest of a few entries by squared distance, ties to the lower index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = _exact(entries, entries.shape[1])
        apart = ((self.entries[:, None] - self.entries[None]) ** 2).sum(axis=2)
        n = len(entries)
        self.lists = np.zeros((n, n), np.int64)
        # the last place of a list is its end
        self.far = np.full((n, n), None, object) if apart.dtype == object else np.zeros((n, n), np.int64)
        for i in range(n):
            others = sorted((j for j in range(n) if j != i), key=lambda j: (apart[i, j], j))
            self.lists[i, : n - 1] = others
            self.far[i, : n - 1] = apart[i, others]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance to it, of every point."""
        last, n = len(self.entries) - 1, len(points)
        points = _exact(points, points.shape[1])
        current = np.zeros(n, np.int64)
        best = ((points - self.entries[0]) ** 2).sum(axis=1)
        place = np.zeros(n, np.int64)
        seen = np.zeros((n, last + 1), bool)
        seen[:, 0] = True
        walking = np.arange(n) if last else np.zeros(0, np.int64)
        while len(walking):
            near = self.far[current[walking], place[walking]] <= 4 * best[walking]
            walking = walking[near.astype(bool)]
            entry = self.lists[current[walking], place[walking]]
            place[walking] += 1
            new = ~seen[walking, entry]
            at, met = walking[new], entry[new]
            seen[at, met] = True
            distance = ((points[at] - self.entries[met]) ** 2).sum(axis=1)
            better = (distance < best[at]) | ((distance == best[at]) & (met < current[at]))
            at = at[better.astype(bool)]
            current[at], best[at], place[at] = met[better.astype(bool)], distance[better.astype(bool)], 0
            walking = walking[place[walking] < last]
        return current, best


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]`` of vectors that are ``width`` wide, filled up with zeros."""

    entries: np.ndarray
    width: int

    def digest(self) -> str:
        """SHA-256 of all components in order, as decimals joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def searches(self) -> list[Orchard]:
        return [Orchard(own) for own in self.entries]

    def decode(self, code: str) -> list[int]:
        """The vector a code stands for, filled up to the full width."""
        own = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
        return np.concatenate([part[e] for part, e in zip(self.entries, own)]).tolist()


def whole_vectors(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """``v``: floor(scale * x) of every component, for vectors without NULL or non-finite ones."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    within = lambda c: F.floor(F.greatest(F.least(c * float(scale), F.lit(float(WIDEST))), F.lit(float(-WIDEST))))
    return vectors.filter(x.isNotNull() & finite).withColumn("v", F.transform(x, within)).drop(vector_col)


def _unfolded(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their vectors as rows of equal width."""
    for batch in batches:
        step = max(1, AT_ONCE // max(1, width))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            own = part.column("v")
            values, lengths = own.flatten().to_numpy(), own.value_lengths().to_numpy()
            out = np.zeros((len(lengths), width), np.int64)
            out[np.arange(width) < lengths[:, None]] = values
            yield part, out


def _summer(books: Codebooks):
    """Per task and component of an entry: how many vectors were assigned, and their sum."""
    parts, entries, size = books.entries.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros(books.entries.shape, object)
        for _, vectors in _unfolded(batches, books.width):
            # half the bits for each, so that no sum of a batch leaves 64 bits
            high, low = vectors >> 31, vectors & 0x7FFFFFFF
            for p, search in enumerate(searches):
                cut = slice(p * size, (p + 1) * size)
                code, _ = search.nearest(vectors[:, cut])
                n[p] += np.bincount(code, minlength=entries)
                for half, unit in ((high, 1 << 31), (low, 1)):
                    sums = np.zeros((entries, size), np.int64)
                    np.add.at(sums, code, half[:, cut])
                    total[p] += sums.astype(object) * unit
        used = np.flatnonzero(np.repeat(n.ravel(), size)) if n.any() else np.zeros(0, np.int64)
        columns = [
            pa.array(used, pa.int64()),
            pa.array(np.repeat(n.ravel(), size)[used], pa.int64()),
            pa.array([Decimal(int(x)) for x in total.ravel()[used]], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", "total"])

    return assign


def _encoder(books: Codebooks):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        size = books.entries.shape[2]
        for batch, vectors in _unfolded(batches, books.width):
            found = [s.nearest(vectors[:, p * size : (p + 1) * size]) for p, s in enumerate(searches)]
            codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error = sum(d.astype(object) for _, d in found)
            columns = [
                batch.column("id"),
                batch.column("label"),
                pa.array([row.tobytes().hex() for row in codes], pa.string()),
                pa.array([min(int(e), MOST) for e in error], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return encode


def fit(whole: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the vectors ``v`` with ids ``id``; None if there are no vectors.

    They begin with the vectors of the smallest ids (NULL ids last, equal ids by their vectors);
    fewer vectors than ``entries`` make fewer entries. Every round assigns all vectors and moves
    each entry to the floor of the mean of its own; entries without any stay.
    """
    widest = whole.agg(F.max(F.size("v")).alias("n")).first()["n"]
    if widest is None:
        return None
    size = -(-widest // parts)
    width = parts * size
    first = [r["v"] for r in whole.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    start = np.zeros((len(first), width), np.int64)
    for row, v in zip(start, first):
        row[: len(v)] = v
    books = Codebooks(start.reshape(len(first), parts, size).transpose(1, 0, 2).copy(), width)
    for _ in range(rounds if size else 0):
        sums = whole.select("v").mapInArrow(_summer(books), "slot long, n long, total decimal(38, 0)")
        moved = books.entries.copy()
        # one row per component of the codebooks
        for r in sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            moved.ravel()[r["slot"]] = int(r["total"]) // r["n"]
        books = Codebooks(moved, width)
    return books


def encode(whole: DataFrame, books: Codebooks) -> DataFrame:
    """id, label, code and error of the vectors ``v``."""
    kinds = whole.select("id", "label").schema
    spec = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    return whole.select("id", "label", "v").mapInArrow(_encoder(books), f"{spec}, code string, error long")


def compress(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    few_labels: int = FEW_LABELS,
) -> DataFrame:
    """id, code, error, label_error and codebooks_sha256 of every whole vector.

    Vectors that are NULL or hold NULL or non-finite components take no part. Shorter vectors are
    filled up with zeros to the longest, and all to a multiple of ``parts``. Scaled components are
    kept within 2^62, errors within a long; below that all numbers are exact. Rows that repeat, also
    NULL ids, are coded each by themselves; NULL labels are one label; no vectors give no rows;
    other columns are left behind. Label sums are sent to every task while there are at most
    ``few_labels`` of them, else joined by a shuffle.
    """
    given = documents(vectors, id_col, vector_col, label_col).toDF("id", "vector", "label")
    whole = written(whole_vectors(given, "vector", scale), "vectors")
    books = fit(whole, parts=parts, entries=entries, rounds=rounds)
    if books is None:
        none = F.lit(None)
        return whole.select(
            F.col("id").alias(id_col), none.cast("string").alias("code"), none.cast("long").alias("error"),
            none.cast("long").alias("label_error"), none.cast("string").alias("codebooks_sha256"),
        )
    coded = written(encode(whole, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38, 0)")), F.lit(MOST).cast("decimal(38, 0)"))
    sums = coded.groupBy(F.col("label").alias("same")).agg(total.cast("long").alias("label_error"))
    sums = written(sums, "labels")
    if sums.count() <= few_labels:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def compress_sql(rounds: int = ROUNDS) -> str:
    """The same over ``embeddings`` in SQL, a few common tables per round."""
    squares = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS nth, vec_id, label,
                   list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ),
        parts AS MATERIALIZED (
            SELECT nth, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS x
            FROM kept, (SELECT unnest(range({PARTS})) AS p)
        ),
        book0 AS MATERIALIZED (
            SELECT p, nth - 1 AS e, x AS y FROM parts WHERE nth <= {ENTRIES}
        )"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
        near{i} AS MATERIALIZED (
            SELECT nth, p, min({{'d': d, 'e': e}}) AS m
            FROM (SELECT nth, parts.p, e, {squares}::BIGINT AS d FROM parts JOIN book{i} b ON parts.p = b.p)
            GROUP BY nth, p
        )""")
        if i < rounds:
            steps.append(f"""
        mean{i} AS MATERIALIZED (
            SELECT p, e, list((total - (total % n + n) % n) // n ORDER BY place)::BIGINT[] AS y
            FROM (
                SELECT p, e, place, sum(c)::BIGINT AS total, count(*)::BIGINT AS n
                FROM (
                    SELECT p, m.e AS e, unnest(x) AS c, unnest(range(len(x))) AS place
                    FROM near{i} JOIN parts USING (nth, p)
                )
                GROUP BY p, e, place
            )
            GROUP BY p, e
        ),
        book{i + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(m.y, b.y) AS y FROM book{i} b LEFT JOIN mean{i} m USING (p, e)
        )""")
    return f"""
        WITH {",".join(steps)},
        coded AS (
            SELECT nth, string_agg(lpad(hex(m.e), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
            FROM near{rounds} GROUP BY nth
        ),
        digest AS (
            SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256
            FROM book{rounds}
        )
        SELECT vec_id, lower(code) AS code, error,
               sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (nth), digest
    """

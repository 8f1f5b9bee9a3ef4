"""Exact top-k search by inner product as a Voronoi nearest-neighbour join.

A data vector x gets one more coordinate, sqrt(M - |x|^2) with M the largest square norm, a
query gets 0. Then the largest inner products are the smallest distances, and the triangle
inequality holds. Pivots divide queries and data into cells. Summaries of the cells (their
radius and their k + 1 smallest distances to the pivot) bound, for each group of queries, how
far its k-th neighbour can be; a vector is sent to a group only if its distance to the
group's pivot does not rule it out. Groups are solved in blocks of queries and vectors, and
the blocks' best are ranked once more.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written

TOP = 10
SCALE = 1024
#: Pivots, and how many vectors are drawn for each to choose them from. These, and each pivot's
#: radius and k + 1 distances, are all the driver sees.
PIVOTS, DRAWN = 16, 64
#: Bytes of vectors and of queries that one task compares.
DATA_BYTES, QUERY_BYTES = 10 << 20, 1 << 19
#: Where the rows without an id stand among others.
_LAST = (1 << 63) - 1

_CHUNK = 4_096
_SLACK = 1e-6


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, id, vec): floor(scale * x) of every vector without NULL or non-finite components.

    Every row has a number of its own, which is odd if it has no id; such an id is the largest.
    """
    values = F.col("vec").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = documents(rows, id_col, vector_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    rows = rows.filter(F.col("vec").isNotNull() & finite)
    number = F.monotonically_increasing_id() * 2 + F.col("id").isNull().cast("long")
    whole = F.transform(values, lambda x: F.floor(x * scale))
    return rows.select(number.alias("row"), F.coalesce("id", F.lit(_LAST)).alias("id"), whole.alias("vec"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From each vector with its extra coordinate to each pivot (which has one)."""
    full = np.column_stack([x, extra])
    square = (full**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def spread_out(x: np.ndarray, number: int) -> np.ndarray:
    """So many of the vectors, each the farthest from those chosen before it."""
    chosen, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < number and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


class Cells:
    """The pivots and what the summaries say about their cells."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.largest = largest
        self.width = pivots.shape[1]
        self.pivots = np.column_stack([pivots, self.extra(pivots)])
        self.reach = np.full(len(pivots), -1.0)

    def extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.largest - (x**2).sum(1), 0))

    def of_data(self, vectors: pd.Series) -> np.ndarray:
        x = _matrix(vectors, self.width)
        return _distances(x, self.extra(x), self.pivots)

    def of_queries(self, vectors: pd.Series) -> np.ndarray:
        return _distances(_matrix(vectors, self.width), np.zeros(len(vectors)), self.pivots)

    def bound(self, radii: dict[int, float], nearest: pd.DataFrame, needed: int) -> None:
        """How far from its pivot a group's neighbours can be, by the groups' radii and the
        smallest distances of the data to their pivots."""
        between = _distances(self.pivots[:, :-1], self.pivots[:, -1], self.pivots)
        for group, radius in radii.items():
            upper = radius + between[group, nearest["cell"]] + nearest["distance"].to_numpy()
            kth = np.sort(upper)[needed - 1] if len(upper) >= needed else np.inf
            self.reach[group] = (radius + kth) * (1 + _SLACK) + _SLACK


def best_of_block(q_rows, q, x_rows, x_ids, x, top: int) -> pd.DataFrame:
    """The ``top`` vectors of each query but its own row, ties to smaller ids; x_ids must be sorted."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if bound >= 2**53:  # doubles would round
        q, x = (np.vectorize(int, otypes=[object])(m) if m.size else m for m in (q, x))
    queries, places, scores = [], [], []
    for at in range(0, len(x), _CHUNK):
        own = x_rows[at : at + _CHUNK]
        product = q @ x[at : at + _CHUNK].T
        order = np.argsort(own)
        place = order[np.searchsorted(own, q_rows, sorter=order) % len(own)]
        mine = np.flatnonzero(own[place] == q_rows)
        valid = np.ones(product.shape, bool)
        valid[mine, place[mine]] = False
        if product.shape[1] > top + 1 and product.dtype != object:
            seen = np.where(valid, product, -np.inf)
            valid &= product >= np.partition(seen, -top, axis=1)[:, [-top]]
        r, c = np.nonzero(valid)
        queries.append(r)
        places.append(c + at)
        score = product[r, c]
        if score.dtype == object:
            score = np.clip(score, -(2**63), 2**63 - 1)
        scores.append(score.astype(np.int64))
    r, c, score = (np.concatenate(own) if own else np.zeros(0, np.int64) for own in (queries, places, scores))
    found = pd.DataFrame({"query": r, "vec_id": x_ids[c], "vec_row": x_rows[c], "score": score})
    found = found.sort_values(["query", "score", "vec_id", "vec_row"], ascending=[True, False, True, True])
    found = found.groupby("query", sort=False).head(top)
    return found.assign(query_row=q_rows[found["query"]])[["query_row", "vec_id", "vec_row", "score"]]


def _solver(width: int, top: int):
    def solve(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        """Each cell's queries against the vectors sent for that cell."""
        found = [pd.DataFrame({c: [] for c in ("query_row", "vec_id", "vec_row", "score")}, dtype="int64")]
        if len(queries) and len(data):
            data = data.sort_values(["id", "row"])
            x, x_ids, x_rows = _matrix(data["vec"], width), data["id"].to_numpy(), data["row"].to_numpy()
            sent = pd.DataFrame({"cell": data["cells"].to_numpy(), "at": np.arange(len(data))}).explode("cell")
            sent = sent.groupby("cell")["at"].apply(lambda own: own.to_numpy(np.int64))
            # cells that were sent the same vectors are solved together
            queries = queries.assign(same=[sent[c].tobytes() if c in sent else b"" for c in queries["cell"]])
            for same, own in queries.groupby("same", sort=False):
                at = np.frombuffer(same, np.int64)
                if len(at):
                    q, q_rows = _matrix(own["vec"], width), own["row"].to_numpy()
                    found.append(best_of_block(q_rows, q, x_rows[at], x_ids[at], x[at], top))
        return pd.concat(found, ignore_index=True).astype("int64")

    return solve


def _groups(counts: dict[int, int], size: int) -> list[list[int]]:
    """Cells whose queries are solved by one task: small ones together, none with more than ``size``
    but those that have more by themselves."""
    groups: list[list[int]] = []
    held = size
    for cell, n in sorted(counts.items(), key=lambda c: (-c[1], c[0])):
        if held + n > size:
            groups.append([])
            held = 0
        groups[-1].append(cell)
        held += n
    return groups


def _blocks(counts: dict[int, int], size: int):
    """An expression: the number of blocks of a group with so many rows."""
    out = F.lit(1)
    for group, n in counts.items():
        out = F.when(F.col("group") == group, F.lit(max(1, -(-n // size)))).otherwise(out)
    return out


def top_k(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 100,
    top: int = TOP,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    data_bytes: int = DATA_BYTES,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products of each query.

    Queries are the rows whose id ``every`` divides, candidates all other rows, those of the same id
    and those without one included: of rows that share an id each is a query, and a
    candidate of the others. A query with fewer candidates has fewer ranks. Ties go to the smaller
    id, NULL last. NULL vectors and those with a NULL or non-finite component take no part; shorter
    vectors are filled up with zeros. Without queries or candidates there are no rows.
    Components and scores end at the limits of 64 bits.
    """
    spark = rows.sparkSession
    vectors = written(whole_vectors(rows, id_col, vector_col, scale), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, largest = vectors.agg(F.max(F.size("vec")), F.max(square)).first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    data_block, query_block = (max(1, size // (8 * max(1, width))) for size in (data_bytes, query_bytes))
    # a bounded sample drawn by a hash of the rows' ids
    drawn = vectors.orderBy(F.xxhash64("id"), "row").limit(DRAWN * pivots).toPandas()
    cells = Cells(spread_out(_matrix(drawn["vec"], width), pivots), largest)
    asking = (F.col("row") % 2 == 0) & (F.col("id") % every == 0)
    queries = written(_assigned(vectors.filter(asking), cells, of_queries=True), "queries")
    asked = queries.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n"))
    asked = asked.toPandas()

    data = _assigned(vectors, cells, of_queries=False)
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("distance"))
    near = data.select("cell", "distance").withColumn("r", rank).filter(F.col("r") <= top + 1)
    cells.bound(dict(zip(asked["cell"], asked["radius"])), near.toPandas(), top + 1)

    numbers = dict(zip(asked["cell"].tolist(), asked["n"].tolist()))
    groups = _groups(numbers, query_block)
    sent = written(_needed(vectors, cells, groups), "sent")
    sizes = {r["group"]: r["n"] for r in sent.groupBy("group").agg(F.count("*").alias("n")).collect()}
    totals = {g: sum(numbers[c] for c in own) for g, own in enumerate(groups)}
    data_blocks, query_blocks = _blocks(sizes, data_block), _blocks(totals, query_block)
    group = F.lit(0)
    for g, own in enumerate(groups):
        group = F.when(F.col("cell").isin(own), F.lit(g)).otherwise(group)

    def dealt(frame: DataFrame, cell: str, own: str, other: str, own_blocks, other_blocks) -> DataFrame:
        return frame.select(
            "row",
            "id",
            "vec",
            cell,
            "group",
            F.pmod(F.xxhash64("row"), own_blocks).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), other_blocks.cast("long") - 1)).alias(other),
        )

    keys = ["group", "data_part", "query_part"]
    grouped = queries.withColumn("group", group)
    left = dealt(grouped, "cell", "query_part", "data_part", query_blocks, data_blocks)
    right = dealt(sent, "cells", "data_part", "query_part", data_blocks, query_blocks)
    solved = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_solver(width, top), "query_row long, vec_id long, vec_row long, score long")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = solved.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ids = queries.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))
    named = F.when(F.col("vec_row") % 2 == 0, F.col("vec_id")).alias("vec_id")
    return ranked.join(ids, "query_row").select("query_id", "rank", named, "score")


def _assigned(vectors: DataFrame, cells: Cells, of_queries: bool) -> DataFrame:
    state = vars(cells)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = Cells.__new__(Cells)
        vars(local).update(state)
        for batch in batches:
            far = local.of_queries(batch["vec"]) if of_queries else local.of_data(batch["vec"])
            cell = far.argmin(1) if len(batch) else np.zeros(0, int)
            batch = batch if of_queries else batch[["row"]]
            yield batch.assign(cell=cell.astype("int32"), distance=far[np.arange(len(batch)), cell])

    own = "id long, vec array<long>, " * of_queries
    return vectors.mapInPandas(assign, f"row long, {own}cell int, distance double")


def _needed(vectors: DataFrame, cells: Cells, groups: list[list[int]]) -> DataFrame:
    """(row, id, vec, group, cells): each vector once for every group with cells that may need it."""
    state = vars(cells)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = Cells.__new__(Cells)
        vars(local).update(state)
        for batch in batches:
            near = local.of_data(batch["vec"]) <= local.reach
            for group, own in enumerate(groups):
                wanted = near[:, own]
                some = wanted.any(axis=1)
                names = np.array(own, np.int32)
                chosen = batch[some].assign(group=np.int32(group))
                chosen["cells"] = pd.Series([names[r] for r in wanted[some]], chosen.index, object)
                yield chosen

    spec = "row long, id long, vec array<long>, group int, cells array<int>"
    return vectors.mapInPandas(choose, spec)

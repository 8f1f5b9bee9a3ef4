"""Near duplicates by SimHash fingerprints and a self-join of their binary trie.

The fingerprints are the leaves of a binary trie. The join starts with the root paired with
itself and goes down: a pair of nodes becomes the pairs of their children, each with the bits
in which the two prefixes differ so far, and is dropped once these exceed the budget. Pairs of
large nodes are taken apart as tables, four levels a round; a pair whose nodes are both small
is traversed in one task. Links come back as a spanning forest of what a task has found, so that
a crowd of copies gives as many rows as it has fingerprints, and stars of alternating rounds
turn the links into components.
"""

from itertools import accumulate, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from xxhash import xxh64_digest

from tickwright.llm.common import address, documents, keep_addressed, text_sha, written

SHINGLE = 3
DISTANCE = 3
SEED = 42

#: Nodes with more fingerprints than this are taken apart before a task gets them. A task holds one and
#: the nodes near it, some 8 bytes a fingerprint, and goes on down their tries by itself.
LEAF = 1 << 16
STEP = 4
#: Pairs of nodes that a task looks at together.
_FRONT = 1 << 18

_CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words.

    ``bytes.lower`` and ``bytes.split`` know ASCII only: A-Z, and blanks 0x20 and 0x09-0x0D.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    ends = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), _CHUNK):
        part = [joined[a : b - 1] for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])]
        hashes = np.frombuffer(b"".join(map(xxh64_digest, part, repeat(SEED))), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(ends))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text)


# the join


def _prefix(value: Column, depth: int) -> Column:
    return F.shiftrightunsigned(value, 64 - depth)


def _children(distance: int) -> Column:
    """All ways to go down STEP levels in both nodes of a pair within what is left of the budget."""
    ways = [
        (c, c ^ x, x.bit_count())
        for c in range(2**STEP)
        for x in range(2**STEP)
        if x.bit_count() <= distance
    ]
    return F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(e).alias("e")) for i, j, e in ways]
    )


def node_pairs(nodes: DataFrame, distance: int, leaf: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs of prefixes a <= b) that together cover every link; both nodes small."""
    spark = nodes.sparkSession
    first = [
        (a, b, (a ^ b).bit_count())
        for a in range(2**STEP)
        for b in range(a, 2**STEP)
        if (a ^ b).bit_count() <= distance
    ]
    pairs = spark.createDataFrame(first, "a long, b long, err int")
    closed, depth = [], STEP
    while True:
        counts = nodes.groupBy(_prefix(F.col("fp"), depth).alias("node")).agg(
            F.count("*").alias("n")
        )
        sized = pairs.join(counts.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        sized = sized.join(counts.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        sized = written(sized, f"node-pairs-{depth}")
        small = (F.col("na") <= leaf) & (F.col("nb") <= leaf)
        closed.append((depth, sized.filter(small).select("a", "b", "err")))
        pairs = sized.filter(~small)
        if depth == 64 or pairs.isEmpty():
            return closed
        way = pairs.select("a", "b", "err", F.explode(_children(distance)).alias("w"))
        way = way.filter(F.col("err") + F.col("w.e") <= distance)
        pairs = way.filter((F.col("a") != F.col("b")) | (F.col("w.i") <= F.col("w.j"))).select(
            (F.col("a") * 2**STEP + F.col("w.i")).alias("a"),
            (F.col("b") * 2**STEP + F.col("w.j")).alias("b"),
            (F.col("err") + F.col("w.e")).alias("err"),
        )
        depth += STEP


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where in their ranges of sorted values the nodes' right children begin."""
    bit = np.uint64(1) << (np.uint64(63) - depth)
    start = (values[low] & ~(bit | (bit - np.uint64(1)))) | bit
    return np.clip(np.searchsorted(values, start), low, high)


def close_pairs(x: np.ndarray, y: np.ndarray, distance: int, small: int = 64):
    """Index pairs of two sorted arrays whose values differ in at most ``distance`` bits.

    Goes down both tries together; with ``x is y`` each pair comes once.
    """
    same = x is y
    fronts = [np.array([[0, len(x), 0, len(y), 0, 0]], np.int64)]  # a range, b range, depth, bits
    while fronts:
        # the deepest first, and not too many, so that few wait however large the nodes are
        pair = fronts.pop()
        if len(pair) > _FRONT:
            fronts.append(pair[_FRONT:])
            pair = pair[:_FRONT]
        al, ah, bl, bh, depth, err = pair.T
        product = (ah - al) * (bh - bl)
        ends = (product <= small) | (depth == 64)
        yield from _compare(x, y, pair[ends], same, distance)
        pair = pair[~ends]
        al, ah, bl, bh, depth, err = pair.T
        am, bm = _split(x, al, ah, depth.astype(np.uint64)), _split(y, bl, bh, depth.astype(np.uint64))
        twins = same & (al == bl) & (ah == bh)
        ways = []
        for (l1, h1, l2, h2), more in (
            ((al, am, bl, bm), 0),
            ((am, ah, bm, bh), 0),
            ((al, am, bm, bh), 1),
            ((am, ah, bl, bm), 1),
        ):
            way = np.stack([l1, h1, l2, h2, depth + 1, err + more], 1)
            fits = (h1 > l1) & (h2 > l2) & (err + more <= distance)
            if more and l1 is am:
                fits &= ~twins
            ways.append(way[fits])
        if sum(map(len, ways)):
            fronts.append(np.concatenate(ways))


def _compare(x, y, pair, same, distance):
    """Compare the values of small nodes one by one, some 2^20 pairs at a time."""
    product = (pair[:, 1] - pair[:, 0]) * (pair[:, 3] - pair[:, 2])
    parts = np.searchsorted(np.cumsum(product), np.arange(1 << 20, product.sum() + (1 << 20), 1 << 20))
    start = 0
    for stop in [*(parts + 1), len(pair)]:
        part, n = pair[start:stop], product[start:stop]
        start = max(start, stop)
        if not len(part):
            continue
        which = np.repeat(np.arange(len(part)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + at // width, part[which, 2] + at % width
        near = np.bitwise_count(x[i] ^ y[j]) <= distance
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]


class Forest:
    """Union-find over the values of one task; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            ri, rj = self._find(i), self._find(j)
            apart = ri != rj
            i, j, ri, rj = i[apart], j[apart], ri[apart], rj[apart]
            low, high = np.minimum(ri, rj), np.maximum(ri, rj)
            # one link per tree and round, so that no two undo each other
            _, first = np.unique(high, return_index=True)
            self.root[high[first]] = low[first]
            self.links += zip(i[first].tolist(), j[first].tolist())

    def _find(self, i: np.ndarray) -> np.ndarray:
        root = self.root[i]
        while True:
            up = self.root[root]
            if (up == root).all():
                self.root[i] = root
                return root
            root = up


def _links_of(distance: int):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        node = group["a"].iat[0]
        values = group["fp"].to_numpy().view(np.uint64)
        side = group["b"].to_numpy()
        order = np.lexsort((values, side))
        values, side = values[order], side[order]
        nodes, starts = np.unique(side, return_index=True)
        parts = dict(zip(nodes.tolist(), np.split(np.arange(len(values)), starts[1:])))
        own = parts[int(node)]
        mine = values[own]
        forest = Forest(len(values))
        for b, at in parts.items():
            other = mine if b == node else values[at]
            for i, j in close_pairs(mine, other, distance):
                forest.add(own[i], at[j])
        found = np.array(forest.links, np.int64).reshape(-1, 2)
        signed = values.view(np.int64)
        return pd.DataFrame({"u": signed[found[:, 0]], "v": signed[found[:, 1]]})

    return links


def links(nodes: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """Pairs (u, v) of fingerprints that connect all within ``distance`` bits of each other.

    ``nodes`` holds distinct fingerprints (fp). Not every link is listed, but whatever links
    connect, the listed ones connect too.
    """
    found = None
    for depth, pairs in node_pairs(nodes, distance, leaf):
        own = pairs.select("a").distinct().select("a", F.col("a").alias("b"))
        members = nodes.select("fp", _prefix(F.col("fp"), depth).alias("b"))
        dealt = members.join(pairs.filter("a != b").select("a", "b").unionAll(own), "b")
        part = dealt.groupBy("a").applyInPandas(_links_of(distance), "u long, v long")
        found = part if found is None else found.unionAll(part)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every u that has an edge (u, v); root is the smallest value reachable.

    Alternating rounds: larger neighbours move to a value's smallest one, then all
    neighbours of a value do, until only stars are left.
    """

    def down(rows: DataFrame) -> DataFrame:
        u, v = F.greatest("u", "v"), F.least("u", "v")
        return rows.filter("u != v").select(u.alias("u"), v.alias("v")).distinct()

    edges, before, step = written(down(edges), "edges"), None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select("u", F.col("v").alias("root"))
        before, step = state, step + 1
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the joins are of two plain shuffles and can split a hot value
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        least = written(least, f"least-{step}")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(down(large), f"large-{step}")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), f"lower-{step}")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(down(small), f"small-{step}")


def near_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id, text_sha256.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the smallest id
    reachable. A NULL or empty text has fingerprint zero, which links like any other. A NULL
    id is never the smallest one; a component of NULL ids alone has component_id NULL. Repeated
    rows come back as often as they are there, an empty table gives no rows, and other columns
    are left behind.
    """
    texts = documents(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    prints = written(
        texts.select("id", text_sha("text").alias("sha"), fingerprint("text", shingle).alias("fp")),
        "fingerprints",
    )
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    rooted = components(links(nodes.select("fp"), distance, leaf))
    rooted = nodes.join(rooted.select(F.col("u").alias("fp"), "root"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the join with the documents is one of two plain shuffles
    labels = written(rooted.join(lowest, "root").select("fp", "root", "component_id"), "components")
    return prints.join(labels, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("sha").alias("text_sha256"),
        F.lpad(F.lower(F.hex("root")), 16, "0").alias("root"),
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component with all its columns: the one with the smallest id.

    Of several rows with that id the one with the smallest digest stays, of repeats one.
    """
    at = address("doc_id", "text_sha256")
    ranked = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), at.alias("address"))
    marks = near_dedup(docs).groupBy("root").agg(F.min(ranked).alias("best"))
    return keep_addressed(docs, marks.select("best.address"))

"""Hierarchical best-fit packing of documents into sequences of a fixed number of tokens.

Texts are tokenized and cut where they are read, and a task best-fits its own pieces, a bounded
node of them at a time. Bins that are nearly full are sequences; the underfull ones travel.
In each round they are dealt by hash to nodes of bounded size, fewer from round to round as
sequences leave. A node first packs whole bins as items; what is still underfull is taken
apart and packed again piece by piece. The rounds end with a node that sees all that is
left, or once they hardly free bins any more. No number of bins or pieces is capped: more of
them make more nodes, and every piece is placed.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written
from tickwright.llm.tokens import byte_bpe, vocabulary

CAPACITY = 1024
END = 2
#: The vocabulary's added token, which a text may hold.
ADDED = {"<|endoftext|>": 50256}

#: A node holds about so many pieces, and so many tokens, at most.
NODE_PIECES = 100_000
NODE_TOKENS = 1 << 24
#: A bin filled to this share is a sequence.
FULL = 0.995
#: The rounds end when one frees less than this share of the bins it was given.
GAIN = 0.001

#: A bin's number: its round, then the task or node that made it, then its place there.
_ROUND_BITS, _NODE_BITS = 56, 32


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first."""
    first = length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill; longest first, ties in order.

    Free places are whole numbers, so the tightest open bin is the lowest set bit of a mask.
    """
    place, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fills = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, len(fills)
            fills.append(0)
        place[i], offset[i] = b, capacity - free
        free -= size
        fills[b] = capacity - free
        if free:
            open_bins[free].append(b)
            mask |= 1 << free
    return place, offset, np.array(fills, np.int64)


def merge(
    bins: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, capacity: int, enough: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New bin, offset and fill of the pieces of underfull ``bins``, by one node's round.

    Whole bins are packed as items first. Those of the result that hold less than ``enough`` are
    taken apart; their pieces are packed anew unless that takes more bins.
    """
    own, child = np.unique(bins, return_inverse=True)
    filled = np.bincount(child, weights=lengths, minlength=len(own)).astype(np.int64)
    place, at, fills = best_fit(filled, capacity)
    new_bin, new_offset = place[child], at[child] + offsets
    short = fills < enough
    loose = np.flatnonzero(short[new_bin])
    if len(loose):
        again, offset, refilled = best_fit(lengths[loose], capacity)
        if len(refilled) <= short.sum():
            new_bin[loose], new_offset[loose] = again + len(fills), offset
            fills = np.concatenate([fills, refilled])
    return new_bin, new_offset, fills[new_bin]


def _columns(keep_ids: bool) -> list[tuple[str, str, pa.DataType]]:
    """What is known of a piece besides its document; the last three change from round to round."""
    return [
        ("piece", "int", pa.int32()),
        ("start", "long", pa.int64()),
        ("length", "long", pa.int64()),
        ("ids_crc32", "long", pa.int64()),
        *[("ids", "array<int>", pa.list_(pa.int32()))] * keep_ids,
        ("bin", "long", pa.int64()),
        ("offset", "long", pa.int64()),
        ("fill", "long", pa.int64()),
    ]


def _first_round(path: str, capacity: int, keep_ids: bool, node_pieces: int, node_tokens: int):
    """Pieces of a task's documents, best-fit among those of the same node."""

    def pack_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(path, ADDED)
        part, bins = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        docs: list[pa.Array] = []
        tokens: list[np.ndarray] = []
        held = before = 0

        def node() -> Iterator[pa.RecordBatch]:
            nonlocal bins
            doc, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows))
            place, offset, fills = best_fit(length, capacity)
            number = (part << _NODE_BITS) + bins + place
            bins += len(fills)
            values = [piece, start, length, crc, *[None] * keep_ids, number, offset, fills[place]]
            arrays = [pa.array(v, kind) for v, (_, _, kind) in zip(values, _columns(keep_ids)) if v is not None]
            if keep_ids:
                ends = np.concatenate([[0], length.cumsum()]).astype(np.int32)
                arrays.insert(4, pa.ListArray.from_arrays(ends, np.concatenate(tokens)))
            names = ["doc", *[name for name, _, _ in _columns(keep_ids)]]
            whole = pa.table([pa.chunked_array(docs).take(pa.array(doc)), *arrays], names=names)
            yield from whole.combine_chunks().to_batches(max_chunksize=10_000)

        for batch in batches:
            docs.append(batch.column("doc"))
            for i, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    rows.append((before + i, number, start, length, zlib.crc32(own.tobytes())))
                    held += length
                    if keep_ids:
                        tokens.append(own.astype(np.int32))
                    if len(rows) >= node_pieces or held >= node_tokens:
                        yield from node()
                        rows, tokens, held = [], [], 0
            before += batch.num_rows
            if not rows:
                docs, before = [], 0
        if rows:
            yield from node()

    return pack_own


def _next_round(number: int, capacity: int, enough: int):
    """A node's underfull bins, packed again."""

    def pack_again(key: tuple[pa.Scalar, ...], node: pa.Table) -> pa.Table:
        node = node.drop_columns(["node"]).sort_by([("bin", "ascending"), ("offset", "ascending")])
        bins, offsets, lengths = (node.column(c).to_numpy() for c in ("bin", "offset", "length"))
        place, offset, fill = merge(bins, offsets, lengths, capacity, enough)
        first = (number << _ROUND_BITS) + (key[0].as_py() << _NODE_BITS)
        for name, values in (("bin", first + place), ("offset", offset), ("fill", fill)):
            node = node.set_column(node.column_names.index(name), name, pa.array(values, pa.int64()))
        return node

    return pack_again


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary_path: str | None = None,
    keep_ids: bool = False,
    full: float = FULL,
    gain: float = GAIN,
    node_pieces: int = NODE_PIECES,
    node_tokens: int = NODE_TOKENS,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its ids and the id 2; a NULL or empty text is that one id. ``<|endoftext|>`` in
    a text is the vocabulary's added token, as `tokenizers` reads it. Only longer documents
    are cut. Sequences are filled from 0 without gaps and hold at most ``capacity`` ids. Bins
    filled to the share ``full`` are sequences at once, the others are packed again in rounds over
    nodes of about ``node_pieces`` pieces and ``node_tokens`` tokens, until one node sees all that
    are left or a round frees less than the share ``gain`` of its bins. Repeated rows are packed
    as often as they are there, ids of any type stay as they are, an empty table gives no rows,
    and other columns are left behind.
    """
    texts = documents(docs, id_col, text_col).select(
        F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    kind = texts.schema["doc"].dataType.simpleString()
    schema = ", ".join([f"doc {kind}", *[f"{name} {spark}" for name, spark, _ in _columns(keep_ids)]])
    enough = min(capacity, int(np.ceil(full * capacity)))
    own = _first_round(vocabulary_path or vocabulary(), capacity, keep_ids, node_pieces, node_tokens)
    packed = written(texts.mapInArrow(own, schema), "pieces")

    closed = F.col("fill") >= enough
    done = [packed.filter(closed)]
    left, number = packed.filter(~closed), 0
    # every bin has one piece at its beginning
    sizes = [F.count("*").alias("pieces"), F.sum("length").alias("tokens"), F.count_if(F.col("offset") == 0).alias("bins")]
    while True:
        given = left.agg(*sizes).first()
        nodes = max(-(-given["pieces"] // node_pieces), -(-(given["tokens"] or 0) // node_tokens))
        if not nodes:
            break
        number += 1
        node = F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(nodes)).alias("node")
        dealt = left.select("*", node).groupBy("node")
        packed = written(dealt.applyInArrow(_next_round(number, capacity, enough), schema), f"round{number}")
        bins = packed.agg(sizes[2]).first()["bins"]
        if nodes == 1 or given["bins"] - bins < gain * given["bins"]:
            left = packed
            break
        done.append(packed.filter(closed))
        left = packed.filter(~closed)

    out = left
    for frame in done:
        out = out.unionByName(frame)
    shown = ["piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset", *["ids"] * keep_ids]
    return out.select(F.col("doc").alias(id_col), *shown)

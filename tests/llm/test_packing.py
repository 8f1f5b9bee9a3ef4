import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import MIDDLE, SMALL, read, rows
from tickwright.llm import packing
from tickwright.llm.tokens import byte_bpe, vocabulary


@pytest.fixture(scope="module")
def tokenize():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def check(found, documents, tokenize, capacity=1024):
    """Every piece where it belongs; the number of sequences and the least possible."""
    expected = {i: [*tokenize(t), 2] for i, t in documents}
    found = found.sort_values(["sequence_id", "offset"])
    by_sequence = found.groupby("sequence_id")["length"]
    assert (by_sequence.sum() <= capacity).all()
    assert (by_sequence.cumsum() - found["length"] == found["offset"]).all()
    for doc_id, pieces in found.sort_values("piece").groupby("doc_id"):
        ids, at = expected.pop(doc_id), 0
        for number, piece in enumerate(pieces.itertuples()):
            assert (piece.piece, piece.start) == (number, at)
            assert number == 0 or piece.length == capacity
            own = np.array(ids[at : at + piece.length], "<u4")
            assert zlib.crc32(own.tobytes()) == piece.ids_crc32
            at += piece.length
        assert at == len(ids) and (len(pieces) == 1 or at > capacity)
    assert not expected
    return found["sequence_id"].nunique(), -(-int(found["length"].sum()) // capacity)


def test_encoder_gives_the_vocabularys_ids(tokenize):
    encode = byte_bpe(vocabulary())
    odd = ["", " ", "a  b\n\n c", "<|endoftext|>", "é中文😀", "x" * 5000, "\t\r\x0b", "don't DON'T 12345"]
    for text in odd:
        assert encode(text) == tokenize(text)


@pytest.mark.parametrize("run", [" " * 3_000_000, "\n" * 3_000_000, "a" + " " * 1_000_000 + "b", "x\n" + " \t" * 600_000])
def test_encoder_survives_runs_of_blanks(tokenize, run):
    assert ENCODE(f"{run}<|endoftext|>") == [*tokenize(run), 50256]


@pytest.fixture(scope="module")
def default():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


ENCODE = byte_bpe(vocabulary(), packing.ADDED)
ADDED_TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n y", "<|endoftext|", "a <| endoftext|>"]


def test_encoder_gives_the_added_token(default):
    assert ENCODE("a <|endoftext|> b") == [64, 220, 50256, 275]
    for text in ADDED_TEXTS:
        assert ENCODE(text) == default(text)


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", " ", "  ", "\n", "é中😀", "'s", "endoftext", "ab1"])))
@settings(max_examples=200, deadline=None)
def test_encoder_equals_the_tokenizer_by_default(default, parts):
    text = "".join(parts)
    assert ENCODE(text) == default(text)


def test_documents_with_the_added_token(spark, default):
    cases = [*enumerate(ADDED_TEXTS), (90, "ab <|endoftext|>" * 1000)]
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    check(packing.pack(docs).toPandas(), cases, default)


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=100, deadline=None)
def test_best_fit(sizes):
    place, offset, fills = packing.best_fit(np.array(sizes, np.int64), 64)
    for b, fill in enumerate(fills):
        own = sorted((offset[i], sizes[i]) for i in np.flatnonzero(place == b))
        ends = [o + s for o, s in own]
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] == fill <= 64
    assert sum(fills) == sum(sizes)
    assert len(fills) <= max(1, 2 * sum(sizes) / 64) or not sizes


def one_pass(sizes, capacity):
    """How many bins one best-fit over all sizes needs: the reference of the tree."""
    return len(packing.best_fit(np.array(sizes, np.int64), capacity)[2])


@given(st.lists(st.lists(st.integers(1, 40), min_size=1, max_size=6), max_size=60))
@settings(max_examples=150, deadline=None)
def test_a_nodes_round(found):
    """Every piece is in one bin, bins have no gaps, and there are no more of them than before."""
    given_bins = [own for own in found if sum(own) <= 64]
    bins = np.array([b for b, own in enumerate(given_bins) for _ in own], np.int64)
    lengths = np.array([n for own in given_bins for n in own], np.int64)
    offsets = np.array([sum(own[:i]) for own in given_bins for i in range(len(own))], np.int64)
    place, offset, fill = packing.merge(bins, offsets, lengths, 64, 62)
    assert len(set(place.tolist())) <= len(given_bins)
    for b in set(place.tolist()):
        own = sorted((offset[i], lengths[i]) for i in np.flatnonzero(place == b))
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 64
        assert (fill[place == b] == ends[-1]).all()


def planted(spark, n):
    """One task's bins are three fifths full; the other task has what fits them."""
    long, short = "a " * 299 + "a", "a " * 199 + "a"
    return spark.range(2 * n, numPartitions=2).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < n, long).otherwise(short).alias("text")
    )


def test_many_underfull_bins_are_filled_from_other_tasks(spark):
    """60,000 bins of 301 of 512 tokens here, 60,000 pieces of 201 there: 60,000 sequences."""
    n = 60_000
    found = packing.pack(planted(spark, n), capacity=512).select("sequence_id", "length")
    lengths = {r.length: r["count"] for r in found.groupBy("length").count().collect()}
    assert sorted(lengths.values()) == [n, n] and sum(lengths) <= 512 and min(lengths) * 2 <= 512
    assert found.select("sequence_id").distinct().count() <= 1.002 * n


@pytest.mark.parametrize("node_pieces", [400, 2_000])
def test_small_nodes_place_every_piece_as_well(spark, node_pieces):
    """However small the nodes, the rounds find nearly what one pass does."""
    n = 6_000
    found = packing.pack(planted(spark, n), capacity=512, node_pieces=node_pieces)
    assert found.count() == 2 * n
    used = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("at"))
    assert used.filter("n > 512 OR at > 0").isEmpty()
    assert used.count() <= 1.03 * n


@pytest.mark.parametrize("node_pieces", [packing.NODE_PIECES, 20])
def test_documents(spark, tokenize, node_pieces):
    docs = read(spark, SMALL, "documents")
    found = packing.pack(docs.repartition(9), node_pieces=node_pieces).toPandas()
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    used, least = check(found, texts, tokenize)
    assert used <= 1.12 * least


def test_tree_is_nearly_as_good_as_one_pass(spark):
    docs = read(spark, MIDDLE, "documents")
    many = packing.pack(docs.repartition(24))
    sizes = [r.length for r in many.select("length").collect()]
    assert many.select("sequence_id").distinct().count() <= one_pass(sizes, packing.CAPACITY) + 2


def test_nulls_long_texts_repeats_and_ids(spark, tokenize):
    cases = [(1, "a" * 500), (3, None), (4, ""), (5, "x y " * 700), (6, "q" * 200_000), (7, " " * 1_200_000)]
    docs = spark.createDataFrame(cases, "doc_id long, text string").withColumns(
        {"bin": F.lit(1), "open": F.lit(2), "piece": F.lit(3), "ids": F.lit(4)}
    )
    found = packing.pack(docs, keep_ids=True).toPandas()
    used, least = check(found, cases, tokenize)
    assert used <= least + 1
    kept = {(p.doc_id, p.piece): list(p.ids) for p in found.itertuples()}
    assert kept[5, 0] == [*tokenize(cases[3][1]), 2][: len(kept[5, 0])]
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "doc_id long, text string")
    out = packing.pack(twice).toPandas()
    assert sorted(out["offset"]) == [0, 2, 4] and out["doc_id"].isna().sum() == 2 and out["sequence_id"].nunique() == 1
    large = spark.createDataFrame([(2**62 + 1, "a"), (None, "a")], "doc_id long, text string")
    assert rows(packing.pack(large), "doc_id") == [(None,), (2**62 + 1,)]
    assert packing.pack(docs.limit(0)).count() == 0

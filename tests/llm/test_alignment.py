"""Alignment against whole-text encodings, all pairs of overlapping ranges and plain counting."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SMALL, read, rows
from tickwright.llm import alignment
from tickwright.llm.tokens import piece_model, vocabulary

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SHOWN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_alphabet():
    """The printable characters a byte-level vocabulary spells bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


BYTES = byte_alphabet()


def spelt(text):
    """(ids, spellings) by both tokenizers, each over the whole text at once."""
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    pieces = [B.id_to_piece(i) for i in b]
    return (
        (a, [bytes(BYTES[c] for c in A.id_to_token(i)) for i in a]),
        (b, [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]),
    )


def ranges(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(text):
    """(n_a, n_b, digest, groups, links as id pairs), by comparing ranges with ranges."""
    if not text:
        return None
    (a, a_parts), (b, b_parts) = spelt(text)
    whole = (" " + text).encode()
    if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
        return None
    in_a, in_b = ranges(a_parts), ranges(b_parts)
    both = sorted({e for _, e in in_a} & {e for _, e in in_b})
    groups = []
    for start, end in zip([0, *both], both):
        own = [[i for i, (s, e) in zip(ids, at) if s >= start and e <= end] for ids, at in ((a, in_a), (b, in_b))]
        groups.append("|".join(",".join(map(str, ids)) for ids in own))
    linked = [(x, y) for x, (s, e) in zip(a, in_a) for y, (t, u) in zip(b, in_b) if s < u and t < e]
    return len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups), linked


def expected(cases):
    found = [(i, brute(t)) for i, t in cases]
    counts = Counter(p for _, r in found if r for p in r[4])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for i, r in found:
        if r is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, digest, groups, linked = r
        best = sum(counts[p] == most[p[1]] for p in linked)
        out.append((i, n_a, n_b, groups, len(linked), best, sum(counts[p] for p in linked), digest))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


ODD = [
    "", None, " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a\n\nb \n", "\ta\t\t  b", "a\x0b  b", "é中文😀 नमस्ते",
    "x▁y", "<s>a</s> <|endoftext|>", "don't 12345 !!! ??", "a\r\n b", "a\x1c  b\x1c", "  a   b", "ﬁ２ é é",
    "​ a", "﻿a b", "a\x00b", "zz" * 300, "\n" * 40 + "end", "  \n  \n x  ", "ab   cd", "　 　a",
]


@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.sets(st.integers(1, 100)), st.sets(st.integers(1, 100)))
@settings(max_examples=300, deadline=None)
def test_align_equals_all_pairs(gaps, only_a, only_b):
    """Blocks and links of any two rising arrays with one last value."""
    last = sum(gaps) + 100
    shared = {sum(gaps[: i + 1]) for i in range(len(gaps))}
    a, b = sorted(shared | only_a | {last}), sorted(shared | only_b | {last})
    stretches, groups = alignment.align(a, b)
    starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
    pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
    runs = [(i + n, j + n) for i, k, j, _ in stretches for n in range(k - i)]
    run_a, run_b = np.array(runs, np.int64).reshape(-1, 2).T
    left, right = (x.tolist() for x in alignment.linked_within(np.array(a), np.array(b), run_a, run_b))
    assert sorted([*runs, *zip(left, right)]) == pairs
    assert all(a[i] == b[j] for i, j in runs)
    assert len(stretches) - len(groups) in (0, 1)
    ends = [a[i] for i, _ in runs]
    for i, k, j, m in groups:
        assert i < k and j < m and a[k - 1] == b[m - 1] and a[i] != b[j]
        ends.append(a[k - 1])
    assert sorted(ends) == sorted(set(a) & set(b))


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(vocabulary(), piece_model())


@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "ab", "the", "é", "中", "😀", "1", "!", "'s", " ", "\x1c", "▁", "<s>", "\x0b"]), max_size=14))
@settings(max_examples=400, deadline=None)
def test_words_give_the_tokens_of_the_whole_text(encoders, parts):
    text = "".join(parts)
    plain = brute(text)
    got = encoders.aligned(text) if text else None
    assert (got is None) == (plain is None)
    if got:
        assert got[:2] + got[3:4] + got[2:3] == plain[:4]
        found = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(*got[4:])}
        assert found == Counter(plain[4])


def test_stretches_join(encoders, monkeypatch):
    text = "the house of Étienne, <|endoftext|>\n\n 12 " * 40
    whole = encoders.aligned(text)
    monkeypatch.setattr(alignment, "STRETCH", 7)
    # words are forgotten now and then
    monkeypatch.setattr(alignment, "WORDS", 3)
    parts = encoders.aligned(text)
    assert whole[:4] == parts[:4] and all((x == y).all() for x, y in zip(whole[4:], parts[4:]))


@pytest.mark.parametrize("few", [alignment.FEW_PAIRS, 10])
def test_documents_equal_brute_force(spark, few):
    docs = read(spark, SMALL, "documents")
    cases = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 3000]
    frame = spark.createDataFrame(cases, "doc_id long, text string").repartition(5)
    assert rows(alignment.align_corpus(frame, few_pairs=few), *SHOWN) == expected(cases)


def test_odd_texts_repeats_and_other_columns(spark):
    cases = [*enumerate(ODD), (None, "a b"), (None, "a b"), (3, "a b"), (2**60, "a b")]
    frame = spark.createDataFrame(cases, "doc_id long, text string")
    frame = frame.withColumns({c: F.lit(1) for c in ("row", "id", "pairs", "times", "n", "best", "b")})
    assert rows(alignment.align_corpus(frame), *SHOWN) == expected(cases)
    assert alignment.align_corpus(frame.limit(0)).count() == 0
    assert rows(alignment.align_corpus(spark.createDataFrame([(1, None)], "doc_id long, text string"))) == [
        (1, 0, 0, 0, 0, 0, 0, "")
    ]


def test_very_long_texts(spark):
    """Runs of a million blanks, a text without any, and many words at once."""
    texts = ["a" + " " * 1_200_000 + "b", "xyz" * 150_000, "the cat " * 200_000]
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align_corpus(frame).collect()}
    for i, text in enumerate(texts):
        (a, a_parts), (b, b_parts) = spelt(text)
        both = {e for _, e in ranges(a_parts)} & {e for _, e in ranges(b_parts)}
        assert (found[i].n_a, found[i].n_b, found[i].n_groups) == (len(a), len(b), len(both))
        assert found[i].n_links == len(a) + len(b) - len(both)

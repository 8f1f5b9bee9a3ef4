"""Windows read back, against the turns themselves and a plain reading of the window rules."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import MIDDLE, read, rows
from tickwright.llm import chat, queries
from tickwright.llm.tokens import byte_bpe, vocabulary

SHOWN = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
SPEC = "conv_id long, turn long, role string, text string"
ENCODE = byte_bpe(vocabulary())
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/TURN]", "<more>", "<", "[", "\\", "/s>", "s>", "INST]", "\n", "é", "😀", " ", ""]
texts_of_bits = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(cases):
    """Digests of each conversation's turns and assistant texts, from the rows."""
    by_conv = {}
    for conv, turn, role, text in cases:
        by_conv.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        shown = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        out.append((conv, len(turns), sha(shown), len(learned), sha(learned)))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


@given(texts_of_bits, st.sampled_from(["user", "assistant", "system", "tool", "", "a\nb\\n", "<s>\\", "[TURN]x\n"]), st.booleans())
@settings(max_examples=500, deadline=None)
def test_marks_read_back(text, role, more):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._MARK.search(chat.escape(text))
    shown, start, end = chat.marked(role, text, more)
    assert chat.unescape(shown[start:end]) == text
    assert list(chat.turns_of(shown + shown)) == [(role, text, not more)] * 2


@given(texts_of_bits.map(lambda t: t * 40), st.sampled_from(["user", "tool"]), st.integers(60, 200))
@settings(max_examples=60, deadline=None)
def test_long_turns_in_parts(text, role, most):
    cost = lambda t: len(ENCODE(t))
    found = chat.pieces(role, text, cost, most)
    assert "".join(p.text for p in found) == text
    assert [p.begins for p in found] == [True] + [False] * (len(found) - 1)
    assert [p.ends for p in found] == [False] * (len(found) - 1) + [True]
    for p in found:
        assert p.cost == cost(chat.marked(role, p.text, not p.ends)[0]) <= most


@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(0, 20), st.integers(0, 25))
@settings(max_examples=200, deadline=None)
def test_windows_are_those_of_the_rule(costs, system, history):
    """Turn by turn: as much history as fits, then new turns up to the budget."""
    import numpy as np

    budget = 80
    keep = 1 if system else 0
    if system:
        costs = [system, *costs]
    found = chat.spans(np.array(costs), np.ones(len(costs), bool), 0, system, keep, budget, history)
    first, plain = 0, []
    while first < len(costs):
        room = budget - (system if first >= keep else 0)
        context = first
        while context > keep and sum(costs[context - 1 : first]) <= min(history, room - costs[first]):
            context -= 1
        end = first + 1
        while end < len(costs) and sum(costs[context : end + 1]) <= room:
            end += 1
        plain.append((context, first, end))
        first = end
    assert found == plain


def talk(n, seed, conv, system=True):
    rng = random.Random(seed)
    turns = [(conv, 0, "system", "be brief " * 5)] if system else []
    for i in range(1, n):
        role = ["user", "assistant"][i % 2] if rng.random() < 0.9 else rng.choice(["tool", "a\nb", None])
        turns.append((conv, i, role, "".join(rng.choices(BITS + ["word ", "the "], k=rng.choice([0, 3, 30, 90])))))
    return turns


CASES = [*talk(60, 1, 1), *talk(9, 2, 2, False), *talk(400, 3, 3), *talk(300, 4, None, False), (5, 0, "assistant", "x" * 9000)]


@pytest.mark.parametrize("few", [chat.FEW_LONG, 0])
def test_long_conversations_get_the_same_windows(spark, few, monkeypatch):
    """Cut into stretches by prefix sums over tasks, or laid out by one task."""
    monkeypatch.setattr(chat, "STRETCH", 4)
    frame = spark.createDataFrame(CASES, SPEC).repartition(5)
    whole = chat.format_conversations(frame, budget=256)
    cut = chat.format_conversations(frame, budget=256, long_bytes=2_000, few_long=few)
    assert whole.cut is None and cut.cut.count()
    columns = ["conv", "stretch", "number", "text", "context", "tokens", F.to_json(F.struct("loss")).alias("loss")]
    assert rows(whole.windows(), *columns) == rows(cut.windows(), *columns)
    assert rows(chat.read_back(whole), *SHOWN) == rows(chat.read_back(cut), *SHOWN) == expected(CASES)


def test_windows_keep_budget_system_turn_and_masks(spark):
    frame = spark.createDataFrame(CASES, SPEC)
    found = chat.format_conversations(frame, budget=256).windows().orderBy("conv", "stretch", "number").collect()
    for w in found:
        turns = list(chat.turns_of(w.text))
        assert w.tokens <= 256
        parts = []
        for role, text, ends in turns:
            parts.append(chat.marked(role, text, not ends)[0])
        assert "".join(parts) == w.text and sum(len(ENCODE(p)) for p in parts) == w.tokens
        if w.conv in (1, 3):
            assert turns[0][:2] == ("system", "be brief " * 5)
        new = [text for i, (role, text, _) in enumerate(turns) if i >= w.context and role == "assistant"]
        assert [chat.unescape(w.text[s.start : s.end]) for s in w.loss] == new
    assert any(w.context > 1 for w in found)


def test_given_tables_and_the_probe(spark):
    given_rows = [tuple(r) for r in read(spark, MIDDLE, "conversations").select("conv_id", "turn", "role", "text").collect()]
    probe = [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(["user", "assistant"])]
    found = queries.op11_chat_formatting(spark, MIDDLE)
    assert rows(found, *SHOWN) == expected(given_rows + probe)
    least = {}
    for conv, _, _, text in given_rows + probe:
        least[conv] = least.get(conv, 0) + len(text or "")
    assert all(n >= least[conv] for conv, n in rows(found, "conv_id", "formatted_chars"))


def test_odd_rows_and_empty_tables(spark):
    odd = [
        (1, None, None, None), (1, None, None, None), (1, 2, "user", ""), (None, 0, "assistant", "a"), (None, 0, "assistant", "a"),
        (2, 5, "system", "s" * 4000), (2, 5, "system", "t"), (2, 7, "assistant", "</s>\\<\\s>" * 2000), (3, 0, "r" * 5000, "x y " * 900),
        (4, 0, "assistant", " " * 1_200_000),
    ]
    frame = spark.createDataFrame(odd, SPEC).withColumns({c: F.lit(1) for c in ("conv", "stretch", "hash", "tie", "c", "at")})
    for options in ({}, {"long_bytes": 100}):
        made = chat.format_conversations(frame, budget=256, **options)
        # equal turns of conversation 2 are ordered by a hash of their text
        found = {r.conv_id: r for r in chat.read_back(made).collect()}
        for conv, n, digest, chars, learned in expected([c for c in odd if c[0] != 2]):
            assert tuple(found[conv])[1:5] == (n, digest, chars, learned)
        assert (found[2].n_turns, found[2].loss_chars) == (3, 18_000)
        assert made.windows().filter("tokens > 256").select("conv").distinct().collect() == [(3,)]
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.format_conversations(frame, budget=10)

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LARGE, read, rows
from tickwright.llm import toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (x != y)))
        row = after
    return row[-1]


@pytest.mark.parametrize("memo", [200_000, 50])
def test_automaton_finds_the_closest_term(monkeypatch, memo):
    monkeypatch.setattr(toxicity, "_MEMO", memo)
    terms = ["idiot", "scum", "pathetic", "disgusting", "ass", "moron", "morons", "élan"]
    automaton, draw = toxicity.Automaton(terms), random.Random(1)
    for _ in range(4000):
        word = list(draw.choice(terms))
        for _ in range(draw.randint(0, 3)):
            at, kind = draw.randrange(len(word) + 1), draw.randint(0, 2)
            if kind == 0:
                word.insert(at, draw.choice("abcdmoé"))
            elif at < len(word):
                word[at : at + 1] = [] if kind == 1 else [draw.choice("abmot")]
        word = "".join(word)
        near = [(edits(word, t), t) for t in terms if edits(word, t) <= toxicity.edits_allowed(t)]
        assert automaton.match(word) == ((min(near)[1], min(near)[0]) if near else None)


@pytest.mark.parametrize(
    "text, quoted",
    [
        ('they shouted "you idiot" again', True),
        ("the word idiot is an old one", True),
        ("you idiot go home", False),
        ('he " left and the idiot came', False),
        ("«idiot»", True),
        ("idiot", False),
    ],
)
def test_quotation(text, quoted):
    words = text.split()
    at = next(i for i, w in enumerate(words) if "idiot" in w)
    assert toxicity.quotation(words, at) is quoted


def test_quoted_and_misspelt_terms_count_less():
    scorer = toxicity.Scorer({"idiot": 1.0}, {"idiom": 0.0})
    plain, misspelt, quoted, known, none = (
        scorer.numbers(t)[0] for t in ("you idiot", "you idi0t", "the word idiot", "an idiom", "")
    )
    assert plain > misspelt > quoted > known == none == 0


def test_rare_words_of_copied_documents_are_no_terms():
    held = [["bad", "worse", "worst", "rare"]] * 8 + [["bad", "worse", "worst"]] * 20 + [["bad"]] * 9
    terms = toxicity.choose_terms(held, [1] * len(held))
    assert set(terms) == {"bad", "worse", "worst"}


def test_held_out_accuracy(spark):
    docs, labels = read(spark, LARGE, "documents"), read(spark, LARGE, "labels")
    found = toxicity.judge(docs, labels)
    assert found.filter("score < 0 or score > 1 or score is null").isEmpty()
    marked = found.join(labels, "doc_id").filter("held_out")
    hit, said, real = marked.agg(
        F.sum(F.col("predicted") * F.col("toxic")), F.sum("predicted"), F.sum("toxic")
    ).first()
    assert hit / said > 0.85 and hit / real > 0.9 and real > 50


def test_nulls_repeats_and_few_labels(spark):
    cases = [(1, "a" * 500), (None, ""), (3, None), (3, None), (2, "idiot")]
    docs = spark.createDataFrame(cases, "doc_id long, text string").withColumns(
        {"toxic": F.lit("x"), "score": F.lit("y"), "held_out": F.lit(1)}
    )
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.judge(docs, labels)
    assert [r[0] for r in rows(found, "doc_id")] == [None, 1, 2, 3, 3]
    assert found.filter("score is null").isEmpty()
    assert toxicity.judge(docs.limit(0), labels).count() == 0
    assert toxicity.judge(docs, labels.limit(0)).filter("predicted = 1").isEmpty()


def test_fit_separates():
    x = np.array([[0.0, 0, 0]] * 50 + [[2.0, 1, 0.1]] * 50)
    w = toxicity._fit(x, np.array([0.0] * 50 + [1.0] * 50))
    scorer = toxicity.Scorer({}, {}, w)
    assert scorer.probability(x[:1])[0] < 0.05 < 0.95 < scorer.probability(x[-1:])[0]

"""Toxicity by a learned lexicon, matched with spelling errors and judged in context.

Terms that set toxic documents apart are kept in a trie. Words run through the product of the
trie and Levenshtein automata, made deterministic as words need it, so that misspelled terms
are found in one pass over a word. Spelling variants that harmless documents use count less.
A window around each hit tells quotation (quotation marks, verbs of saying) from abuse. Few
numbers a document are left, which a logistic regression turns into a probability.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tickwright.llm.common import documents, remainder, written

THRESHOLD = 0.3
#: The model is fitted on at most so many labelled documents, drawn by a hash of their ids.
SAMPLE = 20_000
#: Terms at most, toxic documents that must use one, and the least share of toxic documents
#: among all that do. Documents that have so many terms already don't count for another one:
#: else the rare words of a few copied documents would pass for terms.
TERMS, LEAST_DOCUMENTS, PRECISION, ENOUGH = 1_000, 5, 0.6, 3

WINDOW = 6
QUOTED = 0.3  # what a quoted hit counts
UNSEEN = 0.6  # what a variant counts that no labelled document uses

# fixed values: marks and verbs of quotation
MARKS = "\"'`«»„“”‚‘’"
SAYING = frozenset(
    "said says say wrote writes called quote quoted quoting according word term replied".split()
)

_MEMO = 200_000


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Automaton:
    """Levenshtein automata of all terms on their trie, determinised lazily.

    A state maps trie nodes to the fewest edits that reach them.
    """

    def __init__(self, terms: list[str]):
        self.terms = sorted(terms)
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.limit: list[int] = [0]
        for number, term in enumerate(self.terms):
            node, limit = 0, edits_allowed(term)
            self.limit[0] = max(self.limit[0], limit)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.term)
                    self.children.append({})
                    self.term.append(-1)
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], limit)
            self.term[node] = number
        self._forget()

    def _forget(self) -> None:
        self.states: list[dict[int, int]] = []
        self.number: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], int] = {}
        self.known: dict[str, tuple[str, int] | None] = {}
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of a state, after skipping letters of terms; -1 if nothing is reached."""
        queue = list(reached)
        while queue:
            node = queue.pop()
            edits = reached[node] + 1
            for child in self.children[node].values():
                if edits <= self.limit[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    queue.append(child)
        if not reached:
            return -1
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(reached)
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, edits in self.states[state].items():
            if edits < self.limit[node]:  # one letter too many
                reached[node] = min(edits + 1, reached.get(node, 99))
            for c, child in self.children[node].items():
                cost = edits + (c != letter)
                if cost <= self.limit[child] and cost < reached.get(child, 99):
                    reached[child] = cost
        return self._state(reached)

    def match(self, word: str) -> tuple[str, int] | None:
        """The term closest to a word within its allowed edits, and the edits."""
        if word in self.known:
            return self.known[word]
        if len(self.known) + len(self.steps) > _MEMO:
            self._forget()
        state, found = self.start, None
        for letter in word:
            after = self.steps.get((state, letter))
            if after is None:
                after = self.steps[state, letter] = self._step(state, letter)
            state = after
            if state < 0:
                break
        if state >= 0:
            hits = [
                (edits, self.terms[self.term[node]])
                for node, edits in self.states[state].items()
                if self.term[node] >= 0 and edits <= edits_allowed(self.terms[self.term[node]])
            ]
            if hits:
                edits, term = min(hits)
                found = term, edits
        self.known[word] = found
        return found


def _bare(word: str) -> str:
    """A word without what is no letter or digit at its ends."""
    if word.isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def quotation(words: list[str], at: int) -> bool:
    """Whether the word is quoted: between marks, or shortly after a verb of saying."""
    before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
    opened = sum(w[0] in MARKS for w in before) > sum(w[-1] in MARKS for w in before[:-1])
    closed = any(w.rstrip(".,;:!?")[-1:] in MARKS and w for w in after)
    said = any(_bare(w) in SAYING for w in before[:-1])
    return (opened and closed) or said


class Scorer:
    """Terms, weights of spelling variants, and the regression's coefficients."""

    def __init__(self, weights: dict[str, float], variants: dict[str, float], coefficients=None):
        self.weights = weights
        self.variants = variants
        self.coefficients = coefficients if coefficients is not None else np.zeros(4)
        self.automaton = Automaton(list(weights))

    def numbers(self, text: str | None) -> tuple[float, float, float]:
        """Weight of all hits (its logarithm), the largest, and hits per word of a whole text."""
        words = (text or "").lower().split()
        hits: dict[str, float] = {}
        for word in set(words):
            found = self.automaton.match(_bare(word))
            if found:
                term, edits = found
                share = 1.0 if not edits else self.variants.get(_bare(word), UNSEEN)
                hits[word] = self.weights[term] * share
        if not hits:
            return 0.0, 0.0, 0.0
        total, most, number = 0.0, 0.0, 0
        for at, word in enumerate(words):
            if word in hits:
                weight = hits[word] * (QUOTED if quotation(words, at) else 1)
                total, most, number = total + weight, max(most, weight), number + 1
        return math.log1p(total), most, number / len(words)

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(numbers)), numbers]) @ self.coefficients
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method; the intercept is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    shrink = np.diag([1e-9, *[ridge] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (y - p) - shrink @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink + 1e-9 * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _counts(labelled: DataFrame, chosen) -> DataFrame:
    """(word, toxic documents, other documents) of the words that ``chosen`` picks from a set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pick = chosen()
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                seen[toxic].update(pick({_bare(w) for w in (text or "").lower().split()}))
        words = list(seen[0] | seen[1])
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            columns = part, [seen[1][w] for w in part], [seen[0][w] for w in part]
            yield pa.RecordBatch.from_pydict(dict(zip(("word", "yes", "no"), columns)), schema)

    schema = pa.schema([("word", pa.string()), ("yes", pa.int64()), ("no", pa.int64())])
    partial = labelled.mapInArrow(count, "word string, yes long, no long")
    return partial.groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def choose_terms(held: list[list[str]], toxic: list[int]) -> dict[str, float]:
    """Terms and their weights, greedily: the next one is in most toxic documents that lack terms.

    ``held`` has the candidates in each document.
    """
    users: dict[str, list[int]] = {}
    for number, words in enumerate(held):
        for word in words:
            users.setdefault(word, []).append(number)
    no = {w: sum(not toxic[d] for d in docs) for w, docs in users.items()}
    yes = {w: len(docs) - no[w] for w, docs in users.items()}
    have, weights = Counter(), {}
    while users and len(weights) < TERMS:
        word = max(users, key=lambda w: (yes[w] - no[w], w))
        left, docs = yes[word], users.pop(word)
        if left < LEAST_DOCUMENTS or left / (left + no[word]) < PRECISION:
            continue
        weights[word] = (len(docs) - no[word] + 0.5) / (len(docs) + 1)
        for d in docs:
            have[d] += 1
            if toxic[d] and have[d] == ENOUGH:
                for other in held[d]:
                    if other in users:
                        yes[other] -= 1
    return weights


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on at most ``sample`` labelled documents (columns doc_id, text; doc_id, toxic)."""
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    labelled = written(rows.select("text", "toxic"), "labelled-documents")
    n = dict(labelled.groupBy("toxic").count().collect())
    yes, no = n.get(1, 0), n.get(0, 0)
    if not yes or not no:
        rate = (yes + 0.5) / (yes + no + 1) if yes + no else 0.0
        return Scorer({}, {}, np.array([math.log(max(rate, 1e-6) / (1 - rate)), 0, 0, 0]))

    counted = _counts(labelled.filter("toxic = 1"), lambda: lambda words: words - {""})
    used = [r["word"] for r in counted.filter(F.col("yes") >= LEAST_DOCUMENTS).collect()]
    counted = _counts(labelled, lambda: frozenset(used).intersection)
    found = counted.filter(F.col("yes") / (F.col("yes") + F.col("no")) >= PRECISION).toPandas()
    candidates = frozenset(found["word"])

    def holding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [
                sorted(candidates & {_bare(w) for w in (t or "").lower().split()})
                for t in batch["text"]
            ]
            yield pd.DataFrame({"words": sets, "toxic": batch["toxic"].to_numpy()})

    held = labelled.mapInPandas(holding, "words array<string>, toxic int")
    held = held.filter(F.size("words") > 0).toPandas()  # of the sample, so bounded
    weights = choose_terms(held["words"].tolist(), held["toxic"].tolist())

    def misspelt():
        automaton = Automaton(list(weights))

        def pick(words):
            return [w for w in words if (hit := automaton.match(w)) and hit[1]]

        return pick

    seen = _counts(labelled, misspelt).toPandas()
    prior = yes / (yes + no)
    share = ((seen["yes"] + UNSEEN) / (seen["yes"] + seen["no"] + 1) - prior) / (1 - prior)
    variants = dict(zip(seen["word"], share.clip(0, 1).astype(float)))

    scorer = Scorer(weights, variants)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            numbers = [scorer.numbers(t) for t in batch["text"]]
            out = pd.DataFrame(numbers, columns=["a", "b", "c"], dtype=float)
            yield out.assign(toxic=batch["toxic"].to_numpy())

    points = labelled.mapInPandas(features, "a double, b double, c double, toxic int").toPandas()
    scorer.coefficients = _fit(points[["a", "b", "c"]].to_numpy(), points["toxic"].to_numpy(float))
    return scorer


def score(scorer: Scorer, text: Column | str) -> Column:
    state = (scorer.weights, scorer.variants, scorer.coefficients)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        local = Scorer(*state)
        for texts in batches:
            numbers = np.array([local.numbers(t) for t in texts], float).reshape(-1, 3)
            yield pd.Series(local.probability(numbers))

    return scored(text)


def held_out(doc_id: Column | str) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return remainder(doc_id, 4) == 2


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learned from labels of rows that are not held out (of several labels of a document the
    highest counts). NULL and empty texts have no hits and score as such; without labels of
    both kinds every score is the share of toxic ones. Repeated rows come back as often as
    they are there, an empty table gives no rows, other columns are left behind.
    """
    rows = documents(docs, "doc_id", "text")
    scorer = learn(rows, labels.filter(~held_out("doc_id")), sample)
    scored = rows.select("doc_id", held_out("doc_id").alias("held_out"), score(scorer, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

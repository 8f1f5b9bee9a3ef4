import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LARGE, read, rows
from tickwright.llm import quality
from tickwright.session import written


def symbols(text):
    out, before = [0] * 4, False
    for c in map(ord, text):
        blank = c == 32 or 9 <= c <= 13
        if blank and not before:
            out.append(33)
        elif not blank:
            out.append(0 if c == 0 else 49 if 48 <= c <= 57 else c % 4093 + 1)
        before = blank
    return out


class Plain:
    """Interpolated modified Kneser-Ney in so many words."""

    def __init__(self, texts):
        self.tables = {5: Counter()}
        for text in texts:
            s = symbols(text)
            self.tables[5].update(tuple(s[i - 4 : i + 1]) for i in range(4, len(s)))
        for k in (4, 3, 2, 1):
            self.tables[k] = Counter(g[1:] for g in self.tables[k + 1])
        self.discounts = {k: self._discounts(Counter(t.values())) for k, t in self.tables.items()}

    def _discounts(self, c):
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        out = []
        for i in (1, 2, 3):
            whole = c[1] and c[2] and c[i] and c[i + 1]
            found = i - (i + 1) * y * c[i + 1] / c[i] if whole else i * 0.6
            out.append(min(max(found, 0.05), i - 0.05) if whole else found)
        return out

    def p(self, gram):
        if not gram:
            return 1 / 4096
        table, d = self.tables[len(gram)], self.discounts[len(gram)]
        own = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not own:
            return self.p(gram[1:])
        total, n = sum(own.values()), own.get(gram, 0)
        left = sum(d[min(m, 3) - 1] for m in own.values()) / total
        return (n - d[min(n, 3) - 1] if n else 0) / total + left * self.p(gram[1:])

    def perplexity(self, text):
        s = symbols(text)
        logs = [math.log(self.p(tuple(s[i - 4 : i + 1]))) for i in range(4, len(s)) if s[i]]
        return math.exp(-sum(logs) / len(logs))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = ["the", "of", "an", "re", "ti", "on", "ing", "X1", "é"]
    return [" ".join(draw.choice(words) for _ in range(draw.randint(1, 30))) for _ in range(40)]


@pytest.fixture(scope="module")
def model(spark, texts):
    frame = spark.createDataFrame([("en", t) for t in texts[:30]], "lang string, text string")
    counts = written(quality.count_ngrams(frame), "ngrams")
    return written(quality.build(counts), "model")


@pytest.mark.parametrize("shard_rows, passes", [(10**6, 1), (200, 4)])
def test_perplexity_equals_the_definition(spark, texts, model, shard_rows, passes):
    assert len(quality._passes(model, shard_rows)) >= passes
    plain = Plain(texts[:30])
    given = [*texts[30:], "zzz  q\n\n9", "the", "a\0b"]
    cases = [(i, "en", t) for i, t in enumerate(given)] + [(0, "en", given[0])]
    cases += [(77, "xx", "abc"), (78, None, "abc"), (79, "en", ""), (80, "en", None)]
    docs = spark.createDataFrame(cases, "doc_id long, lang string, text string")
    found = quality.perplexities(docs, model, shard_rows).collect()
    assert len(found) == len(cases)
    for r in found:
        if r.doc_id < 70:
            assert r.perplexity == pytest.approx(plain.perplexity(given[r.doc_id]), rel=1e-4)
        else:
            assert r.perplexity is None and r.symbols == 0


def test_pieces_of_long_texts_lose_nothing(monkeypatch):
    text = "one two  three 45\n six " * 30
    whole = quality.ngrams([(0, text, 0)])[0]
    monkeypatch.setattr(quality, "_PIECE", 70)
    parts = [quality.ngrams(p)[0] for p in quality._pieces([text, None, ""])]
    assert np.array_equal(np.concatenate(parts), whole)


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = read(spark, LARGE, "documents"), read(spark, LARGE, "labels")
    found = quality.judge(docs, labels).join(labels, "doc_id").filter(quality.unseen("doc_id"))
    kept = {r[0]: r[1] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.15


def test_nulls_repeats_and_no_trusted_text(spark, texts):
    cases = [(i, "en", t) for i, t in enumerate(texts)]
    cases += [(1, "en", texts[1]), (77, "xx", "abc"), (78, None, "abc"), (79, "en", ""), (None, "xx", None)]
    docs = spark.createDataFrame(cases, "doc_id long, lang string, text string").withColumns(
        {"kept": F.lit(1), "address": F.lit("a"), "perplexity": F.lit("p"), "n": F.lit(3)}
    )
    labels = spark.createDataFrame(
        [(i, 1) for i in range(30)] + [(30, 0), (30, 1), (None, 1)], "doc_id long, quality int"
    )
    found = quality.judge(docs, labels)
    assert found.count() == len(cases)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[77].kept and by_id[78].kept and not by_id[79].kept and not by_id[None].kept
    assert rows(found.filter("doc_id = 1"), "kept") == [(True,), (True,)]
    assert quality.judge(docs.limit(0), labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).filter("kept").count() == len(cases) - 2

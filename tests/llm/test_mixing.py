import math

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tickwright.llm.mixing import Mix, mix, mixed, weights


def corpus(spark, sizes, words=10):
    cases = [(f"{s}-{i}", s, "w " * words) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(cases, "doc_id string, source string, text string")


def epochs(df):
    found = df.groupBy("source").agg(F.count("*") / F.countDistinct("doc_id")).collect()
    return {r[0]: r[1] for r in found}


def test_repetition_limit_is_met(spark):
    docs = corpus(spark, {"big": 1000, "mid": 100, "small": 10})
    found = epochs(mix(docs, entropy=1.0, repeats=3.0))
    assert found["big"] == pytest.approx(1.0) and found["small"] == pytest.approx(3.0, abs=0.15)
    assert found["mid"] == pytest.approx(math.sqrt(3), abs=0.05)


def test_entropy_is_met(spark):
    sources = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "source string, tokens long")
    w = [r.weight for r in weights(sources, 0.7, 1000.0, None).collect()]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.7 * math.log(3), abs=1e-4)


def test_budget_and_blocks(spark):
    docs = corpus(spark, {"big": 600, "small": 200})
    out = mix(docs, entropy=1.0, repeats=10.0, budget=8000, block_tokens=1000)
    totals = {r.source: r.n for r in out.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    assert totals == {"big": 4000, "small": 4000}
    per_block = out.groupBy("block", "source").agg(F.sum("tokens").alias("n")).collect()
    assert len(per_block) == 16 and all(abs(r.n - 500) <= 20 for r in per_block)
    for block in out.groupBy("block").agg(F.sort_array(F.collect_list("position")).alias("p")).collect():
        assert block.p == list(range(1, len(block.p) + 1))


def test_stretches_do_not_change_the_order(spark, monkeypatch):
    docs = corpus(spark, {"a": 300, "b": 50})
    whole = rows(mix(docs, entropy=1.0, repeats=2.0))
    monkeypatch.setattr("tickwright.llm.mixing.STRETCH", 5)
    assert rows(mix(docs, entropy=1.0, repeats=2.0)) == whole


def test_documents_come_as_often_as_the_order_says(spark):
    docs = corpus(spark, {"a": 300, "b": 50}).withColumns({c: F.lit(c) for c in ("key", "copy", "block")})
    plan = Mix(docs, repeats=1.5).copies().groupBy("key").count()
    found = mixed(docs, repeats=1.5, block_tokens=500)
    assert found.columns == docs.columns
    counted = found.groupBy(F.md5(F.concat(F.lit("mix:"), "doc_id")).alias("key")).count()
    assert rows(counted) == rows(plan)
    assert found.select("doc_id").distinct().count() == 350


def test_nulls_repeats_and_empties(spark):
    cases = [(1, "a b c", "x"), (None, "", None), (3, None, "x"), (3, "q r", None), (4, "z", "z"), (4, "z", "z")]
    docs = spark.createDataFrame(cases, "doc_id long, text string, source string")
    shown = rows(mix(docs, repeats=1.0), "doc_id", "source", "tokens", "copy")
    assert shown == [
        (None, None, 0, 0),
        (1, "x", 3, 0),
        (3, None, 2, 0),
        (3, "x", 0, 0),
        (4, "z", 1, 0),
        (4, "z", 1, 0),
    ]
    assert rows(mixed(docs, repeats=1.0)) == rows(docs)
    assert mix(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0
    silent = docs.filter("text is null or text = ''")
    assert mixed(silent).count() == 2


def test_a_budget_beyond_the_limit_is_refused(spark):
    """Ten documents of ten tokens, two passes at most: 200 tokens fit, more do not."""
    docs = spark.createDataFrame([(i, f"s{i % 2}", "a b c d e f g h i j") for i in range(10)], "doc_id long, source string, text string")
    taken = mix(docs, repeats=2, budget=200)
    assert taken.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    with pytest.raises(ValueError, match="passes"):
        mix(docs, repeats=2, budget=201)

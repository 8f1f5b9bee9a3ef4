from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tickwright.llm.exact_dedup import block_key, exact_dedup, last_of_each

CASES = [
    (1, "a" * 5000),
    (2, "a" * 5000),
    (2, "a" * 5000),
    (9, "a" * 4999),
    (None, ""),
    (3, None),
    (3, None),
    (4, "x"),
    (None, "q"),
    (5, "a" * 100 + "b" * 100),
    (6, "b" * 100 + "a" * 100),
]
EXPECTED = [
    (None, None, 1, True),
    (None, 3, 3, False),
    (1, 2, 3, False),
    (2, 2, 3, False),
    (2, 2, 3, True),
    (3, 3, 3, False),
    (3, 3, 3, True),
    (4, 4, 1, True),
    (5, 5, 1, True),
    (6, 6, 1, True),
    (9, 9, 1, True),
]
SHOWN = ("doc_id", "keep_id", "group_size", "kept")


def frame(spark):
    return spark.createDataFrame(CASES, "doc_id long, text string")


def test_nulls_repeats_and_ties(spark):
    assert rows(exact_dedup(frame(spark), block_bytes=100), *SHOWN) == EXPECTED


def test_keys_that_clash_are_replaced(spark):
    """Blocks of one length share a key at first; the table of blocks tells."""

    def weak(block, seed):
        if seed:
            return block_key(block, seed)
        length = F.octet_length(block).cast("long")
        return F.struct(length.alias("a"), length.alias("b"))

    assert rows(exact_dedup(frame(spark), block_bytes=100, key=weak), *SHOWN) == EXPECTED


def test_equal_identity_only_for_equal_bytes(spark):
    texts = ["é" * n for n in (1, 2, 3, 50)] + ["e" * n for n in (2, 4, 100)] + ["é" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.keep_id for r in exact_dedup(docs, block_bytes=3).collect()}
    last = {t: i for i, t in enumerate(texts)}
    assert found == {i: last[t] for i, t in enumerate(texts)}


def test_empty_table(spark):
    assert exact_dedup(frame(spark).limit(0)).count() == 0
    assert last_of_each(frame(spark).limit(0)).count() == 0


def test_rows_keep_columns_whatever_their_names(spark):
    docs = frame(spark).withColumns(
        {"address": F.lit("a"), "number": F.lit(1), "row": F.lit(2), "name": F.lit("n"), "text_sha256": F.lit("")}
    )
    kept = last_of_each(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(None,), (2,), (3,), (4,), (5,), (6,), (9,)]

"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. All distinct blocks of the corpus are
sorted and numbered, so that a block's number is its name; then adjacent names are paired, the
distinct pairs sorted and numbered, and so on until every document has one name. Documents
with as many blocks and the same name have the same bytes: there is no hash to collide.

Blocks travel once. Rows look their block's name up by a 128-bit key, and the table of
distinct blocks, which is compared in full, proves the key unique for this corpus; were it
not, naming would begin again with other keys.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwright.llm.common import address, documents, keep_addressed, text_sha, written

BLOCK_BYTES = 2048

BlockKey = Callable[[Column, int], Column]


def block_key(block: Column, seed: int) -> Column:
    """Two seeded 64-bit hashes of a block."""
    return F.struct(
        F.xxhash64(F.lit(2 * seed), block).alias("a"),
        F.xxhash64(F.lit(2 * seed + 1), block).alias("b"),
    )


def _blocks(text: Column, size: int) -> Column:
    """A text's blocks in order; an empty text has one empty block."""
    data = text.cast("binary")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / size).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(data, i * size + 1, F.lit(size)),
    )


def _named(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the distinct keys in the order they are sorted in; written, so that it stays."""
    ordered = distinct.sortWithinPartitions(*keys)
    return written(ordered.withColumn("name", F.monotonically_increasing_id()), name)


def _block_names(texts: DataFrame, size: int, key: BlockKey):
    """Names of all distinct blocks, and the seed whose keys tell them apart."""
    seed = 0
    while True:
        blocks = texts.select(F.explode(_blocks(F.col("text"), size)).alias("block"))
        keyed = blocks.select(key(F.col("block"), seed).alias("key"), "block")
        distinct = keyed.select("key.a", "key.b", "block").distinct()
        # the text of a block is compared by distinct() and is not needed afterwards
        names = _named(distinct.select("a", "b"), ["a", "b"], "block-names")
        if names.groupBy("a", "b").count().filter("count > 1").isEmpty():
            return names, seed
        seed += 1


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    key: BlockKey = block_key,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    NULL texts are empty texts. Of equal texts the row with the largest id stays; a NULL id is
    smaller than any other, and of rows that share the largest id exactly one is kept. An empty
    table gives no rows. Other columns are left behind.
    """
    texts = documents(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    names, seed = _block_names(texts, block_bytes, key)
    digests = written(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            text_sha("text").alias("text_sha256"),
            F.transform(_blocks(F.col("text"), block_bytes), lambda b: key(b, seed)).alias("keys"),
        ),
        "digests",
    )

    rows = digests.select("row", F.posexplode("keys").alias("at", "key"))
    rows = rows.select("row", "at", "key.a", "key.b").join(names, ["a", "b"])
    sequences = _sequences(rows.select("row", "at", "name"))
    finished = []
    level = 0
    while True:
        sequences = written(sequences, f"names-{level}")
        finished.append(
            sequences.filter(F.size("names") == 1).select(
                "row", F.lit(level).alias("level"), F.col("names")[0].alias("name")
            )
        )
        sequences = sequences.filter(F.size("names") > 1)
        if sequences.isEmpty():
            break
        sequences = _paired(sequences)
        level += 1
    identity = finished[0]
    for part in finished[1:]:
        identity = identity.unionAll(part)

    named = digests.select(
        "row", "id", "text_sha256", F.size("keys").alias("blocks")
    ).join(identity, "row")
    named = written(named, "identities")
    same = ["blocks", "level", "name"]
    # written, so that the join below is one of two plain shuffles and can split a hot group
    groups = written(
        named.groupBy(*same).agg(
            F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    return named.join(groups, same).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def _sequences(rows: DataFrame) -> DataFrame:
    """Each document's names in order; as long as its text, whatever its copies."""
    packed = rows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("s"))
    return packed.select("row", F.col("s.name").alias("names"))


def _paired(sequences: DataFrame) -> DataFrame:
    """Name the adjacent pairs of every sequence; a last one without partner pairs with NULL."""
    count = F.ceil(F.size("names") / 2).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            F.get("names", 2 * i).alias("left"),
            F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("right"),
        ),
    )
    rows = sequences.select("row", F.posexplode(pairs).alias("at", "pair"))
    rows = rows.select("row", "at", "pair.left", "pair.right")
    names = _named(rows.select("left", "right").distinct(), ["left", "right"], "pair-names")
    return _sequences(rows.join(names, ["left", "right"]).select("row", "at", "name"))


def last_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, all their columns; of rows equal in id and text one stays."""
    kept = exact_dedup(docs).filter("kept")
    return keep_addressed(docs, kept.select(address("doc_id", "text_sha256").alias("address")))

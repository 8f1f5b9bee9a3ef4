"""Mixing sources to target weights by a temperature.

A source's weight is its share of all tokens to a power, normalised. The exponent is bisected:
it is the flattest mix whose entropy is no higher than asked for and in which no source is
repeated too often. A source's weight times the budget is its quota, which is realised as whole
passes over its documents and a part of one more, in an order drawn by a keyed digest. All
passes of all sources advance together over blocks of equal budget, so that each block has
about the target weights; within a block the order is drawn again.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwright.llm.common import documents, fresh, written

#: Of the highest entropy possible; and passes over a source's documents.
ENTROPY, REPEATS = 0.97, 2.0
BLOCK_TOKENS = 1_000_000
SEED = "mix"

STEPS = 20
#: Rows of a source that one running sum covers, on average.
STRETCH = 20_000
#: A table of this many sources is small enough to be sent to every task.
FEW_SOURCES = 10_000


def words(text: Column | str) -> Column:
    """Tokens of a text as the mix counts them: runs without blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def _drawn(key: Column | str, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key, F.lit("null"))))


def _measures(sources: DataFrame, total: int, alpha: float) -> tuple[float, float, float]:
    """Entropy of the weights, their norm, and the largest passes over the fewest."""
    share = F.col("tokens") / F.lit(total)
    weight = F.pow(share, F.lit(alpha))
    passes = F.pow(share, F.lit(alpha - 1))
    row = sources.filter("tokens > 0").agg(
        F.sum(weight), F.sum(weight * F.log(share)), F.max(passes) / F.min(passes)
    ).first()
    norm, logs, ratio = row
    return math.log(norm) - alpha * logs / norm, norm, ratio


def weights(sources: DataFrame, entropy: float, repeats: float, budget: int | None) -> DataFrame:
    """Add weight, quota, whole (passes) and rest (tokens) to a table of source and tokens.

    ``budget`` None is the smallest one that uses every source whole. One that even weights in
    proportion to the sources cannot meet without more than ``repeats`` passes is an error. Sources
    that are more even than ``entropy`` by themselves keep their proportions. The driver sees sums
    over the sources only.
    """
    total, number = sources.filter("tokens > 0").agg(F.sum("tokens"), F.count("*")).first()
    if not number:
        return sources.selectExpr(
            "*", "0D AS weight", "CAST(0 AS LONG) AS quota", "CAST(1 AS LONG) AS whole", "CAST(0 AS LONG) AS rest"
        )

    if budget is not None and budget > repeats * total:
        raise ValueError(f"{budget} tokens need more than {repeats} passes over {total}")

    def size(alpha: float) -> float:
        if budget is not None:
            return float(budget)
        share = F.col("tokens") / F.lit(total)
        _, norm, _ = _measures(sources, total, alpha)
        most = sources.filter("tokens > 0").agg(F.max(F.pow(share, F.lit(1 - alpha)))).first()[0]
        return total * norm * most

    def fits(alpha: float) -> bool:
        found, norm, ratio = _measures(sources, total, alpha)
        if budget is not None:
            least = sources.filter("tokens > 0").agg(F.min("tokens")).first()[0] / total
            ratio = least ** (alpha - 1) / norm * budget / total
        return found <= entropy * math.log(number) + 1e-12 and ratio <= repeats

    low, high = 0.0, 1.0
    if fits(low):
        high = low
    for _ in range(STEPS if high > low else 0):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    _, norm, _ = _measures(sources, total, high)
    weight = F.when(
        F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(high)) / F.lit(norm)
    ).otherwise(0.0)
    out = sources.withColumn("weight", weight)
    out = out.withColumn("quota", F.round(F.col("weight") * F.lit(size(high))).cast("long"))
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1)
    out = out.withColumn("whole", whole.cast("long"))
    return out.withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens"))


class Mix:
    """The plan of a mix: its sources, and where in a source's order each group of rows stands.

    Rows with the same source and drawn key are one group; they are taken together.
    """

    def __init__(self, docs: DataFrame, entropy=ENTROPY, repeats=REPEATS, budget=None, seed=SEED):
        self.seed = seed
        rows = documents(docs, "doc_id", "source", "text").select(
            F.col("doc_id"), F.col("source").cast("string").alias("source"), words("text").alias("tokens")
        )
        self.rows = written(rows.withColumn("key", self.key()), "mix-rows")
        groups = self.rows.groupBy("source", "key").agg(F.sum("tokens").alias("tokens"))
        groups = written(groups, "mix-groups")
        totals = groups.groupBy("source").agg(
            F.sum("tokens").alias("tokens"), F.count("*").alias("groups")
        )
        totals = written(totals, "mix-totals")
        plan = weights(totals.select("source", "tokens", "groups"), entropy, repeats, budget)
        self.sources = written(plan, "mix-sources")
        self.groups = written(self._running(groups), "mix-order")

    def key(self) -> Column:
        return _drawn(F.col("doc_id").cast("string"), self.seed)

    def _running(self, groups: DataFrame) -> DataFrame:
        """Add the tokens before each group in its source's order.

        A source is cut by its keys into stretches, of which each is summed on its own.
        """
        most = self.sources.agg(F.max("groups")).first()[0] or 0
        digits = max(1, math.ceil(math.log(max(1, most / STRETCH), 16)))
        cut = groups.withColumn("stretch", F.substring("key", 1, digits))
        sums = cut.groupBy("source", "stretch").agg(F.sum("tokens").alias("all"))
        ahead = Window.partitionBy("source").orderBy("stretch")
        sums = sums.withColumn("ahead", F.sum("all").over(ahead) - F.col("all")).drop("all")
        within = Window.partitionBy("source", "stretch").orderBy("key")
        cut = cut.withColumn("inside", F.sum("tokens").over(within) - F.col("tokens"))
        same = cut["source"].eqNullSafe(sums["source"]) & (cut["stretch"] == sums["stretch"])
        return cut.join(sums, same).select(
            cut["source"], "key", "tokens", (F.col("inside") + F.col("ahead")).alias("before")
        )

    def copies(self) -> DataFrame:
        """(source, key, tokens, at, copy): each pass over a group, and its place in the quota."""
        plan = self.sources.select("source", F.col("tokens").alias("all"), "quota", "whole", "rest")
        plan = F.broadcast(plan) if plan.count() <= FEW_SOURCES else plan
        rows = self.groups.join(plan, self.groups["source"].eqNullSafe(plan["source"])).drop(plan["source"])
        more = (F.col("before") + F.col("tokens") <= F.col("rest")) & (F.col("tokens") > 0)
        passes = F.col("whole") + more.cast("long")
        rows = rows.filter(passes > 0)
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)))
        at = (F.col("copy") * F.col("all") + F.col("before")) / F.greatest("quota", F.lit(1))
        return rows.select("source", "key", "tokens", "copy", at.alias("at"))

    def blocks(self, block_tokens: int) -> int:
        return max(1, math.ceil((self.sources.agg(F.sum("quota")).first()[0] or 0) / block_tokens))


def mix(
    docs: DataFrame,
    *,
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
) -> DataFrame:
    """The mixed order: doc_id, source, tokens, copy (from 0), block, position (in the block).

    ``entropy`` is a share of the highest possible, ``repeats`` the most passes over a source;
    ``budget`` counts tokens, None takes every source whole at least once. A NULL source is a
    source of its own, documents without tokens come once if the budget allows their source,
    and NULL ids share one place. Rows equal in source and id are taken together, each as
    often as it is there. An empty table gives no rows; other columns are left behind.
    """
    plan = Mix(docs, entropy, repeats, budget, seed)
    blocks = plan.blocks(block_tokens)
    copies = plan.copies()
    block = F.least(F.floor(F.col("at") * blocks), F.lit(blocks - 1)).cast("long")
    copies = copies.withColumn("block", block).select(
        F.col("source").alias("s"), F.col("key").alias("k"), "copy", "block"
    )
    rows = plan.rows
    same = (rows["key"] == copies["k"]) & rows["source"].eqNullSafe(copies["s"])
    placed = rows.join(copies, same).select("doc_id", "source", "tokens", "copy", "block", "key")
    drawn = _drawn(F.concat_ws(":", "key", F.coalesce("source", F.lit("null")), "copy"), seed)
    order = Window.partitionBy("block").orderBy("drawn", "tokens")
    placed = placed.withColumn("drawn", drawn).withColumn("position", F.row_number().over(order))
    return placed.select("doc_id", "source", "tokens", "copy", "block", "position")


def mixed(docs: DataFrame, *, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents as often as the mix takes them, all their columns, block by block.

    How often a row comes follows from its source and key, so that texts move once, into their
    blocks; a row's place in its source's order is its key's place among all keys.
    """
    plan = Mix(docs, repeats=repeats)
    blocks = plan.blocks(block_tokens)
    # the last group that still fits into the part of a pass; all up to it come once more
    rest = plan.sources.select("source", "rest").withColumnRenamed("source", "s")
    taken = plan.groups.join(rest, plan.groups["source"].eqNullSafe(rest["s"])).filter(
        (F.col("tokens") > 0) & (F.col("before") + F.col("tokens") <= F.col("rest"))
    )
    last = taken.groupBy("s").agg(F.max("key").alias("last"))
    sources = plan.sources.select("source", "tokens", "quota", "whole")
    sources = sources.join(last, sources["source"].eqNullSafe(last["s"]), "left")
    names = {c: fresh(docs, c) for c in ("s_source", "s_last", "s_whole", "s_passes", "key", "copy", "block")}
    sources = written(
        sources.select(
            F.col("source").alias(names["s_source"]),
            F.col("last").alias(names["s_last"]),
            F.col("whole").alias(names["s_whole"]),
            F.greatest(F.col("quota") / F.greatest("tokens", F.lit(1)), F.lit(1.0)).alias(names["s_passes"]),
        ),
        "mix-ends",
    )
    if sources.count() <= FEW_SOURCES:
        sources = F.broadcast(sources)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, copy, block = (F.col(names[c]) for c in ("key", "copy", "block"))
    rows = docs.withColumn(names["key"], plan.key())
    rows = rows.join(sources, rows["source"].cast("string").eqNullSafe(F.col(names["s_source"])))
    more = F.coalesce(key <= F.col(names["s_last"]), F.lit(False)) & (words("text") > 0)
    passes = F.col(names["s_whole"]) + more.cast("long")
    rows = rows.filter(passes > 0)
    rows = rows.withColumn(names["copy"], F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)))
    place = F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / 16.0**12
    at = F.least(F.floor((copy + place) / F.col(names["s_passes"]) * blocks), F.lit(blocks - 1))
    rows = rows.withColumn(names["block"], at.cast("long"))
    rows = rows.repartition(block).sortWithinPartitions(
        block, _drawn(F.concat_ws(":", key, copy), plan.seed)
    )
    return rows.select(*columns)

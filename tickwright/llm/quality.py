"""Quality by perplexity under a modified Kneser-Ney model of trusted text.

The model predicts a character from the four before it; case and punctuation stay, blanks and
digits are one symbol each. N-gram counts of each language's trusted documents are summed in
each task and again after a shuffle, so they follow the amount of text. Lower orders,
context totals and interpolated probabilities are aggregates and joins of these count tables,
partitioned by n-gram. For scoring, the tables are cut into shards of bounded size by the three
symbols that all high orders of a prediction share: a pass over the documents takes one shard
and adds up what it can predict, so neither texts nor their n-grams are shuffled. A document
is kept up to its language's quantile of the perplexity of trusted documents the model has
not seen.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tickwright.llm.common import address, documents, remainder, slices, text_sha, written

ORDER = 5
BITS = 12
#: Entries of the model that one pass holds.
SHARD_ROWS = 4_000_000
#: Of the trusted documents of a language, how many stay; and how much higher than theirs a
#: perplexity may be, as a factor.
QUANTILE, MARGIN = 0.995, 1.0
#: Trusted documents that a quantile needs; a language with fewer that the model has not seen
#: takes it from all its trusted documents.
ENOUGH = 50

_SYMBOL = (1 << BITS) - 1
_PIECE = 1 << 20


def _pieces(texts) -> Iterator[list[tuple[int, str, bool]]]:
    """Lists of (row, part of its text, whether it begins there) of about a piece together.

    A part begins with the symbols that the part before ended with, as their context.
    """
    batch, size = [], 0
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = min(len(text), at + _PIECE)
            batch.append((row, text[max(0, at - 64) : end], min(at, 64)))
            size, at = size + end - at, end
            if size >= _PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def ngrams(parts: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams (five symbols of twelve bits) of all parts, and for each its row.

    Each part is (row, text, how many characters of it are context only).
    """
    pad = "\0" * (ORDER - 1)
    joined = "".join(pad + t for _, t, _ in parts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array([len(t) + len(pad) for _, t, _ in parts])
    starts = np.cumsum(lengths) - lengths
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    symbols = (codes % 4093 + 1).astype(np.int64)
    symbols[blank] = 33
    symbols[(codes >= 48) & (codes <= 57)] = 49
    symbols[codes == 0] = 0
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # the first of several blanks
    counted = symbols > 0
    for start, (_, _, context) in zip(starts, parts):
        if context:
            counted[start : start + len(pad) + context] = False
    symbols, counted = symbols[kept], counted[kept]
    owner = np.repeat(np.array([row for row, _, _ in parts]), lengths)[kept]
    grams = symbols.copy()
    for back in range(1, ORDER):
        grams[back:] |= symbols[:-back] << (BITS * back)
    return grams[counted], owner[counted]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.bincount(back, np.concatenate([n for _, n in parts]), len(keys))
    return keys, n.astype(np.int64)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts (columns lang, text), summed in each task first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                own = sums.setdefault(lang, [])
                for parts in _pieces(rows["text"]):
                    own.append(np.unique(ngrams(parts)[0], return_counts=True))
                    if len(own) > 16:
                        own[:] = [_merged(own)]
        for lang, own in sums.items():
            if own:
                grams, n = _merged(own)
                yield from slices(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))

    partial = docs.select("lang", "text").mapInPandas(counted, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# the model


def _suffix(order: int) -> Column:
    """An n-gram without its first symbol, which leaves ``order`` of them."""
    return F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))


def _discounts(tables: dict[int, DataFrame]) -> DataFrame:
    """(lang, order, d1, d2, d3): modified Kneser-Ney discounts from the counts of counts."""
    parts = [
        t.filter("n <= 4").groupBy("lang", F.lit(k).alias("order")).pivot("n", [1, 2, 3, 4]).count()
        for k, t in tables.items()
    ]
    seen = parts[0]
    for part in parts[1:]:
        seen = seen.unionAll(part)
    seen = seen.select("lang", "order", *[F.coalesce(f"`{i}`", F.lit(0)).alias(f"c{i}") for i in range(1, 5)])
    y = F.col("c1") / (F.col("c1") + 2 * F.col("c2"))

    def discount(i: int) -> Column:
        found = i - (i + 1) * y * F.col(f"c{i + 1}") / F.col(f"c{i}")
        usual = F.lit(i * 0.6)
        # too few counts to estimate from: the usual size
        few = (F.col("c1") == 0) | (F.col("c2") == 0) | (F.col(f"c{i}") == 0) | (F.col(f"c{i + 1}") == 0)
        return F.when(few, usual).otherwise(F.least(F.greatest(found, F.lit(0.05)), F.lit(i - 0.05)))

    safe = seen.withColumns({f"c{i}": F.col(f"c{i}").cast("double") for i in range(1, 5)})
    return safe.select("lang", "order", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])


def build(counts: DataFrame) -> DataFrame:
    """(lang, kind, gram, value): log probabilities of n-grams (kind = order) and log weights
    that contexts leave to the lower order (kind = - order)."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        lower = tables[order + 1].groupBy("lang", _suffix(order).alias("gram"))
        tables[order] = written(lower.agg(F.count("*").alias("n")), f"continuations-{order}")
    discounts = written(_discounts(tables), "discounts")
    taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    model, lower = None, None
    for order in range(1, ORDER + 1):
        own = discounts.filter(F.col("order") == order).drop("order")
        # languages that have no count up to four at this order
        rows = tables[order].join(own, "lang", "left")
        rows = rows.fillna({"d1": 0.6, "d2": 1.2, "d3": 1.8})
        rows = rows.withColumns({"context": F.shiftright("gram", BITS), "taken": taken})
        contexts = rows.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("left")
        )
        contexts = written(contexts, f"contexts-{order}")
        rows = rows.join(contexts, ["lang", "context"])
        if lower is None:
            below = F.lit(1.0 / (1 << BITS))
        else:
            rows = rows.withColumn("suffix", _suffix(order - 1))
            rows = rows.join(lower.select("lang", F.col("gram").alias("suffix"), "p"), ["lang", "suffix"])
            below = F.col("p")
        p = (F.col("n") - F.col("taken")) / F.col("total") + F.col("left") * below
        lower = written(rows.select("lang", "gram", p.alias("p")), f"probabilities-{order}")
        part = lower.select("lang", F.lit(order).alias("kind"), "gram", F.log("p").alias("value")).unionAll(
            contexts.select(
                "lang", F.lit(-order).alias("kind"), F.col("context").alias("gram"), F.log("left").alias("value")
            )
        )
        model = part if model is None else model.unionAll(part)
    return model


def _middle(kind: int, key):
    """The three symbols before the predicted one, of an entry of high order."""
    key = key if kind in (-ORDER, -(ORDER - 1)) else key >> BITS
    return key & ((1 << BITS * 3) - 1)


class Shard:
    """Sorted arrays of one shard of each language's model."""

    def __init__(self, tables: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]], parts: int, part: int):
        self.tables, self.parts, self.part = tables, parts, part

    def log_probability(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Interpolated log probabilities, backed off where an order has not been seen."""
        tables, out = self.tables[lang], np.zeros(len(grams))
        open_at = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            keys = grams[open_at] & ((1 << BITS * order) - 1)
            at, seen = _find(keys, tables[order][0])
            out[open_at[seen]] += tables[order][1][at[seen]]
            open_at, keys = open_at[~seen], keys[~seen]
            at, seen = _find(keys >> BITS, tables[-order][0])
            out[open_at[seen]] += tables[-order][1][at[seen]]
        out[open_at] -= np.log(1 << BITS)
        return out

    def sums(self, lang: str, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the sum of log probabilities in this shard, and of how many."""
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for parts in _pieces(texts):
            grams, owner = ngrams(parts)
            if self.parts > 1:
                mine = _middle(ORDER, grams) % self.parts == self.part
                grams, owner = grams[mine], owner[mine]
            total += np.bincount(owner, self.log_probability(lang, grams), len(texts))
            n += np.bincount(owner, minlength=len(texts))
        return total, n


def _find(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(among):
        return np.zeros(len(keys), int), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


def _passes(model: DataFrame, shard_rows: int) -> list[tuple[list[str], int, int]]:
    """(languages, parts, part) of every pass: small languages together, a large one in parts."""
    sizes = {r["lang"]: r["n"] for r in model.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    passes, group, held = [], [], 0
    for lang in sorted(sizes):
        parts = -(-sizes[lang] // shard_rows)
        if parts > 1:
            passes += [([lang], parts, part) for part in range(parts)]
            continue
        if held + sizes[lang] > shard_rows:
            passes.append((group, 1, 0))
            group, held = [], 0
        group, held = [*group, lang], held + sizes[lang]
    return passes + ([(group, 1, 0)] if group else [])


def _load(model: DataFrame, langs: list[str], parts: int, part: int) -> dict:
    """The entries of one shard; the low orders, which are few, are in every shard."""
    rows = model.filter(F.col("lang").isin(langs))
    if parts > 1:
        middle = F.when(F.col("kind").isin(-ORDER, 1 - ORDER), F.col("gram")).otherwise(
            F.shiftright("gram", BITS)
        )
        middle = middle.bitwiseAND(F.lit((1 << BITS * 3) - 1))
        rows = rows.filter((F.abs("kind") < ORDER - 1) | (middle % parts == part))
    # as Arrow columns of numbers: rows of objects would take ten times the memory
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    columns = [number.cast("int"), F.col("kind").cast("int"), "gram", F.col("value").cast("float")]
    lang, kind, gram, value = (c.to_numpy() for c in rows.select(*columns).toArrow().columns)
    tables: dict[str, dict] = {name: {} for name in langs}
    for number, name in enumerate(langs):
        for k in (k for order in range(1, ORDER + 1) for k in (order, -order)):
            own = np.flatnonzero((lang == number) & (kind == k))
            own = own[np.argsort(gram[own])]
            tables[name][k] = gram[own], value[own]
    return tables


def perplexities(docs: DataFrame, model: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, lang, address, perplexity, symbols) of each row (columns doc_id, lang, text).

    A pass over the texts per shard of ``shard_rows`` n-grams, which bounds what is sent to tasks.
    A language without a model, and a text without symbols, has perplexity NULL.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("address", address("doc_id", text_sha("text")))
    passes = _passes(model, shard_rows)
    known = [lang for langs, _, _ in passes for lang in langs]
    other = rows.filter(F.col("lang").isNull() | ~F.col("lang").isin(known))
    nothing = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("n"))
    found = other.select("address", "doc_id", "lang", nothing.alias("s"), F.lit(1.0).alias("times"))
    for langs, parts, part in passes:
        shared = spark.sparkContext.broadcast(_load(model, langs, parts, part))
        summed = _summed(shared, parts, part)
        own = rows.filter(F.col("lang").isin(langs))
        own = own.select("address", "doc_id", "lang", summed("lang", "text").alias("s"), F.lit(1 / parts).alias("times"))
        # one shard at a time is held, here and by the executors, however many the model has
        found = found.unionAll(written(own, "pass"))
        shared.destroy()
    # each row comes once a pass of its language, repeated rows together
    sums = found.groupBy("address", "doc_id", "lang").agg(
        F.sum("s.total").alias("total"), F.sum("s.n").alias("n"), F.round(F.sum("times")).cast("int").alias("times")
    )
    value = F.when(F.col("n") > 0, F.exp(-F.col("total") / F.col("n")))
    sums = sums.withColumns({"perplexity": value, "symbols": (F.col("n") / F.col("times")).cast("long")})
    return sums.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select(
        "doc_id", "lang", "address", "perplexity", "symbols"
    )


def _summed(shared, parts: int, part: int):
    @pandas_udf("total double, n double")
    def summed(lang: pd.Series, text: pd.Series) -> pd.DataFrame:
        shard = Shard(shared.value, parts, part)
        out = np.zeros((len(lang), 2))
        for name in lang.unique():
            at = np.flatnonzero(lang == name)
            out[at, 0], out[at, 1] = shard.sums(name, text.iloc[at].tolist())
        return pd.DataFrame(out, columns=["total", "n"])

    return summed


def unseen(doc_id: Column | str) -> Column:
    """Documents that the model does not learn from, so that their perplexity tells."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return remainder(doc_id, 4) == 2


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, perplexity, threshold, kept, symbols.

    Trusted are documents whose ``labels.quality`` is 1 (the lowest counts if a document has
    several). A document is dropped if its perplexity is above ``margin`` times its language's
    quantile. NULL and empty texts have no perplexity and are dropped; where a language has no
    trusted text, or lang is NULL, other documents have none either and are kept. Repeated
    rows come back as often as they are there, an empty table gives no rows, other columns are
    left behind.
    """
    rows = documents(docs, "doc_id", "lang", "text")
    trusted = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    trusted = written(trusted.filter("quality = 1").select("doc_id"), "trusted")
    lessons = rows.filter(~unseen("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # a shuffle at every size: sent to all tasks, the ids would be no smaller share of a larger table
    lessons = lessons.join(trusted.hint("shuffle_merge"), "doc_id", "left_semi")
    counts = written(count_ngrams(lessons), "ngrams")
    model = written(build(counts), "ngram-model")
    scored = written(perplexities(rows, model, shard_rows), "perplexities")
    good = scored.filter("perplexity is not null").join(trusted, "doc_id", "left_semi")

    def bound(part: DataFrame, name: str) -> DataFrame:
        return part.groupBy("lang").agg(
            F.percentile_approx("perplexity", quantile, 10_000).alias(name), F.count("*").alias(f"{name}_n")
        )

    limits = bound(good, "everything").join(bound(good.filter(unseen("doc_id")), "fresh"), "lang", "left")
    limit = F.when(F.col("fresh_n") >= ENOUGH, F.col("fresh")).otherwise(F.col("everything"))
    limits = written(limits.select("lang", (limit * margin).alias("threshold")), "limits")
    judged = scored.join(limits, "lang", "left")
    kept = (F.col("symbols") > 0) & (F.col("perplexity") <= F.col("threshold"))
    nothing = F.col("threshold").isNull() & (F.split("address", ":")[0] != _EMPTY)
    return judged.select(
        "doc_id", "lang", "perplexity", "threshold", F.coalesce(nothing | kept, F.lit(False)).alias("kept"), "symbols"
    )


#: SHA-256 of no bytes
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

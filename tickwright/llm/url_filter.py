"""URL filtering by block and allow rules, and by association rules mined from what they label.

Given rules judge the URLs they fit, the longest rule winning. For all others rules are mined:
URLs whose document is labelled are transactions of their tokens, FP-growth finds the
combinations that are frequent among them, and those that imply a document of low quality
with enough confidence block. Tokens that always come together are mined as one item. A mined rule stands in an inverted index under its rarest token;
a URL is looked up by its tokens and blocked if it holds all tokens of a rule found.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwright.llm.common import documents, written

ALLOW, BLOCK = "allow", "block"

#: (host, path) rules and their verdicts.
RULES = [
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
]

#: A combination needs this share of the labelled URLs, and so many of them at least, so that
#: a small table gives no rules by chance.
SUPPORT, LEAST = 0.005, 20
CONFIDENCE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column | str) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column | str) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: list[tuple[str, str, str]]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits host and path, or NULL.

    Of rules of one length the one with the longer host wins. ``rules`` is a list a user
    writes; it becomes part of the plan.
    """
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        own = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = own & F.col("path").startswith(path)
        rule = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, rule).otherwise(out)
    return out


def tokens() -> Column:
    """The distinct tokens of host and path: labels and their parts, segments, the suffix.

    Runs of digits are one token each, so that numbers do not make every URL unlike the others.
    """
    labels = F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.split("host", r"[.\-]"), lambda x: F.concat(F.lit("w:"), x))
    plain = F.regexp_replace(F.lower("path"), r"[0-9]+", "#")
    segments = F.transform(F.split(plain, "/"), lambda x: F.concat(F.lit("p:"), x))
    domain = F.array(F.concat(F.lit("t:"), F.element_at(F.split("host", r"\."), -1)))
    words = F.array_distinct(F.concat(labels, parts, segments, domain))
    return F.array_sort(F.filter(words, lambda x: F.length(x) > 2))


def document_of() -> Column:
    """The document a URL is for: the number that its path's last segment begins with."""
    return F.regexp_extract("path", r"/([0-9]{1,18})[^/]*/?$", 1).try_cast("long")


def items_of(labelled: DataFrame, least: float) -> DataFrame:
    """(token, item): tokens of at least so many labelled URLs, those of the very same URLs as one item.

    Such tokens are interchangeable in every combination, which is as frequent and as sure with any
    of them; an item is named after all of its tokens. Without this a site of long paths would
    double the combinations with each segment. Two 64-bit sums over the URLs' hashes and their number
    tell sets of URLs apart. A URL of n tokens counts for n, so there are no more rows
    than the tokens of an average URL divided by the support.
    """
    words = labelled.withColumn("row", F.monotonically_increasing_id())
    words = words.select("row", F.explode("tokens").alias("token"))
    where = F.struct(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("row")).alias("mixed"),
        F.sum(F.hash("row", F.lit(1)).cast("long")).alias("sum"),
    )
    seen = words.groupBy("token").agg(where.alias("urls")).filter(F.col("urls.n") >= least)
    same = seen.groupBy("urls").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return same.select(F.explode("tokens").alias("token"), F.array_join("tokens", "|").alias("item"))


def in_items(sets: DataFrame, items: DataFrame, *keys: str) -> DataFrame:
    """The rows with the items of their ``tokens`` that they hold any token of; ``keys`` are unique."""
    words = sets.select(*keys, F.explode_outer("tokens").alias("token"))
    held = words.join(items, "token", "left").groupBy(*keys).agg(F.collect_set("item").alias("items"))
    return held.withColumn("items", F.array_sort("items"))


def mine(labelled: DataFrame, support: float, confidence: float) -> DataFrame:
    """(tokens, confidence): combinations that imply "block", none of which contains another.

    ``labelled`` has tokens and verdict. FP-growth returns every frequent combination, so tokens
    should not be ones that always come together (``items_of``).
    """
    mark = F.concat(F.lit("verdict:"), F.col("verdict"))
    rows = labelled.select(F.concat("tokens", F.array(mark)).alias("items"))
    # FP-growth reads its transactions twice
    model = FPGrowth(minSupport=support, minConfidence=confidence).fit(written(rows, "transactions"))
    target = f"verdict:{BLOCK}"
    frequent = model.freqItemsets
    whole = frequent.filter(F.array_contains("items", target)).select(
        F.array_sort(F.array_remove("items", target)).alias("tokens"), F.col("freq").alias("both")
    )
    body = frequent.filter(~F.array_contains("items", target)).select(
        F.array_sort("items").alias("tokens"), F.col("freq")
    )
    rules = whole.join(body, "tokens").filter(
        (F.size("tokens") > 0) & (F.col("both") / F.col("freq") >= confidence)
    )
    rules = rules.select("tokens", (F.col("both") / F.col("freq")).alias("confidence"))
    rest, found = written(rules, "rules"), None
    # a rule that holds a shorter one adds nothing: the shortest stay and take theirs away
    while (size := rest.agg(F.min(F.size("tokens"))).first()[0]) is not None:
        shortest = written(rest.filter(F.size("tokens") == size), "shortest")
        found = shortest if found is None else found.union(shortest)
        longer = rest.filter(F.size("tokens") > size)
        implied = matches(longer, shortest).select("tokens")
        rest = written(longer.join(implied, "tokens", "left_anti"), "longer")
    return rest if found is None else found


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): the token sets that hold all tokens of a rule, by the inverted index."""
    words = sets.select("tokens", F.explode("tokens").alias("token"))
    seen = words.groupBy("token").agg(F.count("*").alias("n"))
    index = rules.select("tokens", F.explode("tokens").alias("token")).join(seen, "token")
    index = index.groupBy(F.col("tokens").alias("rule")).agg(
        F.min(F.struct("n", "token")).alias("rarest")
    )
    index = written(index.select("rule", F.col("rarest.token").alias("token")), "index")
    found = words.join(index, "token").filter(F.size(F.array_except("rule", "tokens")) == 0)
    return found.groupBy("tokens").agg(F.min(F.array_join("rule", " ")).alias("mined"))


def judge(
    pages: DataFrame,
    labels: DataFrame | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: list[tuple[str, str, str]] = RULES,
    support: float = SUPPORT,
    least: int = LEAST,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, mined (items of a mined rule).

    A mined rule's items are parted by blanks, the interchangeable tokens of an item by ``|``.

    ``labels`` has doc_id and quality (0 or 1; the lowest counts if a document has several).
    A NULL url, or one without ``://``, has an empty host and path. URLs that no given rule
    fits are blocked if a mined rule matches and allowed otherwise; without labelled URLs
    nothing is mined. Repeated rows come back as often as they are there, an empty table gives
    no rows, other columns are left behind.
    """
    rows = documents(pages, id_col, url_col).select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")
    )
    rows = rows.select("id", host_of("url").alias("host"), path_of("url").alias("path"))
    rows = rows.withColumns({"given": fitting_rule(rules), "tokens": tokens(), "doc": document_of()})
    rows = written(rows, "urls")
    mined = None
    if labels is not None:
        known = labels.filter("doc_id is not null and quality is not null")
        known = known.groupBy(F.col("doc_id").cast("long").alias("doc")).agg(
            F.min("quality").alias("quality")
        )
        verdict = F.when(F.col("quality") == 0, BLOCK).otherwise(ALLOW)
        labelled = written(
            rows.join(known, "doc").select("tokens", verdict.alias("verdict")), "labelled-urls"
        )
        number = labelled.count()
        if number >= least:
            support = max(support, least / number)
            items = written(items_of(labelled, support * number), "items")
            numbered = labelled.withColumn("row", F.monotonically_increasing_id())
            marked = in_items(numbered, items, "row", "verdict")
            found = mine(marked.select(F.col("items").alias("tokens"), "verdict"), support, confidence)
            # equal token sets are matched once, however many URLs have them
            sets = rows.filter("given is null").select("tokens").distinct()
            sets = written(in_items(sets, items, "tokens"), "sets")
            held = sets.select(F.col("items").alias("tokens")).distinct()
            hits = matches(held, found).withColumnRenamed("tokens", "items")
            mined = written(sets.join(hits, "items").select("tokens", "mined"), "matched")
    if mined is None:
        rows = rows.withColumn("mined", F.lit(None).cast("string"))
    else:
        rows = rows.join(mined, "tokens", "left")
    open_case = F.when(F.col("mined").isNotNull(), BLOCK).otherwise(ALLOW)
    free = F.col("given").isNull()
    return rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("given.rule").alias("rule"),
        F.when(free, open_case).otherwise(F.col("given.verdict")).alias("verdict"),
        F.when(free, F.col("mined")).alias("mined"),
    )

import re

from pyspark.sql import functions as F

from tests.llm.helpers import SMALL, read, rows
from tickwright.llm import url_filter

SHOWN = ("page_id", "host", "path", "rule", "verdict")


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    found = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found[1])
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in url_filter.RULES
        if (host == h or host.endswith("." + h)) and found[2].startswith(p)
    ]
    return host, found[2], max(fits)[1:] if fits else None


def test_given_rules(spark):
    urls = [
        "http://X.NET?q",
        "http://x.net/?q",
        None,
        "",
        "no scheme.net/",
        "a://b.net/x://c",
        "http://a.example.net/en/q?z",
        "http://a.example.net/en",
        "http://notexample.net/en/",
        "https://EXAMPLE.com/de/#a",
        "http://www.org/fr#a",
        "http://www.org/free",
        "x://É.Net/",
        "http://net/",
        "http://a.net:80/",
        "http://a.example.com/DE/",
        "http://h.net/a\nb?c",
    ]
    cases = list(enumerate(urls)) + [(None, "http://x.net/"), (1, urls[1])]
    pages = spark.createDataFrame(cases, "page_id long, url string").withColumns(
        {"tokens": F.lit(1), "given": F.lit(2), "host": F.lit("h"), "doc": F.lit("d")}
    )
    expected = []
    for page, url in cases:
        host, path, rule = by_hand(url)
        expected.append((page, host, path, rule[0] if rule else None, rule[1] if rule else "allow"))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert rows(url_filter.judge(pages), *SHOWN) == sorted(expected, key=key)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_the_four_rules_of_the_contract(spark):
    cases = {
        "http://x.net/": ("net/", "block"),
        "http://example.net/en/1": ("example.net/en/", "allow"),
        "http://a.example.com/de/": ("example.com/de/", "block"),
        "http://www.org/fr/": ("org/fr/", "allow"),
        "http://www.org/fr/7.html": ("org/fr/", "allow"),
        "http://www.org/fr": (None, "allow"),
        "http://www.org/free": (None, "allow"),
        "http://www.org/france/fr/": (None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    found = url_filter.judge(pages).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in found} == dict(enumerate(cases.values()))


def test_table(spark):
    pages = read(spark, SMALL, "pages")
    found = url_filter.judge(pages, read(spark, SMALL, "labels")).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    assert len(found) == len(urls)
    for r in found:
        host, path, rule = by_hand(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert rule is None or r.verdict == rule[1]


def planted(spark):
    """Only bad-site pages in English are of low quality; either token alone tells little."""
    cases = [
        (i, f"http://{'bad' if i % 4 == 0 else 'good'}-site.example.org/{'en' if i % 3 else 'es'}/{i}.html")
        for i in range(1200)
    ]
    pages = spark.createDataFrame(cases, "page_id long, url string")
    marks = [(i, 0 if i % 4 == 0 and i % 3 else 1) for i in range(600)] + [(None, 0), (1, None)]
    return pages, spark.createDataFrame(marks, "doc_id long, quality int")


def test_mined_combination_blocks_the_rest(spark):
    pages, labels = planted(spark)
    found = url_filter.judge(pages, labels, confidence=0.9).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == {
        i for i in range(1200) if i % 4 == 0 and i % 3
    }
    assert all(len(r.mined.split()) == 2 for r in found if r.mined)


def test_a_combination_of_four_tokens_blocks(spark):
    """Of sixteen kinds of pages one is of low quality, as often as each differing in one token is not."""
    kinds = [(a, b, c, d) for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)]
    cases = []
    for i in range(1600):
        a, b, c, d = kinds[i % 16]
        host = f"{'bad' if a else 'good'}.site.{'com' if b else 'edu'}"
        cases.append((i, f"http://{host}/{'shop' if c else 'news'}/{'old' if d else 'new'}/{i}.html"))
    pages = spark.createDataFrame(cases, "page_id long, url string")
    low = {i for i in range(1600) if i % 16 == 15}
    marks = spark.createDataFrame([(i, 0 if i in low else 1) for i in range(800)], "doc_id long, quality int")
    found = url_filter.judge(pages, marks, confidence=0.9).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == low
    assert {len(r.mined.split()) for r in found if r.mined} == {4}


def test_only_rules_without_a_shorter_one_are_mined(spark):
    marks = [("block" if i % 3 == 0 else "allow") for i in range(300)]
    words = [["a", "b", "c", "d", "e"] if m == "block" else ["c", "d", "e"] for m in marks]
    labelled = spark.createDataFrame(list(zip(words, marks)), "tokens array<string>, verdict string")
    found = url_filter.mine(labelled, 0.1, 0.9).collect()
    assert sorted((r.tokens, r.confidence) for r in found) == [(["a"], 1.0), (["b"], 1.0)]
    assert url_filter.mine(labelled.filter("verdict = 'allow'"), 0.1, 0.9).isEmpty()


def plain_rules(labelled, least, confidence):
    """Every combination of up to four tokens, tried; the sure ones without a shorter sure one."""
    from itertools import combinations

    tokens = sorted({t for own, _ in labelled for t in own})
    found = []
    for size in range(1, 5):
        for combo in map(set, combinations(tokens, size)):
            verdicts = [v for own, v in labelled if combo <= set(own)]
            blocked = verdicts.count("block")
            sure = blocked >= least and len(verdicts) >= least and blocked / len(verdicts) >= confidence
            if sure and not any(f <= combo for f in found):
                found.append(combo)
    return found


def test_verdicts_are_those_of_all_combinations(spark):
    """The miner with merged tokens blocks what a search through all combinations blocks."""
    import random

    rng = random.Random(3)
    hosts = ["bad-shop.com", "shop.com", "bad.edu"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['a/b', 'a/c', 'c'])}/{i}" for i in range(400)]
    low = [("bad" in u and "/a/" in u and rng.random() < 0.9) or rng.random() < 0.05 for u in urls]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if low[i] else 1) for i in range(300)], "doc_id long, quality int")
    found = {r.page_id: r for r in url_filter.judge(pages, labels, support=0.05, confidence=0.7, rules=[]).collect()}
    frame = pages.select("page_id", url_filter.host_of("url").alias("host"), url_filter.path_of("url").alias("path"))
    tokens = {r.page_id: r.tokens for r in frame.select("page_id", url_filter.tokens().alias("tokens")).collect()}
    rules = plain_rules([(tokens[i], "block" if low[i] else "allow") for i in range(300)], 20, 0.7)
    assert rules
    blocked = {i for i in range(400) if any(r <= set(tokens[i]) for r in rules)}
    assert {i for i, r in found.items() if r.verdict == "block"} == blocked != set()


def test_forty_common_segments_are_mined_in_seconds(spark):
    """One host whose URLs share forty segments: not 2^40 combinations."""
    import time

    deep = "/".join(f"s{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(40))
    cases = [(i, f"http://deep.example.edu/{deep}/{i}") for i in range(200)]
    cases += [(200 + i, f"http://plain.example.edu/x/{200 + i}") for i in range(200)]
    cases += [(400, "http://other.example.edu/sab/400")]
    pages = spark.createDataFrame(cases, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(400)], "doc_id long, quality int")
    began = time.monotonic()
    found = {r.page_id: r for r in url_filter.judge(pages, labels, rules=[], confidence=0.9).collect()}
    assert time.monotonic() - began < 60
    # each of the merged tokens is a rule by itself
    assert {i for i, r in found.items() if r.verdict == "block"} == {*range(200), 400}
    assert len(found[400].mined.split()) == 1 and "p:sab" in found[400].mined.split("|")


def test_few_labels_give_no_rules(spark):
    pages, labels = planted(spark)
    found = url_filter.judge(pages, labels.filter("doc_id < 30"), confidence=0.9)
    assert found.filter("verdict = 'block'").isEmpty()
    assert url_filter.judge(pages, labels.limit(0)).filter("mined is not null").isEmpty()


def test_matches_are_those_of_a_full_comparison(spark):
    sets = [["a", "b"], ["a", "c"], ["b", "c", "d"], ["e"], []]
    rules = [["a", "b"], ["c"], ["d", "e"]]
    frame = spark.createDataFrame([(s,) for s in sets], "tokens array<string>")
    mined = spark.createDataFrame([(r,) for r in rules], "tokens array<string>")
    expected = sorted((s, min(" ".join(r) for r in rules if set(r) <= set(s)))
                      for s in sets if any(set(r) <= set(s) for r in rules))
    assert rows(url_filter.matches(frame, mined)) == expected

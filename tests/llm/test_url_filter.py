import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from aerolith.llm import url_filter


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:n], rest[n:]
    m = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:m]


def rule(host, path):
    best = None
    for kind, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    return best or (None, None)


def brute_scores(urls, order):
    """Witten-Bell models of all orders, character by character."""
    counts = {k: defaultdict(Counter) for k in ("allow", "block")}
    for url in urls:
        kind = rule(*parts(url))[1]
        if kind:
            padded = url_filter.START * order + url
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    counts[kind][padded[i - k : i]][padded[i]] += 1

    def probability(kind, context, character):
        lower = 1 / 1114112 if not context and context != "" else None
        lower = probability(kind, context[1:], character) if context else 1 / 1114112
        seen = counts[kind].get(context)
        return (seen[character] + len(seen) * lower) / (sum(seen.values()) + len(seen)) if seen else lower

    out = {}
    for url in set(urls):
        padded = url_filter.START * order + url
        logs = [
            math.log(probability("allow", padded[i - order : i], padded[i]) / probability("block", padded[i - order : i], padded[i]))
            for i in range(order, len(padded))
        ]
        out[url] = sum(logs) / len(logs) if logs else 0.0
    return out


ODD = [
    None, "", "no scheme/en", "http://", "HTTP://WWW.Example.ORG/es/x", "http://example.org/en/1", "http://example.org/en/2",
    "http://notorg/", "http://org/", "http://org", "http://a.org?x=/es/", "http://x.com/fr/1#a?b", "http://x.com/de/?q",
    "http://éx.org/ü", "a://b://c.org/", "http://example.org/es/\nline", "http://user@x.com:80/de/",
]


def check(df, order):
    rows = [(r.page_id, r.url) for r in df.collect()]
    scores = brute_scores([u or "" for _, u in rows], order)
    found = {}
    for r in url_filter.judge(df, order=order).collect():
        found.setdefault(r.page_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    labelled, free = [], []
    for page_id, url in rows:
        for r in found[page_id]:
            host, path = parts(url)
            name, kind = rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, name), url
            assert abs(r.score - scores[url or ""]) < 1e-9, url
            (labelled if kind else free).append((r.score, r.verdict, kind))
            assert kind is None or r.verdict == kind
    # One threshold parts the free urls, and it serves the labelled ones as well as any other.
    allowed = [s for s, v, _ in free if v == "allow"]
    blocked = [s for s, v, _ in free if v == "block"]
    assert not allowed or not blocked or max(blocked) < min(allowed)
    return labelled, free


def test_pages_of_the_test_table(spark):
    labelled, free = check(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), order=4)
    assert len(free) > 5 and {k for _, _, k in labelled} == {"allow", "block"}


def test_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(ODD)] + [(40, ODD[4]), (40, ODD[4]), (None, "http://q.com/fr/")]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id long, url string, gram string, score double")
    check(df, order=2)
    assert url_filter.judge(df.limit(0)).collect() == []


def test_one_class_alone_allows_all(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/")], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(df).collect()} == {"allow"}


def test_threshold_separates_labelled_urls(spark):
    rows = [("u1", "allow", 2, 0.9), ("u2", "allow", 1, 0.4), ("u3", "block", 3, -0.2), ("u4", "block", 1, 0.1), ("u5", None, 9, 5.0)]
    t = url_filter.calibrated(spark.createDataFrame(rows, "url string, label string, copies long, score double"))
    assert 0.1 < t <= 0.4
    assert F.lit(t) is not None


def test_a_url_of_a_million_characters(spark):
    """Its characters' rows don't carry it along; astral characters count as one."""
    rows = [(1, "https://a.org/" + "x" * 60), (2, "https://b.com/de/" + "y" * 60), (3, "data:" + "ab\U0001f600" * 330_000), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(found) == 5 and found[3].rule is None and found[3].verdict in ("allow", "block")
    assert found[1].verdict == "allow" and found[2].verdict == "block" and found[4].score == found[5].score == 0
    grams = url_filter._grams(df.where("page_id = 3").select("page_id", "url"), "url", 4)
    assert grams.columns == ["page_id", "gram"] and grams.count() == 5 + 990_000
    assert {len(r.gram) for r in grams.distinct().collect()} == {5}

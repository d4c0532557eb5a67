"""URL filter by the ratio of two character language models, below fixed rules.

Rules name a host, with its subdomains, and a path prefix; the longest that fits decides.  All
other urls are judged by two variable-order Markov models, of urls that rules allow and of urls
that rules block: each character's probability is that after the ``order`` characters before
it, smoothed with those of all shorter contexts (Witten-Bell).  The models are tables of counts
over all labelled urls, which Spark gathers, joins and keeps; nothing of them passes through the
driver.  A url's score is the mean difference of log-likelihoods per character.  It is allowed
if that is at least the threshold at which fewest labelled urls are judged wrongly, each class
counting the same; the search is over a histogram of a fixed number of bins.

A null url, or one without ``://``, has empty host and path, and no rule fits it.  A null or empty
url has score 0.  Without labelled urls of both classes the threshold is 0 and so is every
score: all are allowed.  Repeated rows are judged alike and each counts; columns other than
page_id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import stored

# Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
START, BINS = "\u0002", 400


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as host and path prefix in one string, and its verdict; null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grams(rows: DataFrame, text: str, order: int) -> DataFrame:
    """The other columns of ``rows`` and ``gram`` for each position of ``text``: its character behind the ``order`` before it.

    The text itself isn't carried along: a row for each of its characters would hold the square of its length.
    """
    letters = F.split(F.concat(F.lit(START * order), F.col(text)), "")
    rows = rows.withColumn("_letters", F.when(F.length(text) > 0, letters)).drop(text)
    parts = ", ".join(f"_letters[_i + {k}]" for k in range(order + 1))
    last = f"size(_letters) - {order + 1}"
    grams = F.expr(f"transform(sequence(0, {last}), _i -> concat({parts}))")
    return rows.withColumn("gram", F.explode(F.when(F.col("_letters").isNotNull(), grams))).drop("_letters")


def _key(url: Column) -> list[Column]:
    """128 bits that stand for a url beside each of its characters."""
    return [F.xxhash64(url).alias("_a"), F.xxhash64(F.lit("url"), url).alias("_b")]


def model(urls: DataFrame, order: int) -> DataFrame:
    """gram, d: log P(last character | those before) of the allowed less the blocked model, for every gram of all urls.

    ``urls`` has ``url`` (not null) and ``label`` (allow, block or null).
    """
    allow, block = (F.sum((F.col("label") == k).cast("long")).alias(f"n_{k}") for k in ("allow", "block"))
    full = _grams(urls.select("url", "label"), "url", order).groupBy("gram").agg(allow, block)
    full = stored(full.select("gram", F.coalesce("n_allow", F.lit(0)).alias("n_allow"), F.coalesce("n_block", F.lit(0)).alias("n_block")), "url-grams")
    below = None
    for k in range(order + 1):
        short = F.substring("gram", order + 1 - k, k + 1) if k < order else F.col("gram")
        counts = full.groupBy(short.alias("g")).agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
        if k == 0:
            # Below single characters all code points are equally likely.
            counts = counts.withColumn("c", F.lit("")).withColumns({f"p_{m}": F.lit(1.0 / 1114112) for m in ("allow", "block")})
        else:
            counts = counts.withColumn("c", F.expr(f"substring(g, 1, {k})")).withColumn("s", F.expr(f"substring(g, 2, {k})"))
            counts = counts.join(below, "s")
        context = Window.partitionBy("c")  # at most one row a different next character
        probabilities = {}
        for m in ("allow", "block"):
            n, total = F.col(f"n_{m}"), F.sum(f"n_{m}").over(context)
            kinds = F.sum((F.col(f"n_{m}") > 0).cast("long")).over(context)
            smoothed = (n + kinds * F.col(f"p_{m}")) / (total + kinds)
            probabilities[f"q_{m}"] = F.when(total > 0, smoothed).otherwise(F.col(f"p_{m}"))
        counts = counts.select("g", *[v.alias(name) for name, v in probabilities.items()])
        below = counts.select(F.col("g").alias("s"), F.col("q_allow").alias("p_allow"), F.col("q_block").alias("p_block"))
    return stored(counts.select(F.col("g").alias("gram"), F.log(F.col("q_allow") / F.col("q_block")).alias("d")), "url-model")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of ``pages``."""
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, label = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "url", "host", "path", rule.alias("rule"), label.alias("label"))
    urls = rows.groupBy("url", "label").agg(F.count("*").alias("copies"))
    weighed = rows.select("url", "label")
    differences = model(weighed, order)
    keyed = urls.select("*", *_key(F.col("url")))
    scored = _grams(keyed.select("_a", "_b", "url"), "url", order).join(differences, "gram")
    scored = scored.groupBy("_a", "_b").agg(F.avg("d").alias("score"))
    urls = keyed.join(scored, ["_a", "_b"], "left").drop("_a", "_b").withColumn("score", F.coalesce("score", F.lit(0.0)))
    urls = stored(urls, "url-scores")
    threshold = calibrated(urls)
    kept = rows.join(urls.select("url", "score"), "url")
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return kept.select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), "score")


def calibrated(urls: DataFrame) -> float:
    """The bin edge with the least sum of both classes' shares of wrong verdicts; 0 without both classes."""
    span = urls.where("label is not null").agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if span.low is None or span.high <= span.low:
        return 0.0
    width = (span.high - span.low) / BINS
    place = F.least(F.floor((F.col("score") - span.low) / width), F.lit(BINS - 1)).cast("int")
    rows = urls.where("label is not null").groupBy("label", place.alias("bin")).agg(F.sum("copies").alias("n")).collect()
    counts = {kind: [0] * BINS for kind in ("allow", "block")}
    for row in rows:  # at most two rows a bin
        counts[row.label][row.bin] = row.n
    good, bad = sum(counts["allow"]), sum(counts["block"])
    if not good or not bad:
        return 0.0
    lost, caught, edges = 0, 0, []
    for i in range(BINS + 1):
        edges.append((lost / good + (bad - caught) / bad, i))
        if i < BINS:
            lost, caught = lost + counts["allow"][i], caught + counts["block"][i]
    least = min(e for e, _ in edges)
    ties = [i for e, i in edges if e == least]
    return span.low + width * (ties[0] + ties[-1]) / 2

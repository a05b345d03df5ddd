"""URL filters: rules first, then a character language-model ratio for the rest.

URLs that a rule accepts or rejects train two variable-order Markov models of characters. A
character's probability after its context is smoothed down the orders (Witten-Bell): the context
of n characters gives count / (total + types) and passes types / (total + types) to n - 1. A URL's
score is the difference of the two log-likelihoods, divided by its length. One in five of the
URLs that a rule decides is kept out of the training and calibrates the threshold: the score
that separates accepted from rejected ones best, both classes weighing the same.

Models are tables of grams and contexts, made by aggregation and read by joins; each distinct
window of characters is scored once. Only 4 totals and the score histogram reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import lower_ascii
from salesmart.session import materialise


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)
ORDER = 5
ALPHABET = 256
HOLD_OUT = 5
BINS = 20_000
HEAVY = 1000


def with_parts(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, ruled``; the longest rule that fits decides."""
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    parts = pages.select(
        F.col("page_id").alias("page_id"),
        F.col("url").cast("string").alias("url"),
    ).withColumn("_rest", F.coalesce(rest, F.lit("")))
    parts = parts.select(
        "page_id",
        "url",
        lower_ascii(F.regexp_extract("_rest", r"^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    name, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        host = F.col("host")
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name, ruled = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(ruled)
    return parts.select("*", name.alias("rule"), ruled.alias("ruled"))


def windows(url: Column, order: int) -> Column:
    """For every character: itself after up to ``order - 1`` characters before it."""
    n = F.length(url)
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.substring(url, F.greatest(i - order + 1, F.lit(1)), F.least(i, F.lit(order))),
        ),
    ).otherwise(F.array().cast("array<string>"))


def gram_counts(urls: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Counts of grams in accepted and rejected ``urls`` (url, ruled), and totals of contexts."""
    seen = (
        urls.select("ruled", F.explode(windows(F.col("url"), order)).alias("w"))
        .groupBy("w")
        .agg(
            F.count(F.when(F.col("ruled") == "allow", 1)).alias("a"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("b"),
        )
    )
    suffixes = F.transform(F.sequence(F.lit(1), F.length("w")), lambda n: F.right(F.col("w"), n))
    grams = materialise(
        seen.select(F.explode(suffixes).alias("gram"), "a", "b")
        .groupBy("gram")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b")),
        "url-grams",
    )
    contexts = (
        grams.groupBy(F.expr("left(gram, length(gram) - 1)").alias("context"))
        .agg(
            F.sum("a").alias("total_a"),
            F.sum("b").alias("total_b"),
            F.count(F.when(F.col("a") > 0, 1)).alias("types_a"),
            F.count(F.when(F.col("b") > 0, 1)).alias("types_b"),
        )
    )
    return grams, materialise(contexts, "url-contexts")


def window_scores(wanted: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """``w, diff``: log-likelihood difference of the last character of each distinct ``w``."""
    # The empty context belongs to every window: its four totals are literals, not a hot join key.
    empty = contexts.filter(F.col("context") == "").first()
    totals = empty.asDict() if empty else {}

    orders = F.transform(
        F.sequence(F.lit(1), F.length("w")),
        lambda n: F.struct(n.alias("n"), F.right(F.col("w"), n).alias("gram")),
    )
    steps = (
        wanted.select("w", F.explode(orders).alias("o"))
        .select("w", F.col("o.n").alias("n"), F.col("o.gram").alias("gram"))
        .withColumn("context", F.expr("CASE WHEN n > 1 THEN left(gram, n - 1) END"))
        .join(grams, "gram", "left")
        .join(contexts, "context", "left")
    )

    def part(kind: str) -> Column:
        total = F.when(F.col("n") == 1, F.lit(totals.get(f"total_{kind}", 0))).otherwise(F.col(f"total_{kind}"))
        types = F.when(F.col("n") == 1, F.lit(totals.get(f"types_{kind}", 0))).otherwise(F.col(f"types_{kind}"))
        weight = F.coalesce(total, F.lit(0)) + F.coalesce(types, F.lit(0))
        # A context that the class never had passes everything down.
        return F.struct(
            F.when(weight > 0, F.coalesce(F.col(kind), F.lit(0)) / weight).otherwise(0.0).alias("own"),
            F.when(weight > 0, types / weight).otherwise(1.0).alias("passed"),
        )

    def log_likelihood(kind: str) -> Column:
        return F.log(
            F.aggregate(
                F.sort_array(F.collect_list(F.struct("n", part(kind).alias("p")))),
                F.lit(1.0 / ALPHABET),
                lambda p, step: step["p"]["own"] + step["p"]["passed"] * p,
            )
        )

    return steps.groupBy("w").agg((log_likelihood("a") - log_likelihood("b")).alias("diff"))


def calibrated(scores: DataFrame) -> float:
    """The threshold on ``score`` that separates ``ruled`` allow from block best.

    From a histogram over the scores' own range, in ``BINS`` steps: its size does not follow the
    number of rows. The threshold lies between the greatest score of a step and the least of the next.
    """
    span = scores.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if span.low is None:
        return 0.0
    step = (span.high - span.low) / BINS or 1.0
    bins = (
        scores.groupBy(F.floor((F.col("score") - span.low) / step).alias("bin"))
        .agg(
            F.count(F.when(F.col("ruled") == "allow", 1)).alias("good"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("bad"),
            F.min("score").alias("least"),
            F.max("score").alias("most"),
        )
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(b.good for b in bins), sum(b.bad for b in bins)
    if not good or not bad:
        return 0.0
    best, threshold, passed_good, passed_bad = -1.0, 0.0, good, bad
    for at, b in enumerate(bins):
        right = passed_good / good + (bad - passed_bad) / bad
        if right > best:
            best, threshold = right, (bins[at - 1].most + b.least) / 2 if at else b.least
        passed_good, passed_bad = passed_good - b.good, passed_bad - b.bad
    return threshold


def filter_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages`` (page_id, url).

    A rule's verdict stands; otherwise a URL is allowed if its score reaches the threshold.
    Null URLs and those without ``://`` have an empty host and path and no rule; null and empty
    URLs score 0. Without examples of both classes every score is 0 and so is the threshold.
    Repeated URLs count once in training; of a very long URL every character is scored. Rows with equal
    or null page_id are rows like others. An empty table gives an empty result. Other columns are not read.
    """
    parsed = with_parts(pages, rules)
    urls = materialise(
        parsed.filter(F.length("url") > 0).groupBy("url").agg(F.first("ruled").alias("ruled")), "urls"
    )
    held = F.pmod(F.xxhash64("url"), F.lit(HOLD_OUT)) == 0
    decided = F.col("ruled").isNotNull()
    classes = {r.ruled for r in urls.filter(decided & ~held).select("ruled").distinct().collect()}
    if classes != {"allow", "block"}:
        return _verdicts(parsed.withColumn("score", F.lit(0.0)), 0.0)

    grams, contexts = gram_counts(urls.filter(decided & ~held), order)
    places = urls.filter(~decided | held).select(
        "url", "ruled", F.length("url").alias("n"), F.explode(windows(F.col("url"), order)).alias("w")
    )
    seen = materialise(places.groupBy("w").agg(F.count("*").alias("_n")), "url-places")
    diffs = materialise(window_scores(seen.select("w"), grams, contexts), "url-windows")
    # A window like that of `https://` may stand in every URL: those with more than one part in HEAVY of
    # all places, at most HEAVY of them, go to all tasks, and only the others are joined by shuffle.
    total = seen.agg(F.sum("_n")).first()[0] or 0
    heavy = diffs.join(seen.filter(F.col("_n") > total / HEAVY).select("w"), "w", "left_semi")
    marked = places.join(F.broadcast(heavy), "w", "left")
    rest = marked.filter(F.col("diff").isNull()).drop("diff").join(diffs, "w")
    scored = materialise(
        marked.filter(F.col("diff").isNotNull()).unionByName(rest)
        .groupBy("url", "ruled", "n")
        .agg(F.sum("diff").alias("_sum"))
        .select("url", "ruled", (F.col("_sum") / F.col("n")).alias("score")),
        "url-scores",
    )
    threshold = calibrated(scored.filter(decided))
    return _verdicts(
        parsed.join(scored.filter(~decided).select("url", "score"), "url", "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0))),
        threshold,
    )


def _verdicts(scored: DataFrame, threshold: float) -> DataFrame:
    by_score = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score"
    )

"""URL verdicts: host and path rules first, and a character language-model ratio for the rest.

Two variable-order Markov models, of the URLs that rules allow and of those they block, give each
character a probability from its last ORDER characters, falling back smoothly on shorter contexts
where longer ones are rare. A URL's score is the mean difference of the log-probabilities. The
threshold comes from the rules' own URLs, each scored by models that did not count its fold: it
balances both kinds of error. All of it is DataFrame operations.

A null URL, or one without ``://``, has an empty host and path and no score; without a score, or
where rules allow and block nothing to learn from, a URL is allowed. Repeated rows and URLs get equal
verdicts. An empty table gives an empty result. URLs of any length are scored whole, in linear time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import stored

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 5
PRIOR = 2.0
ALPHABET = 256
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
START, END = "\u0002", "\u0003"
BUCKETS_PER_NAT, MOST_BUCKETS = 50, 500
_SIDES = ("allow", "block")
_LEFT_OUT = (None, 0, 1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def windows_of(text: Column) -> Column:
    """Each character of the text and its end, with the ORDER characters before."""
    chars = F.split(F.concat(F.lit(START * ORDER), text, F.lit(END)), "")
    return F.transform(
        F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.array_join(F.slice(chars, i, F.lit(ORDER + 1)), "")
    )


def _counts(prefix: str, of: str = "") -> list[Column]:
    return [F.sum(f"{of}{s}{f}").alias(f"{prefix}{s}{f}") for s in _SIDES for f in (0, 1)]


def window_ratios(texts: DataFrame) -> DataFrame:
    """Log-probability ratio of every window: by all counts, and without those of either fold."""
    grams = texts.select(F.explode(windows_of(F.col("text"))).alias("gram"), *[f"{s}{f}" for s in _SIDES for f in (0, 1)])
    full = stored(grams.groupBy("gram").agg(*_counts("")), "url-windows")
    chance = {(s, out): F.lit(1.0 / ALPHABET) for s in _SIDES for out in _LEFT_OUT}
    joined = full.select("gram")
    for k in range(ORDER + 1):
        suffix = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = full.groupBy(suffix.alias(f"g{k}")).agg(*_counts(f"c{k}"))
        context = full.groupBy(F.substring("gram", ORDER + 1 - k, k).alias(f"x{k}")).agg(*_counts(f"n{k}"))
        joined = joined.join(seen, F.expr(f"substring(gram, {ORDER + 1 - k}, {k + 1}) = g{k}"))
        joined = joined.join(context, F.expr(f"substring(gram, {ORDER + 1 - k}, {k}) = x{k}"))
        for s in _SIDES:
            for out in _LEFT_OUT:
                c, n = (
                    reduce(Column.__add__, [F.col(f"{what}{k}{s}{f}") for f in (0, 1) if f != out]) for what in "cn"
                )
                chance[s, out] = (c + PRIOR * chance[s, out]) / (n + PRIOR)
    ratios = [
        F.log(chance["allow", out] / chance["block", out]).alias("all" if out is None else f"without{out}")
        for out in _LEFT_OUT
    ]
    return joined.select("gram", *ratios)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # The models see numbers as such, not their digits.
    text = F.translate(F.concat("host", "path"), DIGITS, "0" * 10)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("ruled"), text.alias("text"))
    fold = F.pmod(F.xxhash64("text"), F.lit(2))
    sides = [
        F.count(F.when((F.col("ruled") == s) & (fold == f), 1)).alias(f"{s}{f}") for s in _SIDES for f in (0, 1)
    ]
    texts = stored(ruled.where("text != ''").groupBy("text").agg(*sides), "url-texts")
    per_window = texts.select("text", F.explode(windows_of(F.col("text"))).alias("gram"))
    means = [F.avg(c).alias(c) for c in ("all", "without0", "without1")]
    scores = stored(
        per_window.join(window_ratios(texts), "gram").groupBy("text").agg(*means).join(texts, "text"), "url-scores"
    )
    known = scores.where(" + ".join(f"{s}{f}" for s in _SIDES for f in (0, 1)) + " > 0")
    least = threshold(known)
    scored = ruled.join(scores.select("text", F.col("all").alias("score")), "text", "left")
    guess = F.when(F.coalesce(F.col("score"), F.lit(float("inf"))) >= least, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"), "score")


def threshold(known: DataFrame) -> float:
    """Where the rates of both errors, over the rules' URLs, add up to least."""
    unseen = F.when(fold_of_counts() == 0, F.col("without0")).otherwise(F.col("without1"))
    bucket = F.greatest(F.lit(-MOST_BUCKETS), F.least(F.lit(MOST_BUCKETS), F.floor(unseen * BUCKETS_PER_NAT)))
    counted = known.groupBy(bucket.alias("bucket")).agg(
        F.sum(F.expr("allow0 + allow1")).alias("allow"), F.sum(F.expr("block0 + block1")).alias("block")
    )
    # At most 2 * MOST_BUCKETS + 1 rows.
    rows = sorted(tuple(r) for r in counted.collect())
    n_allow, n_block = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not n_allow or not n_block:
        return float("-inf") if n_allow or not n_block else 0.0
    found, below_allow, below_block = [], 0, 0
    for bucket_no, allow, block in rows:
        wrong = below_allow / n_allow + (n_block - below_block) / n_block
        found.append((wrong, abs(bucket_no), bucket_no))
        below_allow, below_block = below_allow + allow, below_block + block
    return min(found)[2] / BUCKETS_PER_NAT


def fold_of_counts() -> Column:
    return F.when(F.expr("allow0 + block0") > 0, 0).otherwise(1)

"""URL verdicts: rules by host and path, and for the rest a character language-model ratio.

A rule fits the hosts it names and all their subdomains if the url's path starts with
the rule's; the longest fitting rule decides. Urls without a rule are judged by two
variable-order Markov models of characters, one of the urls that rules allow and one of
those that rules block. The chance of a character after a context of n characters is

    p_n(c | context) = (count(context c) + w * p_{n-1}(c | shorter context)) / (count(context) + w)

from an even chance over ``LETTERS`` characters up to contexts of ``ORDER - 1``: long
contexts decide where they were seen, short ones elsewhere. Counts are of all urls with
a rule except a quarter taken by hash, on which the threshold for the length-normalised
difference of the log-likelihoods is calibrated (least sum of the two error rates, on a
histogram).

Only DataFrame functions are used. All counts follow from one table: the distinct runs
of ``ORDER`` characters of all urls with their numbers in allowed and in blocked urls,
aggregated map-side. Its size follows the alphabet, not the urls. It becomes a table of
log-ratios per run, which the urls' runs are joined with; only sums per url are shuffled
after that where the table is small enough to be broadcast by Spark's own check.

Defined cases: a null url or one without ``://`` has empty host and path and no rule; a
null or empty url has ratio zero and is judged by the threshold alone; without urls of
both kinds to learn from, urls without a rule are allowed; equal urls are scored once
and repeated rows get a row each; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import staged

ORDER = 4
WEIGHT = 2.0
LETTERS = 128.0
#: Of the urls with a rule, one in this many calibrates the threshold.
CALIBRATE = 4
#: Steps of the histogram of scores per unit, and its range.
STEPS, RANGE = 50, 8
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (rule, verdict), null without one."""
    found = None
    for name, prefix, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        hit = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found


def _runs(url: Column) -> Column:
    """For each character of the url (the scheme apart) the ``ORDER`` characters up to it; blanks come before."""
    body = F.regexp_replace(url, r"(?s)^.*?://", "")
    chars = F.filter(F.split(body, ""), lambda c: c != "")
    padded = F.concat(F.array_repeat(F.lit(" "), ORDER - 1), chars)
    places = F.filter(F.sequence(F.lit(0), F.size(chars)), lambda i: i > 0)
    return F.transform(places, lambda i: F.array_join(F.slice(padded, i, ORDER), ""))


def _log_ratios(runs: DataFrame, totals: dict[str, float]) -> DataFrame:
    """Columns (run, ratio): log p_allow - log p_block of the run's last character after the others."""

    def chance(kind: str) -> Column:
        p = F.lit(1 / LETTERS)
        for n in range(1, ORDER + 1):
            with_char = F.sum(kind).over(Window.partitionBy(F.substring("run", ORDER - n + 1, n)))
            context = F.lit(totals[kind])
            if n > 1:
                context = F.sum(kind).over(Window.partitionBy(F.substring("run", ORDER - n + 1, n - 1)))
            p = (with_char + WEIGHT * p) / (context + WEIGHT)
        return F.log(p)

    return runs.select("run", (chance("allow") - chance("block")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """Where the error rates of the calibration urls sum to the least, of equals nearest zero."""
    step = F.floor(F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), "log_ratio")) * STEPS).cast("int")
    rows = scored.select("verdict", step.alias("step")).groupBy("verdict", "step").agg(F.count(F.lit(1)).alias("n"))
    count = {(r["verdict"], r["step"]): r["n"] for r in rows.collect()}  # a row per step and verdict at most
    of = {v: sum(n for (w, _), n in count.items() if w == v) for v in ("allow", "block")}
    errors, refused, passed = [], 0, of["block"]
    for s in range(-RANGE * STEPS, RANGE * STEPS + 2):  # urls below step s are blocked
        errors.append((refused / max(1, of["allow"]) + passed / max(1, of["block"]), abs(s), s))
        refused += count.get(("allow", s), 0)
        passed -= count.get(("block", s), 0)
    return min(errors)[2] / STEPS


def url_scores(urls: DataFrame) -> tuple[DataFrame, float] | None:
    """Columns (url, log_ratio) of the urls without a verdict, and the threshold.

    ``urls`` has distinct urls and the verdict of their rule or null. None if there are not
    urls of both verdicts to learn from.
    """
    # few bytes, much work: more tasks than the size of the table asks for
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = staged(urls.repartition(tasks), "urls")
    part = F.pmod(F.xxhash64("url"), F.lit(CALIBRATE))
    known = urls.select("url", "verdict", (F.col("verdict").isNotNull() & (part > 0)).alias("learnt"))
    places = known.select("url", "verdict", "learnt", F.explode(_runs(F.col("url"))).alias("run"))
    kinds = [
        F.sum(F.when(F.col("learnt") & (F.col("verdict") == v), 1.0).otherwise(0.0)).alias(v) for v in ("allow", "block")
    ]
    runs = staged(places.groupBy("run").agg(*kinds), "url-runs")
    totals = runs.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in ("allow", "block")]).first().asDict()
    if not all(totals.values()):
        return None
    asked = places.where(~F.col("learnt")).join(_log_ratios(runs, totals), "run")
    scored = staged(asked.groupBy("url", "verdict").agg(F.avg("ratio").alias("log_ratio")), "url-scores")
    return scored.where("verdict is null").select("url", "log_ratio"), _threshold(scored.where("verdict is not null"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """A row per row of ``pages``: page_id, host, path, rule, verdict, log_ratio (without a rule)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    named = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    named = named.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    learnt = url_scores(named.select("url", F.col("hit.verdict").alias("verdict")).distinct())
    if learnt:
        scores, least = learnt
        named = named.join(scores, "url", "left")
        ratio = F.when(F.col("hit").isNull(), F.coalesce("log_ratio", F.lit(0.0)))
    else:
        least, ratio = 0.0, F.when(F.col("hit").isNull(), F.lit(0.0))
    judged = F.when(ratio >= least, "allow").otherwise("block")
    return named.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", judged).alias("verdict"),
        ratio.alias("log_ratio"),
    )

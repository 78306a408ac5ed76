"""URL filters: explicit rules, then an empirical-Bayes reputation of the host.

The reputation shrinks labelled page outcomes (bad or not) through beta
priors along host -> registered domain -> suffix -> all pages.  No outcome
counts twice: a group's prior comes from its parent without the group.

With b bad of n pages in a group, B of N in its parent, and the parent's own
prior of mean p and weight w (all pages: mean 1/2, weight 1):

    W = N - n + w                       what is known of the parent besides the group
    prior mean   = (B - b + w p) / W
    prior weight = 1 / (1/M + 1/W)      M: strength of the level

and at the host: posterior mean q = (b + weight * mean) / (n + weight), lower
bound q - z sqrt(q (1 - q) / (n + weight + 1)).  The strength M of a level is
estimated from the spread of the rates among the groups of one parent (method
of moments for the beta-binomial); where no parent has several groups, that of
the level above holds (``STRENGTH_MIN`` at the top).  A host is blocked if its
lower bound is above a limit: a few pages never suffice by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: (rule, verdict); a rule is host + path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MAX_BAD_RATE = 0.5
Z = 1.645                                # one-sided 95 % bound
STRENGTH_MIN, STRENGTH_MAX = 2.0, 1000.0
LEVELS = ("suffix", "domain", "host")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the host or a parent domain of it and whose path begins the path."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rule_path = rule.partition("/")
        fits = (((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels (as there is no public suffix list here)."""
    return F.substring_index(host, ".", -2)


def _strength(groups: DataFrame, parent: list[str], above: float) -> float:
    """Strength of one level: (1 - rho) / rho with the analysis-of-variance estimate of rho; ``above`` without replication.

    ``groups(..., bad, n)`` has one row per group.  Some sums reach the driver.
    """
    means = groups.groupBy(*parent).agg(F.sum("bad").alias("p_bad"), F.sum("n").alias("p_n"),
                                        F.sum(F.col("n") * F.col("n")).alias("p_nn"), F.count(F.lit(1)).alias("p_k"))
    rate, mean = F.col("bad") / F.col("n"), F.col("p_bad") / F.col("p_n")
    between = F.sum(F.col("n") * (rate - mean) * (rate - mean))
    within = F.sum(F.col("n") * rate * (1 - rate))
    joined = groups.join(means, parent)
    b, w, n, k = joined.agg(between, within, F.sum("n"), F.count(F.lit(1))).first()
    parents, spread = means.agg(F.count(F.lit(1)), F.sum(F.col("p_nn") / F.col("p_n"))).first()
    if not n or k <= parents or n <= k:
        return above
    size = (n - spread) / (k - parents)
    b, w = b / (k - parents), w / (n - k)
    rho = (b - w) / (b + (size - 1) * w) if b + (size - 1) * w > 0 else 0.0
    return min(STRENGTH_MAX, max(STRENGTH_MIN, (1 - rho) / rho)) if rho > 0 else STRENGTH_MAX


def host_reputation(outcomes: DataFrame, max_bad: float = MAX_BAD_RATE, z: float = Z) -> DataFrame:
    """``outcomes(host, bad)``, bad 0 or 1, one row per labelled page -> ``(r_host, posterior, lower, blocked)``.

    Rows with a null host or outcome are left out.  One row per host comes
    back; counting is map-side, so a host with a third of all pages is one
    partial row per task.
    """
    hosts = (outcomes.where("host is not null and bad is not null").groupBy("host")
             .agg(F.sum("bad").cast("double").alias("bad"), F.count(F.lit(1)).cast("double").alias("n"))
             .withColumn("domain", domain_of(F.col("host")))
             .withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("everything", F.lit(1)))
    keys, parent, strength = ["everything"], ["everything"], STRENGTH_MIN
    prior = hosts.groupBy("everything").agg(F.sum("bad").alias("p_bad"), F.sum("n").alias("p_n")).select(
        "*", F.lit(0.5).alias("p_mean"), F.lit(1.0).alias("p_weight"))
    for level in LEVELS:
        keys = keys + [level]
        groups = hosts.groupBy(*keys).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        strength = _strength(groups, parent, strength)
        known = F.col("p_n") - F.col("n") + F.col("p_weight")
        mean = (F.col("p_bad") - F.col("bad") + F.col("p_weight") * F.col("p_mean")) / known
        prior = groups.join(prior, parent).select(
            *keys, F.col("bad").alias("p_bad"), F.col("n").alias("p_n"), mean.alias("p_mean"),
            (1 / (1 / F.lit(strength) + 1 / known)).alias("p_weight"))
        parent = keys
    weight = F.col("p_n") + F.col("p_weight")
    q = (F.col("p_bad") + F.col("p_weight") * F.col("p_mean")) / weight
    return (prior.select(F.col("host").alias("r_host"), q.alias("posterior"), weight.alias("weight"))
            .withColumn("lower", F.col("posterior") - z * F.sqrt(F.col("posterior") * (1 - F.col("posterior")) / (F.col("weight") + 1)))
            .select("r_host", "posterior", "lower", (F.col("lower") > max_bad).alias("blocked")))


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """``(host, bad)`` of the labelled pages: the last number of a page's path is the id of its document.

    Bad: low quality or toxic.  Pages without such a number or label give nothing.
    """
    number = F.regexp_extract(url_path(F.col(url_col)), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    ids = pages.select(url_host(F.col(url_col)).alias("host"), F.when(number != "", number.cast("long")).alias("l_id"))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l_id"))
             .agg(F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int"))
                  .alias("bad")))
    return ids.join(marks, "l_id").where("host <> ''").select("host", "bad")


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules=RULES, max_bad: float = MAX_BAD_RATE, z: float = Z) -> DataFrame:
    """``(id, host, path, rule, verdict, posterior)`` per page.

    Null urls and urls without ``://``: host and path are empty, no rule fits,
    the verdict is allow.  A host without labelled pages has no posterior and
    is allowed.  The page side of the join is split by AQE where a host is hot.
    """
    seen = host_reputation(page_outcomes(pages, labels, url_col), max_bad, z)
    rows = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.lit(None).cast("string")
    for rule, verdict in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    own = F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return (rows.join(seen, rows.host == seen.r_host, "left")
            .select(id_col, "host", "path", "rule", F.coalesce(said, own).alias("verdict"), "posterior"))

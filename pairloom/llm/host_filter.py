"""URL filter: fixed rules first, then the host's reputation by empirical Bayes.

Pages that a rule judges are the labelled outcomes (allowed is good). Per host they
are binomial counts; hosts of one registered domain share a beta prior around the
domain's rate, domains one around their suffix's, suffixes one around the rate of all.
How strongly each level holds its members together is estimated from the counts by the
method of moments. A page without a rule is allowed if the lower posterior bound of its
host's rate reaches the threshold.

All DataFrame functions. Defined results: a null url, or one without `://`, has an empty
host and path, which is a host like any other; without any labelled page the rate of
all is a half. The longest rule that fits wins; of equals the first given.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import HOT_ROWS, meet_groups
from pairloom.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRENGTHS = (1.0, 1000.0)
UNKNOWN_STRENGTH = 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does.

    `rules` are pairs of a verdict and a rule such as `example.org/es/`.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built from the inside: what comes last is asked first.
    for said, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = (host == rule_host) | host.endswith("." + rule_host)
        fits = fits & path.startswith(slash + rule_path)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _shrunk(groups: DataFrame, prior: Column) -> DataFrame:
    """`groups` (n, good) with `a` and `b` of the posterior around `prior`.

    The prior's strength makes the groups' spread as wide as what is seen.
    """
    groups = groups.withColumn("_prior", prior)
    spread = F.col("good") / F.col("n") - F.col("_prior")
    seen = groups.filter("n > 0").agg(
        F.count(F.lit(1)), F.sum(F.col("n") - 1),
        F.sum(F.col("n") * spread * spread / (F.col("_prior") * (1 - F.col("_prior")))),
    ).first()
    count, more, wide = (float(x or 0) for x in seen)
    least, most = STRENGTHS
    if not more:
        strength = UNKNOWN_STRENGTH
    elif wide <= count:
        strength = most
    else:
        strength = min(max(more / (wide - count) - 1, least), most)
    return groups.withColumns({
        "a": F.col("good") + strength * F.col("_prior"),
        "b": F.col("n") - F.col("good") + strength * (1 - F.col("_prior")),
    }).drop("_prior")


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, rows, a, b) of each host from columns host and good (null: not labelled)."""
    hosts = outcomes.groupBy("host").agg(
        F.count(F.lit(1)).alias("rows"), F.count("good").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    # The registered domain is taken to be the last two labels, the suffix the last.
    hosts = materialize(hosts.withColumns({
        "domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)}))
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = materialize(hosts.groupBy("suffix", "domain").agg(*sums))
    suffixes = materialize(domains.groupBy("suffix").agg(*sums))
    n, good = suffixes.agg(*sums).first()
    rate = F.lit(((good or 0) + 1.0) / ((n or 0) + 2.0))

    def upper(groups, key):
        return groups.select(key, (F.col("a") / (F.col("a") + F.col("b"))).alias("_rate"))

    suffixes = materialize(_shrunk(suffixes, rate))
    domains = materialize(_shrunk(domains.join(upper(suffixes, "suffix"), "suffix"), F.col("_rate")).drop("_rate"))
    return materialize(_shrunk(hosts.join(upper(domains, "domain"), "domain"), F.col("_rate")).select(
        "host", "rows", "a", "b"))


def judge_urls(pages: DataFrame, rules, url_col="url", threshold=0.5, z=1.0, hot_rows=HOT_ROWS) -> DataFrame:
    """`pages` with host, path, rule, verdict (allow or block) and bound.

    Columns of these names are replaced; all others stay, whatever they are called.
    """
    kept = pages.drop("host", "path", "rule", "verdict", "bound")
    # What is known of the host goes beside the page's columns under names that none of them has.
    mark = "_of_host"
    while any(c.lower().endswith(mark) for c in kept.columns):
        mark += "_"
    rows, a, b = (name + mark for name in ("rows", "a", "b"))
    host, path = host_and_path(F.col(url_col))
    split = kept.withColumns({"host": host, "path": path})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "verdict": verdict})
    good = F.when(F.col("verdict") == "allow", 1).when(F.col("verdict") == "block", 0)
    reputation = host_reputation(ruled.select("host", good.alias("good"))).withColumnsRenamed(
        {"rows": rows, "a": a, "b": b})
    judged = meet_groups(ruled, reputation, "host", rows, hot_rows)
    mean = F.col(a) / (F.col(a) + F.col(b))
    bound = mean - z * F.sqrt(mean * (1 - mean) / (F.col(a) + F.col(b) + 1))
    method = F.when(bound >= threshold, "allow").otherwise("block")
    return judged.select(*kept.columns, "host", "path", "rule",
                         F.coalesce("verdict", method).alias("verdict"), bound.alias("bound"))

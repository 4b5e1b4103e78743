"""URL filter by empirical-Bayes host reputation (DataFrame operations only).

Labelled page outcomes are counted per host.  Bad rates are shrunk level by
level, global -> suffix -> registered domain -> host, each level through a
beta-binomial prior centred on the level above, whose strength is estimated
from the over-dispersion of that level's groups.  A host is blocked if the
lower posterior bound of its bad rate lies above a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Public suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp",
                      "co.nz", "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "co.kr")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls.  ``rules`` is a
    configured list of (verdict, ``host/path``); a rule fits its host and all
    subdomains where the path starts with the rule's."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tried first
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def site_levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without user and port; an IPv4
    address or a single label is its own domain with an empty suffix."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    three = F.substring_index(name, ".", -3)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    alone = name.rlike(r"^[0-9.]+$") | ~name.contains(".") | (long & (three == two))
    domain = F.when(alone, name).when(long, three).otherwise(two)
    suffix = F.when(alone, F.lit("")).when(long, two).otherwise(F.substring_index(name, ".", -1))
    return domain, suffix


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from rows (n, k, parent): the moment estimate
    of the intra-group correlation rho of a beta-binomial, as 1/rho - 1."""
    var = F.col("parent") * (1 - F.col("parent"))
    excess = F.sum(F.pow(F.col("k") - F.col("n") * F.col("parent"), 2) / (F.col("n") * var))
    g, n, s = groups.where("n > 0").agg(F.count(F.lit(1)), F.sum("n"), excess).first()
    if not g or n <= g:
        return 4.0  # nothing to estimate it from
    return 1 / min(max((s - g) / (n - g), 0.01), 0.9) - 1


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior per host from (host, bad): one row per host with ``bad_rate``
    (posterior mean) and ``bound`` (its lower posterior bound, normal
    approximation of the beta quantile).  Rows with null ``bad`` are unlabelled
    and only make their host known.  Sums combine map-side, so a hot host does
    not gather in one task."""
    domain, suffix = site_levels(F.col("host"))
    hosts = cut_lineage(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
                        .select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix")))
    n, k = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn(
        "parent", F.lit((k + 0.5) / (n + 1.0)))
    for name, next_name in (("suffix", "domain"), ("domain", "host")):
        level = cut_lineage(level)
        a = _strength(level)
        above = level.select(name, ((a * F.col("parent") + F.col("k")) / (a + F.col("n"))).alias("parent"))
        below = hosts if next_name == "host" else hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        level = below.join(above, name)
    level = cut_lineage(level)
    a = _strength(level)
    alpha = a * F.col("parent") + F.col("k")
    total = a + F.col("n")
    mean = alpha / total
    return level.select("host", mean.alias("bad_rate"), (mean - z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
          url_col: str = "url", limit: float = 0.3) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``,
    ``verdict`` (the longest fitting rule's, else ``block`` if the host's lower
    bound exceeds ``limit``), ``bad_rate``, ``bound``.

    ``outcomes`` has (``id_col``, ``bad`` 0/1 or null).  Null urls and urls
    without ``://`` share the empty host; several outcomes of one id count as
    the worst; null ids have no outcome; repeated pages are judged alike and
    each counts; without any outcome all bounds are prior bounds.  Other
    columns of ``pages`` are not read.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    worst = outcomes.groupBy(F.col(id_col).alias("id")).agg(F.max("bad").alias("bad"))
    table = cut_lineage(reputation(urls.select("id", "host").join(worst, "id", "left")))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(table, "host", "left").select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "bad_rate", "bound")

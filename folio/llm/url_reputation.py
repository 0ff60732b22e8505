"""URL filters: explicit rules, then empirical-Bayes host reputation.  DataFrame functions only.

Labelled page outcomes (bad or not) are counted per host, registered domain
and suffix.  Each level's counts are beta-binomial around the level above:
the suffix around the overall rate, the domain around its suffix's posterior
mean, the host around its domain's.  A level's prior strength comes from the
moments of all its groups: with expected rate m and n outcomes each,

    rho = (sum (k - n m)^2 - sum n m (1 - m)) / sum n (n - 1) m (1 - m),

kept within ``RHO``, and the prior weighs 1 / rho - 1 outcomes.  A page is
blocked if the lower bound of its host's posterior bad rate, mean minus ``z``
standard deviations, is above ``max_bad``; unlabelled hosts have their
domain's posterior as prior, and so on upwards.

Defined cases: a null URL, or one without ``://``, has an empty host and
path; it fits no rule and has the reputation of the empty host.  A host's
user and port are left out of its reputation.  Null outcomes are unlabelled;
of several outcomes of a page the worst counts; repeated page rows count
each.  Without any outcome the overall rate is that of the prior,
``EMPTY_RATE``.  Extra columns are dropped.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Suffixes of two labels under which names are registered (fixed values; a parameter of ``host_levels``).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
RHO = (0.001, 0.5)
EMPTY_RATE = 0.1
MAX_BAD, Z = 0.3, 1.645


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or end."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null.

    ``rules``: (``host/path``, ``allow`` or ``block``), a short configured
    list.  Of equally long rules that fit, block wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block", r[0])):  # the last match is the longest
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_levels(host: Column, two_label_suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column, Column]:
    """(host without user and port, registered domain, suffix)."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    is_two = two.isin(*two_label_suffixes)
    suffix = F.when(is_two, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(is_two, F.substring_index(name, ".", -3)).otherwise(two)
    return name, domain, suffix


def _strength(groups: DataFrame) -> float:
    """How many outcomes the prior of ``groups`` (n, k, m) weighs."""
    v = F.col("m") * (1 - F.col("m"))
    over, most = groups.agg(F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) - F.col("n") * v), F.sum(F.col("n") * (F.col("n") - 1) * v)).first()
    rho = min(max((over or 0.0) / most if most else 0.0, RHO[0]), RHO[1])
    return 1 / rho - 1


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``name, lower_bad`` for a table of ``name, domain, suffix, n, k`` (outcomes and bad ones of each host)."""
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    hosts = materialise(hosts, "hosts")
    domains = materialise(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = materialise(domains.groupBy("suffix").agg(*counts), "suffixes")
    n, k = suffixes.agg(F.sum("n"), F.sum("k")).first()
    rate = k / n if n else EMPTY_RATE
    mean = lambda weight: ((F.col("k") + weight * F.col("m")) / (F.col("n") + weight))
    groups = suffixes.withColumn("m", F.lit(rate))
    above = groups.select("suffix", mean(_strength(groups)).alias("m"))
    groups = materialise(domains.join(above, "suffix"), "domains-in-suffix")
    above = groups.select("domain", mean(_strength(groups)).alias("m"))
    groups = materialise(hosts.drop("suffix").join(materialise(above, "domain-means"), "domain"), "hosts-in-domain")
    weight = _strength(groups)
    a, b = F.col("k") + weight * F.col("m"), F.col("n") - F.col("k") + weight * (1 - F.col("m"))
    return groups.select("name", a.alias("a"), b.alias("b")).select("name", (F.col("a") / (F.col("a") + F.col("b")) - Z * F.sqrt(F.col("a") * F.col("b") / (F.pow(F.col("a") + F.col("b"), 2) * (F.col("a") + F.col("b") + 1)))).alias("lower_bad"))


def judge_pages(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], max_bad: float = MAX_BAD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, lower_bad.

    ``pages``: page_id, url; ``outcomes``: page_id, bad (0 or 1).
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    worst = outcomes.filter("bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, domain, suffix = host_levels(F.col("host"))
    rows = parsed.join(worst, "page_id", "left").select("page_id", "host", "path", "bad", name.alias("name"), domain.alias("domain"), suffix.alias("suffix"))
    rows = materialise(rows, "pages")
    hosts = rows.groupBy("name", "domain", "suffix").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
    reputation = materialise(host_reputation(hosts), "reputation")
    found = longest_rule(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("lower_bad") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(reputation, "name").withColumn("found", found).select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce(F.col("found.verdict"), judged).alias("verdict"), "lower_bad")

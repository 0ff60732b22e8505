import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.url_reputation import MAX_BAD, RHO, Z, judge_pages, longest_rule, url_host, url_path

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("host", T.StringType()), T.StructField("n", T.StringType())])
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def cut(url):
    """(host, path), character by character."""
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:stop]


def rule_of(host, path):
    fits = [(r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


URLS = [None, "", "no scheme", "://", "http://", "HTTP://Ex.ORG", "http://a.example.org/es/x?q#f", "https://example.org/es", "x://com/fr/", "x://notcom/fr/", "x://a.b.com/fr/1://z", "x://ÄÖ.Com?p/de/", "x://a.com#/de/", "x://a.com/de/é", "a://b\nc.org/", "//a://b/c"]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    for r in df.select("*", longest_rule(F.col("h"), F.col("p"), RULES).alias("f")).collect():
        assert (r.h, r.p) == cut(r.url), r.url
        assert ((r.f.rule, r.f.verdict) if r.f else (None, None)) == rule_of(r.h, r.p)


def plain_bounds(pages, outcomes):
    """The lower bound of each page's host, from the definitions."""
    bad = {}
    for i, b in outcomes:
        if b is not None:
            bad[i] = max(b, bad.get(i, 0))
    level = lambda h: (h.rsplit("@")[-1].split(":")[0],)
    hosts = {}
    for i, u in pages:
        name = level(cut(u)[0])[0]
        n, k = hosts.get(name, (0, 0))
        hosts[name] = (n + (i in bad), k + bad.get(i, 0))
    parts = {name: (".".join(name.split(".")[-2:]), name.split(".")[-1]) for name in hosts}

    def gather(key):
        out = {}
        for name, (n, k) in hosts.items():
            a, b = out.get(key(name), (0, 0))
            out[key(name)] = (a + n, b + k)
        return out

    def weight(groups, mean):
        over = sum((k - n * mean[g]) ** 2 - n * mean[g] * (1 - mean[g]) for g, (n, k) in groups.items())
        most = sum(n * (n - 1) * mean[g] * (1 - mean[g]) for g, (n, k) in groups.items())
        return 1 / min(max(over / most if most else 0, RHO[0]), RHO[1]) - 1

    n, k = map(sum, zip(*hosts.values()))
    s = gather(lambda h: parts[h][1])
    m = dict.fromkeys(s, k / n)
    w = weight(s, m)
    s_mean = {g: (b + w * m[g]) / (a + w) for g, (a, b) in s.items()}
    d = gather(lambda h: parts[h][0])
    m = {g: s_mean[g.split(".")[-1]] for g in d}
    w = weight(d, m)
    d_mean = {g: (b + w * m[g]) / (a + w) for g, (a, b) in d.items()}
    m = {h: d_mean[parts[h][0]] for h in hosts}
    w = weight(hosts, m)
    out = {}
    for h, (n, k) in hosts.items():
        a, b = k + w * m[h], n - k + w * (1 - m[h])
        out[h] = a / (a + b) - Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return out


def test_verdicts_against_definitions(spark):
    r = random.Random(3)
    hosts = [("bad.evil.net", 0.95), ("www.evil.net", 0.8), ("good.net", 0.05), ("a.shop.org", 0.1), ("User@shop.net:80", 0.2), ("rare.io", 0.5)]
    pages, outcomes = [], []
    for i in range(600):
        h, rate = hosts[min(int(r.expovariate(0.9)), 5)]
        pages.append((i, f"http://{h}/{r.choice(['de', 'es', 'fr'])}/{i}"))
        if r.random() < 0.7:
            outcomes.append((i, int(r.random() < rate)))
    pages += [(700 + k, u) for k, u in enumerate(URLS)] + [(5, pages[5][1]), (900, "http://new.evil.net/x"), (901, "http://unseen.tv/"), (None, "http://good.net/")]
    outcomes += [(1, None), (3, 1), (3, 0), (5, 1), (12345, 1)]
    df = spark.createDataFrame([(*p, "h", "clash", "clash") for p in pages], PAGES)
    got = judge_pages(df, spark.createDataFrame(outcomes, "page_id long, bad int"), RULES).collect()
    assert len(got) == len(pages)
    bound = plain_bounds(pages, outcomes)
    urls = dict(pages)
    for row in got:
        host, path = cut(urls[row.page_id])
        rule, verdict = rule_of(host, path)
        lower = bound[host.rsplit("@")[-1].split(":")[0]]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert math.isclose(row.lower_bad, lower, rel_tol=1e-9)
        assert row.verdict == (verdict or ("block" if lower > MAX_BAD else "allow"))
    judged = {x.host: x.verdict for x in got if x.rule is None}
    assert judged["bad.evil.net"] == "block" and judged["new.evil.net"] == "block" and judged["good.net"] == "allow"


def test_empty_tables(spark):
    pages, none = spark.createDataFrame([], PAGES), spark.createDataFrame([], "page_id long, bad int")
    assert judge_pages(pages, none, RULES).count() == 0
    (r,) = judge_pages(spark.createDataFrame([(1, "http://a.b/", None, None, None)], PAGES), none, RULES).collect()
    assert (r.host, r.path, r.rule, r.verdict) == ("a.b", "/", None, "allow")


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", None, None, None)], PAGES)
    plan = judge_pages(pages, spark.createDataFrame([(1, 1)], "page_id long, bad int"), RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))

import re

import pytest

from aerolake.llm import url_filter
from aerolake.llm.queries import URL_RULES

URLS = [("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.org", "x.org", "", None, None), ("http://shop.com/fr/?q", "shop.com", "/fr/", "com/fr/", "allow"),
        ("http://shop.com/de/a/b#/fr/", "shop.com", "/de/a/b", "com/de/", "block"),
        ("http://shop.com/fr", "shop.com", "/fr", None, None), ("http://org/a", "org", "/a", "org/", "allow"),
        ("http://x.orga/a", "x.orga", "/a", None, None), ("no scheme org/", "", "", None, None), (None, "", "", None, None),
        ("", "", "", None, None), ("a://b?c://d/e", "b", "", None, None), ("u://h.com:80/de/", "h.com:80", "/de/", None, None),
        ("x\ny://q.org/\nz", "q.org", "/\nz", "org/", "allow"), ("http://É.ORG/x", "É.org", "/x", "org/", "allow")]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge(pages, none, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")


def test_levels(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"),
             "com": ("com", "com"), "": ("", ""), "me@h.net:80": ("h.net", "net")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = url_filter.levels(df.host)
    assert {r.host: (r.d, r.s) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == hosts


def brute(rows, z=1.645):
    """The same estimate in plain Python."""
    def level(host, kind):
        parts = re.sub(r":\d*$", "", host.split("@")[-1]).split(".")
        size = 2 if len(parts) >= 3 and len(parts[-1]) == 2 and parts[-2] in url_filter.SECOND_LEVEL else 1
        return ".".join(parts[-(size + (kind == "domain")):])

    def strength(groups):
        groups = [g for g in groups if g[0]]
        noise, total = sum(n * p * (1 - p) for n, _, p in groups), sum(n for n, _, _ in groups)
        if not groups or total == len(groups) or not noise:
            return url_filter.WEAKEST
        spread = sum(n * (b / n - p) ** 2 for n, b, p in groups)
        rho = (spread * total / noise - len(groups)) / (total - len(groups))
        return round(1 / min(max(rho, 1 / (url_filter.STRONGEST + 1)), 1 / (url_filter.WEAKEST + 1)) - 1, 6)

    def count(key):
        out = {}
        for h, b in rows:
            n, k = out.get(key(h), (0, 0))
            out[key(h)] = (n + (b is not None), k + (b or 0))
        return out
    hosts = count(lambda h: h)
    n, b = sum(x for x, _ in hosts.values()), sum(x for _, x in hosts.values())
    prior = {h: (b + 0.5) / (n + 1) for h in hosts}
    for kind in ("suffix", "domain"):
        groups = count(lambda h: level(h, kind))
        above = {level(h, kind): prior[h] for h in hosts}
        k = strength([(*groups[g], above[g]) for g in groups])
        mean = {g: (x + k * above[g]) / (m + k) for g, (m, x) in groups.items()}
        prior = {h: mean[level(h, kind)] for h in hosts}
    k = strength([(*hosts[h], prior[h]) for h in hosts])
    out = {}
    for h, (m, x) in hosts.items():
        a, c = x + k * prior[h], m - x + k * (1 - prior[h])
        out[h] = (m, x, a / (a + c), a / (a + c) - z * (a * c / ((a + c) ** 2 * (a + c + 1))) ** 0.5)
    return out


def test_reputation_matches_brute_force(spark):
    rows = [(f"h{i % 7}.site{i % 3}.{('com', 'net', 'co.uk')[i % 3]}", (i * 7 % 5 == 0) * 1 if i % 4 else None) for i in range(400)]
    rows += [("evil.site0.com", 1)] * 60 + [("", None), ("new.site1.net", None)]
    got = {r.host: (r.n, r.bad, r["mean"], r.low) for r in
           url_filter.reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h], abs=1e-6)
    assert got["evil.site0.com"][3] > 0.5 > got["new.site1.net"][3]


def test_bad_hosts_are_blocked_but_rules_win(spark):
    pages = [(i, f"http://evil{i % 2}.net/x{i}") for i in range(60)] + [(i, "http://good.net/") for i in range(60, 400)]
    pages += [(900, "http://evil0.net/"), (901, "http://sub.evil.org/"), (902, None), (60, "http://good.net/")]
    outcomes = [(i, 1) for i in range(60)] + [(i, 0) for i in range(60, 400)] + [(61, 0), (5, 0)]
    got = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"),
                           spark.createDataFrame(outcomes, "page_id long, bad int"), URL_RULES).collect()
    verdicts = {r.page_id: r.verdict for r in got}
    assert len(got) == len(pages) and verdicts[900] == verdicts[0] == "block"
    assert verdicts[70] == verdicts[901] == verdicts[902] == "allow"


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, spark.createDataFrame([], "page_id long, bad int"), URL_RULES).collect() == []

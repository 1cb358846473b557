import math
from collections import defaultdict

import pytest

from siltstone.llm import urls
from siltstone.llm.queries import RULES
from tests.llm.cases import prose

PAGES = "page_id long, url string, html string, host int, verdict string"


def pages_of(spark, addresses):
    return spark.createDataFrame([(k, u, None, 1, "x") for k, u in enumerate(addresses)], PAGES)


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://Example.COM/en/x?y": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://a.www.example.com/en/b#c": ("a.www.example.com", "/en/b", "www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "https://example.com": ("example.com", "", None, "allow"),
        "https://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "https://x.net/ES/1": ("x.net", "/ES/1", None, "allow"),
        "//x.net/es/1": ("", "", None, "allow"),
        "a://b?c://d/e": ("b", "", None, "allow"),
        "\nq://É.net/fr/\n?": ("É.net", "/fr/\n", "net/fr/", "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    outcomes = spark.createDataFrame([("q.org", False)] * 3, "host string, bad boolean")
    found = urls.judge(pages_of(spark, [*cases, *cases]), outcomes, RULES).collect()
    assert len(found) == 2 * len(cases)
    assert {r["page_id"]: tuple(r)[1:5] for r in found} == dict(enumerate([*cases.values(), *cases.values()]))


def expected(outcomes, hosts):
    """Posterior means and lower bounds, level by level."""
    def parts(h):
        labels = h.split(":")[0].split(".")
        n = 2 if ".".join(labels[-2:]) in urls.LONG_SUFFIXES else 1
        return ".".join(labels[-n - 1:]), ".".join(labels[-n:])

    n, bad = defaultdict(int), defaultdict(int)
    for h, b in outcomes:
        if h is not None and b is not None:
            n[h] += 1
            bad[h] += b
    names = {h for h in {*hosts, *n} if h is not None}
    up = {("h", h): ("d", parts(h)[0]) for h in names} | {("d", parts(h)[0]): ("s", parts(h)[1]) for h in names}
    count = defaultdict(lambda: [0, 0])
    for h in names:
        for unit in (("h", h), ("d", parts(h)[0]), ("s", parts(h)[1])):
            count[unit][0] += n[h]
            count[unit][1] += bad[h]
    mean = {None: (sum(bad.values()) + 0.5) / (sum(n.values()) + 1)}
    for level in "sdh":
        units = [u for u in count if u[0] == level]
        prior = {u: mean[up.get(u)] for u in units}
        over = sum((count[u][1] - count[u][0] * prior[u]) ** 2 - count[u][0] * prior[u] * (1 - prior[u]) for u in units)
        under = sum(count[u][0] * (count[u][0] - 1) * prior[u] * (1 - prior[u]) for u in units)
        k = 10_000.0 if not under or over <= 0 else min(max(under / over - 1, 1.0), 10_000.0)
        mean |= {u: (k * prior[u] + count[u][1]) / (k + count[u][0]) for u in units}
    return {h: (mean["h", h], mean["h", h] - 1.645 * math.sqrt(mean["h", h] * (1 - mean["h", h]) / (k + n[h] + 1))) for h in names}


def test_reputations(spark, no_broadcast):
    words = prose(3, 400, 30)
    outcomes = [(f"{w.strip(',.')}.{'bad' if k % 3 else 'good'}.{'co.uk' if k % 2 else 'org'}", k % 3 > 0 and k % 7 > 0) for k, w in enumerate(words)]
    outcomes += [(None, True), ("q.org", None), ("bad.org:80", True)]
    hosts = [f"new{k}.bad.co.uk" for k in range(3)] + ["new.good.org", "", "localhost"]
    frame = urls.reputations(
        spark.createDataFrame(outcomes, "host string, bad boolean"), spark.createDataFrame([(h,) for h in hosts * 2], "host string"))
    want = expected(outcomes, hosts)
    found = {r["host"]: (r["mean"], r["lower"]) for r in frame.collect()}
    assert set(found) >= set(want) - {"q.org"}
    for h in found:
        if h in want:
            assert found[h] == pytest.approx(want[h], abs=1e-9)
    assert found["new0.bad.co.uk"][0] > 0.5 > found["new.good.org"][0]


def test_registered_domains(spark):
    want = {
        "a.b.example.com": ("example.com", "com"), "www.shop.com.tr": ("shop.com.tr", "com.tr"), "x.or.jp": ("x.or.jp", "or.jp"),
        "a.shop.com.sg:80": ("shop.com.sg", "com.sg"), "me.github.io": ("me.github.io", "github.io"), "github.io": ("github.io", "github.io"),
        "a.b.c.kobe.jp": ("b.c.kobe.jp", "c.kobe.jp"), "x.city.kobe.jp": ("city.kobe.jp", "kobe.jp"), "a.www.ck": ("www.ck", "ck"),
        "a.b.xn--55qx5d.cn": ("b.xn--55qx5d.cn", "xn--55qx5d.cn"), "a.b.公司.cn": ("b.公司.cn", "公司.cn"),
        "a.b.nosuchsuffix": ("b.nosuchsuffix", "nosuchsuffix"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "10.2.3.4:8080": ("10.2.3.4", None), "[2001:db8::1]:80": ("[2001:db8::1]", None), "3.4": ("3.4", "4")}
    rows = spark.createDataFrame([(h, 2, 1) for h in want], "host string, n long, bad long")
    assert {r["host"]: tuple(r)[1:] for r in urls._levels(rows).collect()} == {h: (2, 1, *x) for h, x in want.items()}


def test_sites_under_one_suffix_or_network_are_not_pooled(spark, no_broadcast):
    outcomes = [(f"bad{k}.{s}", True) for k in range(3) for s in ("com.tr", "github.io") for _ in range(80)]
    outcomes += [(f"10.0.3.{k}", True) for k in range(3) for _ in range(80)] + [(f"good{k}.org", False) for k in range(40) for _ in range(40)]
    outcomes += [(f"good{k}.{s}", False) for k in range(6) for s in ("com.tr", "github.io") for _ in range(5)]
    hosts = ["a.good1.com.tr", "b.good2.github.io", "10.9.3.9", "a.bad1.com.tr", "bad1.github.io", "10.0.3.1:80", "10.0.3.1", "10.0.3.2"]
    pages = pages_of(spark, [f"http://{h}/" for h in hosts])
    found = {r["host"]: r["verdict"] for r in urls.judge(pages, spark.createDataFrame(outcomes, "host string, bad boolean")).collect()}
    assert found == dict(zip(hosts, ["allow", "allow", "allow", "block", "block", "allow", "block", "block"]))


def test_a_bad_host_is_blocked_and_a_small_sample_is_not(spark):
    outcomes = [("a.bad.org", True)] * 60 + [("good.net", False)] * 400 + [("new.net", True)]
    frame = spark.createDataFrame(outcomes, "host string, bad boolean")
    pages = pages_of(spark, ["http://a.bad.org/", "http://good.net/", "http://new.net/", "http://b.bad.org/"])
    found = {r["host"]: r["verdict"] for r in urls.judge(pages, frame).collect()}
    assert (found["a.bad.org"], found["good.net"], found["new.net"]) == ("block", "allow", "allow")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "host string, bad boolean")
    assert urls.judge(spark.createDataFrame([], PAGES), none, RULES).collect() == []
    assert [r["verdict"] for r in urls.judge(pages_of(spark, ["http://a.b/"]), none).collect()] == ["allow"]

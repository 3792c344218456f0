import random
import re

import pytest

from strandsieve.llm import urlfilter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def plain(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h) + len(p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [
    "http://a.net/x", "http://NET/", "http://net", "http://a.example.net/en/1", "http://example.net/fr", "http://xexample.com/de/1", "http://m.example.com/de/1?x#y", "http://example.com/den", "x.org/fr/1",
    "ftp://É.ORG/fr/É", "http://a.org?/fr/", "http://u:p@a.net:80/x", "a://b://c.net/", None, "", "://", "http://a.org/fr/#", "http://deep.er.example.net/en/", "http://nota.network/",
]


def pages(spark, *rows):
    return spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r, None)), "x", 1.0) for i, r in enumerate(rows)], "page_id long, url string, html string, host string, trust double")


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in urlfilter.judge_urls(pages(spark, *URLS)).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        if verdict:
            assert got[i].verdict == verdict


def brute(edges, seeds, steps=200, d=0.85):
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    rank = {h: (1 - d) * s for h, s in seeds.items()}
    for _ in range(steps):
        new = {h: (1 - d) * s for h, s in seeds.items()}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + d * rank.get(a, 0) * w / out[a]
        rank = new
    return rank


def test_ranks(spark):
    edges = {("a", "b"): 3, ("b", "c"): 1, ("b", "a"): 1, ("c", "a"): 2, ("x", "y"): 1}
    e = spark.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, weight long")
    s = spark.createDataFrame([("a", 1.0), ("x", 0.5)], "host string, seed double")
    got = {r.host: r.rank for r in urlfilter.propagate(e, s).collect()}
    want = brute(edges, {"a": 1.0, "x": 0.5})
    assert got == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_who_links_to_blocked_hosts_is_blocked(spark):
    bad, good = '<a href="https://Bad.net/x">', "<A HREF='//site.org/fr/'>"
    rows = [("http://spam.io/1", bad * 9), ("http://fine.io/1", good * 3 + bad), ("http://site.org/fr/1", '<a href="http://liked.io/">'), ("http://bad.net/1", ""), ("http://far.io/1", '<a href="http://spam.io/">'), ("http://liked.io/1", None)]
    got = {r.host: r for r in urlfilter.judge_urls(pages(spark, *rows)).collect()}
    assert got["spam.io"].verdict == "block"
    assert got["far.io"].verdict == "block"
    assert got["fine.io"].verdict == "allow"
    assert got["liked.io"].trust > 0
    assert got["liked.io"].verdict == "allow"


@pytest.mark.parametrize("linkers", [1, 3, 100, 10_000])
def test_verdicts_do_not_depend_on_how_many_link_to_a_blocked_host(spark, linkers):
    bad, other = '<a href="http://bad.net/x">', '<a href="http://other.io/">'
    rows = [("http://bad.net/1", None), *((f"http://spam{i}.io/", bad) for i in range(linkers)), *((f"http://mild{i}.io/", bad + other * 3) for i in range(linkers))]
    got = urlfilter.judge_urls(pages(spark, *rows)).where("host <> 'bad.net'").selectExpr("substr(host, 1, 4)", "verdict", "round(distrust, 6)").distinct().collect()
    assert sorted(tuple(r) for r in got) == [("mild", "allow", 0.031875), ("spam", "block", 0.1275)]


def test_verdicts_against_plain_sums(spark):
    rng = random.Random(8)
    hosts = ["bad.net", "example.net", "a.org", "b.org", "m.example.com", *[f"h{i}.io" for i in range(14)]]
    rows = []
    for _ in range(150):
        at = rng.randrange(len(hosts))
        to = [hosts[rng.randrange(at)] for _ in range(rng.randint(0, 4))] if at else []
        rows.append((f"http://{hosts[at]}/{rng.choice(['fr', 'en', 'de'])}/1", "".join(f'<a href="http://{h}/p">' for h in [*to, hosts[at]])))
    rows.append(("http://calm.io/1", ""))
    facts = [plain(url) for url, _ in rows]
    n, allowed, blocked, edges = {}, {}, {}, {}
    for (host, _, _, verdict), (_, html) in zip(facts, rows, strict=True):
        n[host] = n.get(host, 0) + 1
        for kind, seeds in (("allow", allowed), ("block", blocked)):
            seeds[host] = seeds.get(host, 0) + (verdict == kind)
        for dst in re.findall("http://([^/]*)/", html):
            if dst != host:
                edges[host, dst] = edges.get((host, dst), 0) + 1
    trust = brute(edges, {h: c / n[h] for h, c in allowed.items()})
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    back = {(b, a): w / out[a] for (a, b), w in edges.items()}
    distrust = {h: 0.15 * c / n[h] for h, c in blocked.items()}
    for _ in range(200):
        new = {h: 0.15 * c / n[h] for h, c in blocked.items()}
        for (b, a), share in back.items():
            new[a] += 0.85 * distrust.get(b, 0) * share
        distrust = new
    seen = set()
    for r in urlfilter.judge_urls(pages(spark, *rows)).collect():
        host, _, _, verdict = facts[r.page_id]
        t, d = trust.get(host, 0), distrust[host]
        assert (r.trust, r.distrust) == pytest.approx((t, d), rel=1e-4, abs=1e-6)
        judged = "block" if d >= 0.05 and d > t else "allow"
        assert r.verdict == (verdict or judged)
        seen.add((verdict is None, r.verdict))
    assert seen == {(True, "allow"), (True, "block"), (False, "allow"), (False, "block")}


def test_long_urls_and_tied_scores(spark):
    long = "http://" + "a" * 5000 + ".org/" + "b" * 200_000 + "?" + "c" * 200_000
    tied = '<a href="http://bad.net/"><a href="http://x.org/">'
    got = {r.page_id: r for r in urlfilter.judge_urls(pages(spark, (long, tied * 20_000), ("http://bad.net/", None), ("http://x.org/fr/", None), ("http://t1.io/", tied), ("http://t2.io/", tied))).collect()}
    assert (len(got[0].host), len(got[0].path), got[0].rule) == (5004, 200_001, None)
    assert got[3].distrust == got[4].distrust > urlfilter.THRESHOLD
    assert {got[i].verdict for i in (0, 3, 4)} == {"block"}


def test_no_python_in_the_plan(spark):
    plan = urlfilter.judge_urls(pages(spark, *URLS))._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan


def test_empty_table(spark):
    assert urlfilter.judge_urls(pages(spark, "http://a.b/").limit(0)).count() == 0

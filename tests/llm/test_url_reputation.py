"""Host reputation: rules against a plain version, shrinkage and its bound, edge rows. The query is compared with SQL."""

import re

from pyspark.sql import functions as F

from adtally.llm import url_reputation as u
from adtally.llm.queries import URL_RULES

URLS = [None, "", "no scheme/path", "http://", "https://net", "https://net/", "http://A.B.NET/x", "HTTP://EXAMPLE.NET/en/1?x=/fr/", "http://example.net/EN/1",
        "http://notexample.net/en/1", "http://x.org/fr/", "http://org/fr/a#b", "http://x.org/fr", "http://example.com/de/1", "http://sub.example.com/de/#",
        "http://example.com:80/de/1", "http://u@example.com/de/1", "http://example.net?/en/", "a://b://c.net/d", "http://É.NET/", "http://x.net\n/en/",
        "http://example.com/de", "//example.com/de/", "http://1.2.3.4/fr/", "http://a.b.co.uk/x", "http://a.b.co.uk:8080", "http://[::1]:80/x"]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [rule for _, rule in URL_RULES if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith("/" + rule.split("/", 1)[1])]
    return host, path, max(fits, key=len) if fits else None


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, x, None, "clash") for i, x in enumerate(URLS)], "page_id long, url string, html string, host string")
    rows = u.filter_urls(pages, URL_RULES, u.junk_outcome(F.col("html"))).select("row.page_id", "host", "path", "rule", "verdict").collect()
    verdicts = {rule: verdict for verdict, rule in URL_RULES}
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path, r.rule) == plain_url(URLS[r.page_id])
        assert r.verdict == verdicts.get(r.rule, "allow")


def test_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk:80", "co.uk", "www.example.com", "example.com.", "u@www.example.com:1", "localhost", "1.2.3.4", "[::1]:80", ""]
    domain, suffix = u.domain_and_suffix(F.col("host"))
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", domain.alias("d"), suffix.alias("s")).collect()
    assert [(r.d, r.s) for r in rows] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.com", "com"), ("example.com", "com"), ("example.com", "com"),
        ("localhost", "localhost"), ("1.2.3.4", ""), ("[::1]:80", "") if rows[8].d == "[::1]:80" else ("[::1]", ""), ("", "")]


def reputation(spark, counts):
    """{host: row} of hosts with (pages, junk pages)."""
    rows = [(host, int(i < junk)) for host, (n, junk) in counts.items() for i in range(n)] + [(host, None) for host in counts]
    return {r.host: r for r in u.host_reputation(spark.createDataFrame(rows, "host string, outcome int")).df.collect()}


def test_small_hosts_are_drawn_to_their_domain_and_large_ones_speak_for_themselves(spark):
    counts = {f"h{i}.bad.com": (20, 18) for i in range(10)} | {f"h{i}.good.com": (20, 0) for i in range(10)} | {
        "new.bad.com": (1, 0), "new.good.com": (1, 1), "alone.org": (0, 0)}
    found = reputation(spark, counts)
    assert found["new.bad.com"].rate > 0.5 > found["new.good.com"].rate
    found = reputation(spark, counts | {"big.good.com": (400, 380)})
    assert found["big.good.com"].bound > 0.8 and found["h1.bad.com"].bound > u.MAX_RATE > found["h1.good.com"].rate
    assert found["big.good.com"].rate - found["big.good.com"].bound < found["h1.bad.com"].rate - found["h1.bad.com"].bound
    assert (found["alone.org"].n, found["alone.org"].y) == (0, 0) and 0 < found["alone.org"].rate < 1


def test_equal_rates_give_the_strongest_prior_and_no_labels_allow(spark):
    assert len({round(r.rate, 9) for r in reputation(spark, {f"h{i}.x.com": (10, 1) for i in range(5)}).values()}) == 1
    assert all(r.rate == 0 and r.bound <= 0 for r in reputation(spark, {"a.com": (0, 0), "b.org": (0, 0)}).values())


def test_the_bound_holds_for_the_posterior(spark):
    import numpy as np
    draw = np.random.default_rng(1)
    for r in reputation(spark, {"a.x.com": (3, 3), "b.x.com": (30, 5), "c.y.org": (200, 150)}).values():
        sd = (r.rate - r.bound) / 3
        weight = r.rate * (1 - r.rate) / sd ** 2 - 1
        assert (draw.beta(r.rate * weight, (1 - r.rate) * weight, 100_000) < r.bound).mean() <= u.RISK


def test_a_bad_host_is_blocked_where_no_rule_fits(spark):
    junk, fine = "<p>" + "buy%%% now### " * 30, "<p>" + "plain words " * 30
    rows = [(f"http://spam.biz/{i}", junk) for i in range(40)] + [(f"http://ok{i}.com/", fine) for i in range(40)] + [("http://spam.biz/x", None), ("http://e.com/", "")]
    done = u.filter_urls(spark.createDataFrame(rows, "url string, html string"), (("allow", "spam.biz/3"),), u.junk_outcome(F.col("html"))).collect()
    assert {r.verdict for r in done if r.host == "spam.biz" and not r.path.startswith("/3")} == {"block"}
    assert {r.verdict for r in done if r.host != "spam.biz" or r.path.startswith("/3")} == {"allow"}


def test_empty_table(spark):
    assert u.filter_urls(spark.createDataFrame([], "url string, html string"), URL_RULES, u.junk_outcome(F.col("html"))).collect() == []

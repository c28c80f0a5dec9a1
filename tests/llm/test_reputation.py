import math

from pyspark.sql import functions as F

from ledgerloom.llm import reputation
from ledgerloom.llm.queries import URL_RULES
from ledgerloom.session import scratch_path


def _judged(spark, urls, outcomes):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)],
                                  "page_id bigint, url string, host string, verdict string")
    known = spark.createDataFrame(outcomes, "page_id bigint, bad boolean")
    return sorted(reputation.judge_urls(pages, known, URL_RULES, scratch_path(spark, "r")).collect(), key=lambda r: r.page_id)


def test_rules_and_parts(spark):
    urls = ["HTTP://WWW.Example.NET/en/x?q#f", "http://a.net/", "http://a.net", "http://example.com/de/1",
            "http://notexample.com/de/1", "http://x.org/fr/2?x", "http://ÄB.org?x=/fr/", None, "no scheme/net/", "a://b://c/d",
            "http://anet/", "http://h/pa\nth?x"]
    got = [(r.host, r.path, r.rule, r.verdict) for r in _judged(spark, urls, [])]
    assert got == [
        ("www.example.net", "/en/x", "example.net/en/", "allow"), ("a.net", "/", "net/", "block"),
        ("a.net", "", None, "allow"), ("example.com", "/de/1", "example.com/de/", "block"),
        ("notexample.com", "/de/1", None, "allow"), ("x.org", "/fr/2", "org/fr/", "allow"),
        ("Äb.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("b:", "//c/d", None, "allow"), ("anet", "/", None, "allow"), ("h", "/pa\nth", None, "allow")]


def test_shrinkage_against_a_plain_reckoning(spark):
    hosts = ["a.x.com"] * 40 + ["b.x.com"] * 3 + ["c.y.com"] * 30 + ["d.z.org"] * 10
    bad = [k % 10 < 9 if h == "a.x.com" else k % 15 == 0 for k, h in enumerate(hosts)]
    got = _judged(spark, [f"http://{h}/p" for h in hosts], [(k, b) for k, b in enumerate(bad)] + [(None, True), (999, True), (0, None)])

    def tally(level):
        out = {}
        for h, b in zip(hosts, bad):
            n, s = out.get(level(h), (0, 0))
            out[level(h)] = (n + 1, s + b)
        return out

    def shrink(units, mean_of):
        over = sum((s - n * mean_of(u)) ** 2 - n * mean_of(u) * (1 - mean_of(u)) for u, (n, s) in units.items())
        room = sum(n * (n - 1) * mean_of(u) * (1 - mean_of(u)) for u, (n, s) in units.items())
        weight = min(1000.0, max(1.0, 1 / (over / room) - 1 if over > 0 else 1000.0))
        return {u: (s + weight * mean_of(u)) / (n + weight) for u, (n, s) in units.items()}, weight

    all_mean = sum(bad) / len(bad)
    suffix, _ = shrink(tally(lambda h: h.split(".")[-1]), lambda u: all_mean)
    domain, _ = shrink(tally(lambda h: h.split(".", 1)[1]), lambda u: suffix[u.split(".")[-1]])
    own, weight = shrink(tally(lambda h: h), lambda u: domain[u.split(".", 1)[1]])
    counts = tally(lambda h: h)
    for row in got:
        share = own[row.host]
        bound = share - 1.645 * math.sqrt(share * (1 - share) / (counts[row.host][0] + weight + 1))
        assert math.isclose(row.bad_share, share, rel_tol=1e-9) and math.isclose(row.bad_bound, bound, rel_tol=1e-9)
        assert row.verdict == ("block" if bound > 0.25 else "allow")
    assert {r.host: r.verdict for r in got}["a.x.com"] == "block"


def test_registered_domains(spark):
    want = {"a.b.example.co.uk": ("example.co.uk", "co.uk"), "example.co.uk:8080": ("example.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
            "me@www.x.net:80": ("x.net", "net"), "x.net.": ("x.net", "net"), "x.net:": ("x.net", "net"), "one": ("one", "one"), "": ("", ""),
            "10.0.0.1:81": ("10.0.0.1", ""), "[::1]:80": ("[::1]", ""), "shop.com.br": ("shop.com.br", "com.br"), "b:": ("b", "b")}
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = reputation.registered(F.col("host"))
    assert {r[0]: (r[1], r[2]) for r in hosts.select("host", domain, suffix).collect()} == want


def test_a_public_suffix_is_no_domain(spark):
    """Bad pages of one name do not speak against another that shares only a public suffix with it."""
    urls = [f"http://www.bad.co.uk:{80 + k % 2}/{k}" for k in range(40)] + [f"http://good{k}.co.uk/{k}" for k in range(40)] + ["http://new.bad.co.uk/"]
    got = _judged(spark, urls, [(k, k < 40 or k == 80) for k in range(81)])
    assert {r.verdict for r in got if "bad.co.uk" in r.host and r.host != "new.bad.co.uk"} == {"block"}
    assert {r.verdict for r in got if "good" in r.host} == {"allow"}


def test_empty(spark):
    assert _judged(spark, [], [(1, True)]) == []

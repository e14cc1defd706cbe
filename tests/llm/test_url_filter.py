import re

from qualmark.llm import host_reputation as hr
from qualmark.llm.queries import RULES

URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=1", "http://example.org/en/2#y", "http://org/", "http://xorg/a",
        "http://b.com/fr/a", "http://com/de/b/c?d", "http://b.com/dex", "ftp://h.net", "no scheme", None, "", "://", "http://h.net?q=a/b",
        "http://A.B.Example.ORG:80/es/x", "a://b://c/d", "http://é.ORG/es/", "http://h\n.net/x\ny?z"]


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: tuple(r)[1:] for r in hr.filter_urls(pages, none, RULES).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert hr.filter_urls(pages.limit(0), none, RULES).count() == 0


def test_reputation_is_shrunk_and_blocks(spark):
    rows, bad, i = [], [], 0
    for host, n, k in (("spam.evil.net", 200, 180), ("www.evil.net", 0, 0), ("new.evil.net", 2, 2), ("a.good.net", 300, 15),
                       ("b.good.net", 2, 2), ("c.fine.io", 200, 10)):
        for j in range(max(n, 1)):
            rows.append((i, f"http://{host}/{j}"))
            bad += [(i, int(j < k))] * (n > 0) + [(i, None)] * (n == 0)
            i += 1
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = spark.createDataFrame(bad, "page_id long, bad int")
    rep = {r.host: r for r in hr.host_reputation(
        out.join(pages, "page_id").select(hr.url_host(pages.url).alias("host"), "bad"),
        pages.select(hr.url_host(pages.url).alias("host"))).collect()}
    assert 0.8 < rep["spam.evil.net"].mean < 0.9
    assert rep["www.evil.net"].n == 0 and rep["www.evil.net"].mean > rep["c.fine.io"].mean
    assert rep["b.good.net"].mean < 1 and rep["b.good.net"].bound < rep["b.good.net"].mean
    verdict = {r.host: r.verdict for r in hr.filter_urls(pages, out, []).collect()}
    assert verdict["spam.evil.net"] == "block" and verdict["a.good.net"] == verdict["c.fine.io"] == verdict["b.good.net"] == "allow"


def test_registered_domains(spark):
    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.com": ("x.com", "com"), "w.x.com:80": ("x.com", "com"),
            "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "10.0.0.1:8080": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "uk": ("uk", "uk"),
            "": ("", ""), "a.com.au": ("a.com.au", "com.au"), "q.co.de.fr": ("de.fr", "fr"), "co.info": ("co.info", "info"), "1.2.3": ("2.3", "3")}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r[0]: (r[1], r[2]) for r in df.select("host", hr.registered_domain(df.host), hr.public_suffix(df.host)).collect()}
    assert got == want
    own = df.where("host = 'a.b.co.uk'").select(hr.registered_domain(df.host, ()), hr.public_suffix(df.host, ("b",))).first()
    assert tuple(own) == ("co.uk", "uk")


def test_repeated_rows_and_page_ids(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a")] * 40 + [(2, "http://y.org/b")] * 60, "page_id long, url string")
    bad = spark.createDataFrame([(1, 1), (2, 0)], "page_id long, bad int")
    out = hr.filter_urls(pages, bad, []).collect()
    assert len(out) == 100 and {r.verdict for r in out if r.page_id == 1} == {"block"} and {r.verdict for r in out if r.page_id == 2} == {"allow"}

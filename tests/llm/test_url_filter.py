import re

from pluvio.llm import queries, url_filter

SF = "/root/testdata/sf0.01"


def plain(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_pages(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    listed = {canon(u) for p, u in pages.items() if p % 10 == 0}
    out = queries.op9_url_filter(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        host, path, (rule, verdict) = plain(pages[r["page_id"]], queries.URL_RULES)
        verdict = verdict or ("block" if canon(pages[r["page_id"]]) in listed else "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def canon(url):
    host, path, _ = plain(url, [])
    if not host:
        return None
    host = re.sub(r":(80|443)$", "", re.sub(r"^www\.", "", host))
    bare = url.split("#")[0]
    params = sorted(p for p in (bare.split("?", 1)[1].split("&") if "?" in bare else []) if p and not re.match(r"(?i)(utm_[a-z]+|ref|fbclid|gclid)(=|$)", p))
    return host + re.sub(r"/+$", "", path) + ("?" + "&".join(params) if params else "")


def test_bloom_has_no_false_negatives_and_join_removes_false_positives(spark):
    listed = spark.createDataFrame([(f"http://h{i}.org/p",) for i in range(3000)], "url string")
    pages = spark.createDataFrame([(i, f"https://www.h{i}.org/p/?ref=1#x") for i in range(6000)], "page_id long, url string")
    for bound in (1 << 26, 0):  # broadcast filter, and distributed filter
        got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, listed, [], broadcast_bytes=bound).collect()}
        assert got == {i: "block" if i < 3000 else "allow" for i in range(6000)}
    keys = listed.select(url_filter.canonical(listed["url"]).alias("k"))
    table, blocks = url_filter.bloom(keys, "k")
    asked = pages.select(url_filter.canonical(pages["url"]).alias("k"))
    passed = {r["k"] for r in url_filter.possible_hits(asked, "k", table, blocks).collect()}
    assert {f"h{i}.org/p" for i in range(3000)} <= passed
    assert len(passed) < 3000 + 60


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.B/c", "http://a.b", "http://a.b?x/y", "http://a.b#x/y", "http://Ä.com/en/",
            "http://x.com/" + "p" * 100_000, "ftp://net/es/x", "http://xnet/es/", "http://www.example.com/en/1", "http://example.com/en", "a://b://c/d",
            "http://a.b/?b=1&a=2", "http://a.b/?a=2&b=1&utm_source=q"]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(None, "http://a.b", "x"), (0, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    listed = spark.createDataFrame([("http://a.b/?a=2&b=1",), (None,), ("http://a.b/?a=2&b=1",), ("junk",)], "url string")
    out = url_filter.filter_urls(df, listed, queries.URL_RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, (rule, verdict) = plain(r["url"], queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
        assert r["verdict"] == (verdict or ("block" if r["page_id"] in (16, 17) else "allow")), r["url"]
    assert url_filter.filter_urls(df.limit(0), listed, []).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(df, listed.limit(0), []).collect()} == {"allow"}

import pytest

from claimgauge.llm import url_rules as u
from claimgauge.llm.queries import op3_url_rules
from tests.llm.helpers import clashing, rows

SMALL = "/root/testdata/sf0.01"


def plain(url):
    """Host, path and the given rule, straight from the contract."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in u.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = ["http://Example.ORG/es/1", "https://a.example.org/en/17?x=1", "https://example.org/en/2#f",
        "http://notexample.org/es/", "http://com/fr/x", "https://b.com/de/y", "http://x.net", "http://x.org",
        "http://org?q", "no scheme/es/", None, "", "://", "a://b://c/d", "HTTP://ÄÖ.com/FR/", "x://h/p\nq?r",
        "http://example.org/es", "http://u@h.org:80/a"]


def test_hosts_paths_and_given_rules(spark):
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(URLS)], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: r for r in u.judge_urls(clashing(pages, "host", "rule", "tokens"), labels).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        r = found[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
        assert r["tokens"] == "taken"


def shop(spark, n=200):
    """Pages on /win/ of hosts called bets are bad; either token alone is not."""
    pages, labels = [], []
    for i in range(n):
        host, path = ("bets" if i % 2 else "news"), ("win" if i // 2 % 2 else "read")
        pages.append((i, f"https://{host}.site{i % 5}.net/{path}/{i}?id={i}"))
        if i < n - 20:
            labels.append((i, int(not (host == "bets" and path == "win")), 0))
    pages += [(i, p) for i, p in pages[:3]] + [(None, pages[3][1]), (999, None)]
    return (spark.createDataFrame(pages, "page_id long, url string"),
            spark.createDataFrame([*labels, (None, 0, 1), (3, None, None)],
                                  "doc_id long, quality int, toxic int"))


def test_mines_token_pairs(spark):
    pages, labels = shop(spark)
    mined = u.mined_rules(pages, labels).collect()
    assert [set(r["tokens"]) for r in mined] == [{"h:bets", "p:win"}]
    assert mined[0]["confidence"] == 1.0
    found = u.judge_urls(pages, labels)
    assert found.count() == pages.count()
    for r in found.collect():
        bad = "bets" in (r["url"] or "") and "/win/" in r["url"]
        assert (r["verdict"] == "block") == bad


def deep(spark, where, n=240):
    """Labelled pages that are bad exactly if they have a token far down in the URL."""
    pages, labels = [], []
    for i in range(n):
        mark = "casino" if i % 3 == 0 else f"w{i % 7}"
        url = {"segment": f"https://h{i % 5}.net/a/b/c/d/{mark}/x{i}",
               "key": f"https://h{i % 5}.net/p?a=1&b=2&c=3&d=4&{mark}=5",
               "subdomain": f"https://{mark}.e.d.c.b.a.h{i % 5}.net/"}[where]
        pages.append((i, url))
        labels.append((i, int(i % 3 != 0), 0))
    return (spark.createDataFrame(pages, "page_id long, url string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("where", ["segment", "key", "subdomain"])
def test_the_query_blocks_by_tokens_anywhere_in_the_url(spark, tmp_path, where):
    pages, labels = deep(spark, where)
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    found = op3_url_rules(spark, str(tmp_path)).collect()
    assert len(found) == pages.count()
    assert {r["page_id"] for r in found if r["verdict"] == "block"} == {i for i in range(240) if i % 3 == 0}


def test_long_urls_whose_tokens_go_together_are_mined_once(spark):
    tail = "/".join(f"step{chr(97 + k)}" for k in range(26)) + "/" + "x" * 20_000
    pages = spark.createDataFrame(
        [(i, f"https://bad.net/{tail}" if i % 2 else f"https://fine.net/{i}") for i in range(100)],
        "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(100)],
                                   "doc_id long, quality int, toxic int")
    assert u.mined_rules(pages, labels).count() == 1
    found = {r["page_id"]: r["verdict"] for r in u.judge_urls(pages, labels).collect()}
    assert all(found[i] == ("block" if i % 2 else "allow") for i in range(100))


@pytest.mark.parametrize("limits", [{"least_pages": 500}, {"confidence": 1.1}])
def test_rules_are_pruned_by_support_and_confidence(spark, limits):
    pages, labels = shop(spark)
    if limits.get("confidence"):
        labels = labels.where("doc_id % 7 != 0").unionByName(spark.createDataFrame(
            [(i, 1, 0) for i in range(0, 200, 7)], labels.schema))
        limits = {"confidence": 0.95}
    assert u.mined_rules(pages, labels, **limits).count() == 0


def test_empty_tables(spark):
    pages, labels = shop(spark)
    assert u.judge_urls(pages.limit(0), labels).count() == 0
    assert {r["verdict"] for r in u.judge_urls(pages, labels.limit(0)).collect()} == {"allow"}


def test_query_covers_all_pages(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = rows(op3_url_rules(spark, SMALL), "page_id", "host", "path", "rule", "verdict")
    assert sorted(r[0] for r in found) == sorted(pages)
    for page_id, host, path, rule, verdict in found:
        want = plain(pages[page_id])
        assert (host, path, rule) == want[:3] and verdict == (want[3] or verdict)

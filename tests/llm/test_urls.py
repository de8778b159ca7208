import pytest

from affinis.llm import urls
from affinis.llm.queries import QUERIES, SQL
from oracle import same

CASES = [
    ("https://www.example.com/en/1", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/1", "www.example.com/en/", "allow"),
    ("https://WWW.Example.com/en/?x", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/1", "example.com/en/", "block"),
    ("http://example.com/en", "com/", "allow"),
    ("http://badexample.com/en/", "com/", "allow"),
    ("http://casino-win.example.com/de/1", "com/", "allow"),
    ("http://a.example.net/es/1#x", "net/es/", "block"),
    ("http://a.example.net/fr/", "net/fr/", "block"),
    ("http://a.example.com", None, "allow"),
    ("http://thering.example.net?x", None, "allow"),
    ("http://casino-bets.example.org/en/3", None, "block"),
    ("https://spam-farm.example.net/en/12?x=1", None, "block"),
    ("https://www.thering.example.org/en/12.html", None, "allow"),
    ("no scheme", None, "allow"), ("", None, "allow"), (None, None, "allow"),
]


@pytest.mark.parametrize("rules", [urls.RULES, []])
def test_rules_and_model(spark, rules):
    df = spark.createDataFrame([(i, u, "clash") for i, (u, _, _) in enumerate(CASES)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge_urls(df, rules).collect()}
    by_bucket, bias = urls.weights()
    for i, (url, rule, verdict) in enumerate(CASES):
        host, path = urls.split(url)
        assert (got[i].host, got[i].path) == (host, path)
        score = bias + sum(by_bucket[urls.bucket(g)] for g in urls.grams(host, path))
        assert got[i].score == score
        if rules:
            assert (got[i].rule, got[i].verdict) == (rule, verdict), url
        else:
            assert got[i].rule is None and got[i].verdict == ("block" if score > urls.BLOCK_ABOVE else "allow")


def test_null_ids_repeats_long_urls_and_empty_tables(spark):
    long = "http://" + "a" * 50_000 + ".com/" + "b" * 50_000
    df = spark.createDataFrame([(None, long), (None, long), (1, "http://é.com/ü?")], "page_id long, url string")
    got = urls.judge_urls(df, urls.RULES).collect()
    assert [r.rule for r in got] == ["com/"] * 3 and got[2].host == "é.com"
    assert urls.judge_urls(df.limit(0), urls.RULES).collect() == []


def test_unwanted_hosts_are_found_and_others_left(spark, sf_dir):
    bad = "ads-track spam-farm casino-win adult-x cheap-pills free-bets".split()
    rows = urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), []).collect()
    for r in rows:
        assert (r.verdict == "block") == any(b in r.host for b in bad), r.host


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op7_url_filter"](spark, sf_dir), SQL["op7_url_filter"], sf_dir)

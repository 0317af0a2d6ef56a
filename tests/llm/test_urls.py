import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from isobar.llm import urls
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, duck, same_rows


def test_query_equals_sql(spark):
    same_rows(QUERIES["op9_urls"](spark, SMALL), SQL["op9_urls"], duck(SMALL))


def plain(url):
    """(host, path, rule, pattern rule, verdict) by trying every rule."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, a) for h, p, a in urls.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, action = max(fits)
        return host, path, rule, None, action
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    for name, pattern, _, action in urls.PATTERN_RULES:
        if re.search(pattern, lowered):
            return host, path, None, name, action
    return host, path, None, None, "allow"


ODD = [None, "", "no scheme", "http://", "://net/", "http://net/", "http://NET", "http://a.net?x", "http://xnet/", "http://a.example.net/en/1", "http://a.example.net/EN/1", "https://Example.COM/de/", "http://org/fr/", "http://a.org/fr", "ftp://u@h.org:80/fr/x", "http://x.com/a?u=http://y.net/", "http://m.ads-track.example.com/x", "http://xads-track.com/", "http://big.casino.io/", "http://a.com/login", "http://a.com/b/LOGIN.html#t", "http://a.com/blogin", "http://a.com/x;jsessionid=5", "http://é.net/", "x://a.net/\nb"]


def test_odd_urls(spark):
    frame = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(ODD * 2)], "page_id long, url string, host string, rule string")
    got = urls.judged(frame).collect()
    assert len(got) == len(ODD) * 2
    for r in got:
        assert (r.host, r.path, r.rule, r.pattern_rule, r.verdict) == plain(r.row.url), r.row.url
    kept = urls.allowed(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.url) for r in kept.collect()) == sorted(str(u) for u in ODD * 2 if plain(u)[4] == "allow")
    assert urls.judged(frame.limit(0)).count() == 0


def test_random_urls_with_many_rules_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    made = [f"http{pick('', 's')}://{pick('', 'www.', 'm.')}{pick('example', 'casino', 'ads-track.x')}.{pick('net', 'com', 'org', 'NET')}{pick('', '/')}{pick('en/', 'de/', 'fr/x', 'login', '?jsessionid=1')}" for _ in range(150)]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(made)], "page_id long, url string")
    for r in urls.judged(frame).collect():
        assert (r.host, r.path, r.rule, r.pattern_rule, r.verdict) == plain(r.row.url), r.row.url


def test_rules_are_listed_under_their_rarest_token(spark):
    seen = spark.createDataFrame([("http://a.example.net/en/", 5), ("http://b.net/", 3), ("http://c.org/fr/", 4), ("http://d.org/", 9)], "url string, n long")
    listed = {r.rule: r.token for r in urls.index(seen, urls.rule_table(spark)).collect()}
    assert listed["net/"] == "net" and listed["org/fr/"] == "fr" and listed["example.net/en/"] == "en"
    assert listed["example.com/de/"] == "com" and listed["ad-track host"] == "ads"


def test_rules_without_tokens_are_tested_on_every_url(spark, monkeypatch):
    hosts = (("é.ü", "/", "block"), ("net", "/en/", "allow"))
    patterns = (("percent", r"%[^/]*%", (), "block"), ("login page", r"/login$", ("login",), "block"))
    monkeypatch.setattr(urls, "HOST_RULES", hosts)
    monkeypatch.setattr(urls, "PATTERN_RULES", patterns)
    made = [None, "", "http://é.ü/", "http://x.é.ü/%%", "http://net/en/%%", "http://a.com/%41%42", "http://a.com/login", "http://a.com/%%/login", "--%%", "http://a.com/"] * 2
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(made)], "page_id long, url string")
    for limit in (urls.BROADCAST_RULES, 0):
        monkeypatch.setattr(urls, "BROADCAST_RULES", limit)
        got = urls.judged(frame, urls.rule_table(spark, hosts, patterns)).collect()
        assert len(got) == len(made)
        for r in got:
            assert (r.host, r.path, r.rule, r.pattern_rule, r.verdict) == plain(r.row.url), r.row.url
    only = urls.judged(frame, urls.rule_table(spark, (), patterns[:1])).collect()
    assert sum(r.verdict == "block" for r in only) == sum("%" in (u or "") for u in made)


def test_planted_families_are_judged_and_few_pairs_are_tested(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url")
    made = [f"http://{sub}{name}.example.{end}/es/{n}" for n, (name, sub, end) in enumerate(itertools.product(["casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x"], ["", "www.", "m."], ["com", "net", "org"]))]
    clean = [f"https://www.th{n}.example.com/en/{n}.html" for n in range(200)] + ["http://betting-odds-less.example.com/", "http://slotscar.example.org/x"]
    frame = pages.unionByName(spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(made + clean)], pages.schema))
    got = {r.row.url: r for r in urls.judged(frame).collect()}
    for url in made:
        assert got[url].verdict == "block" and (got[url].rule or got[url].pattern_rule), url
    for url in clean[:200] + clean[-1:]:
        assert got[url].verdict == "allow", url
    rules = urls.rule_table(spark)
    distinct = frame.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    host, path = urls.host_and_path(F.col("url"))
    tested = urls.candidates(distinct.select("url", host.alias("host"), path.alias("path")), rules, urls.index(distinct, rules)).count()
    every = distinct.count() * rules.count()
    assert rules.count() > 100 and len(made) <= tested < every / 50


def test_too_many_rules_without_a_token_are_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_LOOSE", 1)
    frame = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = urls.rule_table(spark, (), (("a", "%a", (), "block"), ("b", "%b", (), "block")))
    with pytest.raises(ValueError, match="no token"):
        urls.judged(frame, rules)

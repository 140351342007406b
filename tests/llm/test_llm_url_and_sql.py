import re
import sys
from pathlib import Path

import pytest

from ledgerline.llm import queries
from ledgerline.llm import url_filter as U

sys.path.insert(0, str(Path(__file__).parent.parent))
import oracle_compare  # noqa: E402

URLS = [None, "", "no scheme/net", "http://A.Example.NET/en/1?x#y", "http://example.net/EN/", "http://example.net", "http://badexample.com/de/",
        "http://x.example.com/de", "http://x.example.com/de/z", "https://org/fr/", "http://fr.org/fr", "a://b://c.net/", "://net/", "http://net?q=/", "http://net/?porn",
        "http://a.com/porn", "http://a.com/porno-x", "http://a.com/popcorn", "http://a.com/casino", "http://a.com/casino/Poker", "http://a.com/casino?casino",
        "http://xxx.com", "http://xxxx.com", "http://é.com/sexy_nude", "http://a.org/fr/porn", "http://a.com/" + "cheap-" * 50000, "http://user@HOST.com:80/p;a?b"]


def brute(url):
    low = (url or "").translate({i: i + 32 for i in range(65, 91)})
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fit = [(len(r), r, v) for v, r in U.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    hits = [t for t in U.VOCABULARY if re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)]
    strict = sum(U.VOCABULARY[t] >= U.STRICT for t in hits)
    soft = len(hits) - strict
    verdict = max(fit)[2] if fit else "block" if strict or soft >= U.SOFT_LIMIT else "allow"
    return host, path, max(fit)[1] if fit else None, verdict, strict, soft


def test_verdicts_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[3], "x", "y")], "page_id long, url string, host string, rule string")
    got = {r.page_id: tuple(r)[1:7] for r in U.judge_urls(pages).collect()}
    assert got == {**{i: brute(u) for i, u in enumerate(URLS)}, None: brute(URLS[3])}


def test_empty_pages_and_no_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://a.com/porn")], "page_id long, url string")
    assert U.judge_urls(pages.limit(0)).count() == 0
    assert U.judge_urls(pages, vocabulary={}).first().verdict == "allow"


def test_planted_hosts(spark):
    bad = ["http://free-bets.example.com/win", "https://casino-win.example.org/", "http://x.com/viagra", "http://a.b/slots/jackpot", "http://nude.dating.example.com/",
           "http://m.example.org/poker?bonus=1"]
    good = ["http://essex.example.org/adults", "http://example.org/win", "http://example.org/winter/deals", "http://example.org/pornography-law-debated",
            "https://example.org/crackers", "http://example.org/alphabet/bettina"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge_urls(pages, rules=()).collect()}
    assert [got[i] for i in range(len(bad + good))] == ["block"] * len(bad) + ["allow"] * len(good)


def test_a_vocabulary_from_a_table(spark, tmp_path):
    rows = [("Zonk", 1.0), ("zonk", 0.2), (" plip ", 0.4), ("plop", 0.5), ("", 1.0), (None, 1.0), ("none", None)]
    spark.createDataFrame(rows, "term string, weight double").write.parquet(f"{tmp_path}/v")
    vocabulary = U.read_vocabulary(spark, f"{tmp_path}/v")
    assert vocabulary == {"zonk": 1.0, "plip": 0.4, "plop": 0.5}
    pages = spark.createDataFrame([(1, "http://a.com/ZONK"), (2, "http://a.com/plip"), (3, "http://plop.com/plip"), (4, "http://a.com/porn")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.hit_weight) for r in U.judge_urls(pages, vocabulary=vocabulary).collect()}
    assert got == {1: ("block", 1.0), 2: ("allow", 0.4), 3: ("block", 0.9), 4: ("allow", 0.0)}
    with pytest.raises(ValueError):
        U.read_vocabulary(spark, f"{tmp_path}/v", most=2)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_oracles(spark, name):
    con = oracle_compare.duck_con("/root/testdata/sf0.001")
    frame = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    want, got = cur.fetchall(), [tuple(r) for r in frame.collect()]
    assert sorted(frame.columns) == sorted(cols) and len(want) == len(got) > 0
    assert oracle_compare.digest(got, frame.columns)[0] == oracle_compare.digest(want, cols)[0]

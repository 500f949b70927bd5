import random
import re

import pytest
from conftest import DATA, same_rows

from llm import url_filter as uf


def test_query_matches_sql(spark, duck):
    same_rows(uf.op4_url_filters(spark, DATA), duck, uf.OP4_SQL)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/fr/", "example.net", "/fr/", "net/", "block"),
        ("http://net", "net", "", None, "allow"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
        ("http://x.org/fr/porn", "x.org", "/fr/porn", "org/fr/", "allow"),
        ("http://x.com/porn", "x.com", "/porn", None, "block"),
        ("http://x.com/pornography", "x.com", "/pornography", None, "allow"),
        ("http://free.com/a", "free.com", "/a", None, "allow"),
        ("http://free-free.com/free", "free-free.com", "/free", None, "allow"),
        ("http://free.com/bets", "free.com", "/bets", None, "block"),
        ("http://free.com/win", "free.com", "/win", None, "allow"),
        ("http://free.com/win/prize-cash", "free.com", "/win/prize-cash", None, "block"),
        ("http://poker.com/poker?poker", "poker.com", "/poker", None, "allow"),
        ("http://lottery.com/teen", "lottery.com", "/teen", None, "block"),
        ("http://ads-track.x.com/a", "ads-track.x.com", "/a", None, "block"),
        ("no scheme", "", "", None, "allow"),
        ("xxx", "", "", None, "block"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("a://b?c://d/e", "b", "", None, "allow"),
    ],
)
def test_cases(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "extra")], "page_id long, url string, host string")
    r = uf.filter_urls(df).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "http://a.com/xxx")] * 3 + [(None, "http://a.com/" + "a" * 100000)], "page_id long, url string")
    assert sorted(r.verdict for r in uf.filter_urls(df).collect()) == ["allow", "block", "block", "block"]
    assert uf.filter_urls(df.limit(0)).count() == 0


def test_vocabulary_is_weighted_and_no_soft_term_rejects_alone():
    assert len(uf.STRICT) == len(set(uf.STRICT)) and not set(uf.STRICT) & set(uf.SOFT)
    assert set(uf.SOFT.values()) == {1, 2, 3} and max(uf.SOFT.values()) < uf.THRESHOLD
    assert all(t.isascii() and t.isalnum() and t == t.lower() for t in [*uf.STRICT, *uf.SOFT])


def test_automaton_equals_a_search_term_by_term():
    rnd = random.Random(3)
    terms = [*uf.STRICT, *uf.SOFT]
    found = uf.automaton(uf.STRICT, uf.SOFT)
    for _ in range(400):
        url = "http://" + "".join(rnd.choice([*rnd.sample(terms, 3), "-", ".", "/", "a", "7", "X", "é"]) for _ in range(12))
        low = url.replace("X", "x")
        hit = {t for t in terms if re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)}
        soft = hit & set(uf.SOFT)
        assert uf.term_hits(found, url) == (len(hit) - len(soft), len(soft), sum(uf.SOFT[t] for t in soft))

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.url_filter import GlobAutomaton, url_verdicts

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1")]


def regex(pattern):
    parts = re.findall(r"\*\*|\*|\?|.", pattern, re.S)
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts).encode())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "/", ".", "*", "**", "?"]), max_size=30).map("".join).map(lambda p: re.sub(r"\*{3,}", "**", p)), min_size=1, max_size=12),
       st.lists(st.text(alphabet="ab/.", max_size=25), max_size=12))
def test_all_patterns_at_once_equal_one_by_one(patterns, strings):
    strings = [s.encode() for s in strings]
    got = GlobAutomaton(patterns).matches(strings)
    assert got.tolist() == [[bool(regex(p).fullmatch(s)) for p in patterns] for s in strings]


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("https://Example.ORG/es/1?x=/a", "example.org", "/es/1", "example.org/es/", "block"),
    ("https://sub.example.org/en/12#top", "sub.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "block"),
    ("http://a.com?x.org/", "a.com", "", None, "block"),
    ("http://a.com/b.org/c", "a.com", "/b.org/c", None, "block"),
    ("http://good.com/x.html", "good.com", "/x.html", None, "allow"),
    ("no scheme/x", "", "", None, "block"), (None, "", "", None, "block"), ("", "", "", None, "block"),
    ("x://y\nz/\nq", "y\nz", "/\nq", None, "block"), ("a://b://c/d", "b:", "//c/d", None, "block"),
    ("http://é.org/" + "x" * 5000, "é.org", "/" + "x" * 5000, "org/", "allow"),
])
def test_verdicts(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "v"), (None, url, "v")], "page_id long, url string, verdict string")
    rows = url_verdicts(pages, RULES, allow=["**.html"], default="block").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [(host, path, rule, verdict)] * 2
    assert sorted(str(r["page_id"]) for r in rows) == ["1", "None"]


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert url_verdicts(pages, []).first()["verdict"] == "allow"
    assert url_verdicts(pages.limit(0), RULES).count() == 0

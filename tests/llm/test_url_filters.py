from __future__ import annotations

import random
import re

import duckdb

from martlens.llm import url_filters
from martlens.llm.statements import OP4
from tests.compare import differences, oracle_connection
from tests.conftest import SMALL

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://WWW.Example.COM/en/a?b#c",
    "http://example.com/en/",
    "http://example.com/en",
    "http://example.com",
    "http://example.com?x=/en/",
    "http://notexample.com/en/x",
    "http://a.b.net/es/x",
    "http://net/fr/1",
    "http://x.org/.com/",
    "http://evil.org/a.com/en/",
    "http://ÄÖ.com:80/π#/en/",
    "http://spam.org/x",
    "http://cheap-pills.net/de/1",
    "ftp://u@x.org/cgi-bin/a",
    "http://x.org/a/wp-login.php?x",
    "a://b://c/d",
    "http://long.org/" + "ab/" * 40_000,
    "http://line.org/a\nb",
]


def as_regex(glob: str) -> re.Pattern:
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.DOTALL)


def test_automaton_equals_one_pattern_at_a_time():
    draw = random.Random(3)
    for _ in range(60):
        globs = ["".join(draw.choices(["a", "b", "/", "é", "*", "**", "?"], k=draw.randint(1, 9))) for _ in range(40)]
        texts = ["".join(draw.choices("ab/éz", k=draw.randint(0, 12))) for _ in range(60)]
        found = url_filters.Automaton.of(globs).fits(texts)
        for i, text in enumerate(texts):
            assert found[i].tolist() == [bool(as_regex(g).fullmatch(text)) for g in globs], (text, globs)


def pages(spark, rows):
    return spark.createDataFrame([(i, url, "<p>", "clash") for i, url in rows], "page_id long, url string, html string, host string")


def test_verdicts(spark, tmp_path):
    rows = [*enumerate(URLS), (None, URLS[4]), (3, URLS[3])]
    pages(spark, rows).write.parquet(str(tmp_path / "pages"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    found = url_filters.judge_urls(spark.read.parquet(str(tmp_path / "pages")))
    assert differences(found, connection, OP4) == []
    by_id = {r.page_id: r for r in found.collect()}
    assert (by_id[4].host, by_id[4].rule, by_id[4].verdict) == ("www.example.com", "www.example.com/en/", "allow")
    assert (by_id[12].rule, by_id[13].rule, by_id[15].verdict) == (None, None, "block")
    assert (by_id[0].host, by_id[0].path, by_id[0].verdict) == ("", "", "allow")


def test_given_pages(spark):
    found = url_filters.judge_urls(spark.read.parquet(f"{SMALL}/pages.parquet"))
    assert differences(found, oracle_connection(SMALL), OP4) == []


def test_no_pages_and_no_rules(spark):
    assert url_filters.judge_urls(pages(spark, []).where("false")).collect() == []
    (row,) = url_filters.judge_urls(pages(spark, [(1, "http://a.com/x")]), rules=[], blocked=["*.a.???/x"]).collect()
    assert (row.rule, row.verdict) == (None, "block")

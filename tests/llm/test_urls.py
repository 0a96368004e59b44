"""URL rules and path templates on small tables."""

from __future__ import annotations

import duckdb
import pytest

from wayfare.llm.url_sql import url_sql
from wayfare.llm.urls import by_rule, url_parts, url_verdicts


@pytest.fixture
def pages(spark):
    """A table like ``pages`` with columns that bear the operator's own names."""

    def make(rows):
        schema = "page_id long, url string, html string, host int, path int, seg int, n int, template int, prefix string"
        return spark.createDataFrame([(i, u, "", 1, 2, 3, 4, 5, "p") for i, u in rows], schema).repartition(3)

    return make


def test_parts(pages):
    want = {
        "http://WWW.Example.Com/En/1?x=/#y": ("www.example.com", "/En/1"),
        "https://a.b": ("a.b", ""),
        "x://h#f/p": ("h", ""),
        "http://h?q/p": ("h", ""),
        "a://b://c/d": ("b:", "//c/d"),
        "http:///p/\nq": ("", "/p/\nq"),
        "ÄB://ÄZ.de/Ü": ("Äz.de", "/Ü"),
        "no scheme/p": ("", ""),
        "": ("", ""),
        None: ("", ""),
    }
    rows = list(enumerate(want))
    got = {r["page_id"]: (r["host"], r["path"]) for r in url_parts(pages(rows)).collect()}
    assert got == {i: want[u] for i, u in rows}


def test_rules(pages):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
    want = {
        "http://example.com/en/1": ("example.com/en/", "block"),
        "http://m.example.com/en/1": ("example.com/en/", "block"),
        "http://a.www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("com/", "allow"),
        "http://example.com": (None, None),
        "http://com/x": ("com/", "allow"),
        "http://acom/x": (None, None),
        "http://x.net/es/": ("net/es/", "block"),
        "http://x.net/es": (None, None),
        None: (None, None),
    }
    rows = list(enumerate(want))
    got = url_parts(pages(rows)).select("page_id", by_rule(rules).alias("f")).select("page_id", "f.*").collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {i: want[u] for i, u in rows}


def test_templates_reject_and_generalise(pages):
    rules = [("bad.org", "/promo/1", "block"), ("bad.org", "/about", "allow"), ("bad.org", "/promo/22", "allow")]
    urls = [f"http://bad.org/promo/1{i}" for i in range(30)] + [f"http://bad.org/promo/{i}" for i in range(3000, 3010)]
    urls += [f"http://bad.org/about/{i}" for i in range(9)] + ["http://bad.org/promo/22", "http://bad.org/news/7", "http://other.org/promo/5", "http://bad.org/promo/5/more/deep/er/and/deeper/still/x"]
    got = {r["url"]: r for r in url_verdicts(pages(list(enumerate(urls))), rules).join(pages(list(enumerate(urls))).select("page_id", "url"), "page_id").collect()}
    assert got["http://bad.org/promo/3003"]["template"] == "bad.org/=promo/~#"
    assert got["http://bad.org/promo/3003"]["rule"] is None and got["http://bad.org/promo/3003"]["verdict"] == "block"
    assert got["http://bad.org/promo/22"]["verdict"] == "allow"  # its rule is longer
    assert got["http://bad.org/news/7"]["verdict"] == got["http://other.org/promo/5"]["verdict"] == "allow"
    assert got[urls[-1]]["template"].endswith("/=**") and got[urls[-1]]["verdict"] == "allow"


def test_branches_merge_by_shape_and_labels(pages):
    urls = [f"http://h.org/{lang}/{i}" for lang in ("aa", "bb", "cc") for i in range(40)] + [f"http://h.org/files/x{i}/readme" for i in range(40)]
    urls += [f"http://wide.org/u{'abcdefghijklmnopqrstuvwxyz'[i]}z/home" for i in range(26)]
    urls += [f"http://l.org/{lang}/{i}" for lang in ("ok", "ko") for i in range(40)]
    got = url_verdicts(pages(list(enumerate(urls))), [("l.org", "/ko", "block")]).collect()
    by_host = {}
    for r in got:
        by_host.setdefault(r["host"], set()).add(r["template"])
    assert by_host["h.org"] == {"h.org/*/~#", "h.org/=files/~x#/=readme"}
    assert by_host["wide.org"] == {"wide.org/*/=home"}
    assert by_host["l.org"] == {"l.org/=ok/~#", "l.org/*/~#"}  # without labels, no part of what is blocked


def test_odd_rows_and_sql(spark, pages):
    rows = [(None, "http://a.net/es/1"), (1, None), (1, None), (2, ""), (3, "http://a.com/"), (3, "http://a.com/"), (4, "http://a.com" + "/x" * 3000)]
    rows += [(10 + i, f"http://big.example.net/{'en' if i % 3 else 'es'}/{i % 50}{'/' if i % 7 else ''}") for i in range(600)]
    rows += [(1000 + i, f"http://www.example.com/en/{i}.html") for i in range(30)]
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["template"], round(r["purity"], 9)) for r in url_verdicts(pages(rows)).collect()]
    assert len(got) == len(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    assert sorted(got, key=str) == sorted(con.sql(url_sql()).fetchall(), key=str)
    assert url_verdicts(pages([(1, "x")]).filter("page_id > 9")).count() == 0

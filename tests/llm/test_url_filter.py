import pytest

from skyloom.llm import url_filter as uf

PAGES = "page_id long, url string, bound string"
OUTCOMES = "page_id long, bad int"


def judged(spark, pages, outcomes=(), **more):
    frame = spark.createDataFrame([(*p, "x") for p in pages], PAGES)  # a column named like one of the operator's own
    return {r["page_id"]: r for r in uf.judge(frame, spark.createDataFrame(list(outcomes), OUTCOMES), **more).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://Example.ORG/en/12?x", "example.org", "/en/12", "example.org/en/1"),
        ("http://a.example.org/en/2", "a.example.org", "/en/2", "org/"),
        ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/"),
        ("http://example.org/es/", "example.org", "/es/", "example.org/es/"),
        ("http://example.org", "example.org", "", None),
        ("http://x.com/fr/a#b", "x.com", "/fr/a", "com/fr/"),
        ("http://x.com/FR/a", "x.com", "/FR/a", None),
        ("http://x.com/de/", "x.com", "/de/", "com/de/"),
        ("x://\u00c9.com?q://y", "\u00c9.com", "", None),
        ("no scheme", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_host_path_and_rule(spark, url, host, path, rule):
    row = judged(spark, [(1, url)])[1]
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
    assert row["verdict"] == ("allow" if rule in (None, "org/", "com/fr/") else "block")


def test_bad_hosts_are_blocked_and_unknown_ones_follow_their_domain(spark):
    pages = [(i, f"http://bad.site.net/{i}") for i in range(60)] + [(100 + i, f"http://good.other.net/{i}") for i in range(60)]
    pages += [(200, "http://new.site.net/a"), (201, "http://one.fresh.net/a"), (None, "http://bad.site.net/z")]
    outcomes = [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)] + [(201, 1), (5, None), (None, 1), (999, 1)]
    rows = judged(spark, pages, outcomes, limit=0.5)
    assert rows[3]["verdict"] == "block" and rows[None]["verdict"] == "block"
    assert rows[103]["verdict"] == "allow" and rows[201]["verdict"] == "allow"
    assert rows[103]["bound"] < rows[201]["bound"] < rows[3]["bound"]
    assert rows[103]["bound"] < rows[200]["bound"] < rows[3]["bound"]


def test_empty_tables_and_repeated_pages(spark):
    assert judged(spark, []) == {}
    frame = spark.createDataFrame([(1, "http://a.net/x", ""), (1, "http://a.net/x", "")], PAGES)
    rows = uf.judge(frame, spark.createDataFrame([(1, 1)], OUTCOMES)).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_a_host_without_labels_is_not_judged_on_one_page_of_its_domain(spark):
    pages = [(1, "http://a.lone.net/x"), (2, "http://b.lone.net/y")] + [(10 + i, f"http://good.net/{i}") for i in range(40)]
    outcomes = [(1, 1)] + [(10 + i, 0) for i in range(40)]
    rows = judged(spark, pages, outcomes, limit=0.5)
    assert rows[2]["verdict"] == "allow" and rows[1]["verdict"] == "allow"
    assert rows[2]["bound"] < 0.5 and rows[1]["bound"] < 0.5  # wide intervals: few pages behind them

"""Operator 6: rounds follow branchings, not path lengths, and one rule decides for any number of branches."""

import pytest

from leasekit.llm import url_filter as uf


def rounds(monkeypatch):
    """Names of the tables written from here on."""
    seen, write = [], uf.written
    monkeypatch.setattr(uf, "written", lambda df, what: seen.append(what) or write(df, what))
    return seen


def test_long_paths_take_few_rounds(spark, monkeypatch):
    """A trap's paths of 1 to 500 levels, each the start of the next, and two sections below 300 common levels."""
    common = "/".join(["deep"] * 300)
    rows = [("http://trap.org" + "/loop" * k, None) for k in range(1, 501)]
    rows += [(f"http://deep.org/{common}/{s}/{'y' * k}.html", s == "bad") for s in ("good", "bad") for k in range(1, 41)]
    rows += [("http://short.org", False), ("http://short.org/a", False), ("http://short.org/a/", None)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    seen = rounds(monkeypatch)
    got = {r.page_id: r for r in uf.filter_urls(pages, spark.createDataFrame(rows, "url string, bad boolean"), []).collect()}
    assert seen.count("templates") <= 3
    for k, (url, bad) in enumerate(rows):
        if bad is None or "short" in url:
            assert got[k].template == got[k].path  # a chain keeps its names
        else:
            assert got[k].verdict == ("block" if bad else "allow") and got[k].template == f"/{common}/{'bad' if bad else 'good'}/*"


@pytest.mark.parametrize("bad_of_labels", [(1, 3), (4, 6), (12, 14)])
def test_the_same_branch_is_judged_alike_around_any_number(spark, bad_of_labels):
    """A branch beside n - 1 clean ones: 11 to 14 branches decide alike."""
    bad, labels = bad_of_labels
    rows = []
    for n in (11, 12, 13, 14):
        rows += [(f"http://h{n}.org/odd/{k}", k < bad) for k in range(labels)]
        rows += [(f"http://h{n}.org/s{chr(97 + s)}/{k}", False) for s in range(n - 1) for k in range(100, 130)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    # Numbers repeat as <n>: each typed path carries its section's labels.
    got = uf.filter_urls(pages, spark.createDataFrame(rows, "url string, bad boolean"), []).collect()
    assert len({(r.template, r.verdict) for r in got if r.path.startswith("/odd/")}) == 1

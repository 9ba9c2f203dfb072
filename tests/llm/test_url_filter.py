import random
import re
from itertools import combinations

import pytest

from starloom.llm import url_filter as u

URLS = [
    ("http://a.example.net/en/1", "example.net/en/", "allow"),
    ("http://a.EXAMPLE.net/fr/1", "net/", "block"),
    ("http://example.net/en", "net/", "block"),
    ("https://b.example.com/de/x?y", "example.com/de/", "block"),
    ("https://b.example.com/de", None, "allow"),
    ("x://fr.org/fr/", "org/fr/", "allow"),
    ("http://example.network/en/1", None, "allow"),
    ("http://myexample.com/de/1", None, "allow"),
    ("http://example.net", None, "allow"),  # no path, so none that begins with /
    ("http://example.net?/en/", None, "allow"),
    ("http://net/", "net/", "block"),
    ("no scheme.net/en/", None, "allow"),
    ("", None, "allow"),
    (None, None, "allow"),
    ("http://", None, "allow"),
    ("http://a.net://b.org/fr/", None, "allow"),
    ("http://é.net/ü/#x", "net/", "block"),
    ("http://" + "a." * 30_000 + "net/" + "b/" * 30_000, "net/", "block"),
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_listed_rules(spark):
    pages = spark.createDataFrame(
        [(k, url, "html", 1) for k, (url, *_) in enumerate(URLS)] * 2 + [(None, "http://net/", "", 2)],
        "page_id long, url string, html string, confidence int",
    )
    got = u.judge(pages, u.listed(spark, u.RULES), spark.createDataFrame([], u._MINED)).collect()
    want = [(k, *parts(url), rule, verdict, None, None) for k, (url, rule, verdict) in enumerate(URLS)] * 2
    want.append((None, "net", "/", "net/", "block", None, None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def labelled():
    """URLs of which those with `/ads/` and key `id`, or of host `bad.com`, are mostly blocked."""
    rng = random.Random(9)
    out = []
    for _ in range(600):
        host = rng.choice(("www.bad.com", "a.good.com", "b.good.com", "c.site.io"))
        path = rng.choice(("/ads/x", "/ads/x/y", "/news/1.html", "/x"))
        url = f"http://{host}{path}{rng.choice(('', '?id=4', '?id=5&q=1', '?q=2'))}"
        bad = "bad.com" in host or "/ads/" in path and "id=" in url
        out.append((url, "block" if bad != (rng.random() < 0.05) else "allow"))
    return out + [(None, "allow"), ("odd", "block"), ("http://c.site.io/x", None)]


def token_sets(spark, urls):
    df = spark.createDataFrame([(x,) for x in urls], "url string")
    return {r.url: frozenset(r.t or ()) for r in df.select("url", u.tokens(u.F.col("url")).alias("t")).collect()}


def brute_rules(spark, labelled, least, confidence):
    rows = [(url, v) for url, v in labelled if v is not None]
    sets = token_sets(spark, [url for url, _ in rows])
    where = {}
    for k, (url, _) in enumerate(rows):
        for t in sets[url]:
            where.setdefault(t, set()).add(k)
    same = {}
    for t, ks in where.items():
        if len(ks) >= least:
            same.setdefault(frozenset(ks), []).append(t)
    names = [max(ts, key=lambda t: (len(t), t)) for ts in same.values()]
    rules = {}
    for v in ("block", "allow"):
        base = sum(1 for _, x in rows if x == v) / len(rows)
        for n in range(1, 7):
            for c in combinations(sorted(names), n):
                had = set.intersection(*(where[t] for t in c))
                both = sum(1 for k in had if rows[k][1] == v)
                if both >= least and both / len(had) >= confidence and both / len(had) > base:
                    rules[v, c] = (both / len(had), both)
    return {
        (v, c, conf, n)
        for (v, c), (conf, n) in rules.items()
        if not any(rules.get((v, c[:i] + c[i + 1 :]), (0,))[0] >= conf for i in range(len(c)) if len(c) > 1)
    }


def test_rules_as_counted_one_by_one(spark, labelled):
    df = spark.createDataFrame([(*x, 1) for x in labelled], "url string, verdict string, n int")
    got = u.mine(df.repartition(3), support=0.02, support_rows=10).collect()
    want = brute_rules(spark, labelled, 13, 0.8)
    assert {(r.verdict, tuple(r.tokens), r.confidence, r.support) for r in got} == want and len(got) == len(want) > 3
    assert all(r.token in r.tokens for r in got)


def test_mined_rules_decide_where_no_listed_one_does(spark, labelled):
    df = spark.createDataFrame(labelled, "url string, verdict string")
    mined = u.mine(df, support=0.02, support_rows=10)
    rules = mined.collect()
    urls = ["http://new.bad.com/q", "http://www.bad.com/q", "http://z.good.com/ads/7?id=9", "http://z.org/news/2.html", "http://www.bad.net/x", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in u.judge(pages, u.listed(spark, u.RULES), mined).collect()}
    assert got[1].verdict == "block" and got[1].rule is None and got[4].rule == "net/"
    assert got[5].verdict == "allow" and got[2].verdict == "block"
    sets = token_sets(spark, urls)
    for k, url in enumerate(urls[:4]):
        fit = [r for r in rules if set(r.tokens) <= sets[url]]
        best = min(fit, key=lambda r: (-r.confidence, -r.support, len(r.tokens), r.verdict != "block")) if fit else None
        assert got[k].verdict == (best.verdict if best else "allow")
        assert got[k].confidence == (best.confidence if best else None)


def test_nothing_to_mine(spark):
    none = spark.createDataFrame([], "url string, verdict string")
    assert u.mine(none).count() == 0
    assert u.mine(spark.createDataFrame([("http://a/b", "block")] * 19, none.schema)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert u.judge(pages, u.listed(spark, ()), u.mine(none)).count() == 0


def test_labels_of_pages(spark):
    pages = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"), (4, "f")], "page_id long, url string")
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, None, 1), (4, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int"
    )
    got = {tuple(r) for r in u.page_labels(pages, labels).collect()}
    assert got == {("a", "block"), ("b", "allow"), ("c", "allow"), ("d", "block")}

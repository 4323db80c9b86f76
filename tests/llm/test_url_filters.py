from __future__ import annotations

import math
import random
import re

import duckdb
import pytest

from roadpulse.llm import url_filters


def expected(url):
    """Host, path, rule and its verdict, by plain string work."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


ODD = [
    None, "", "no scheme", "http://", "HTTP://A.Example.NET", "http://x.net/", "http://net/", "http://xnet/a", "http://a.net?x=/",
    "http://b.net#/", "https://example.net/en/1", "https://w.example.net/en", "http://example.com/de/", "http://EXAMPLE.com/De/",
    "ftp://a.org/fr/2?x#y", "http://org/fr/", "x://y://z.net/p", "http://user@h.net:80/", "://q.net/", "http://a.net/\nb", "http://h/" + "a/" * 300,
    "http://ÄB.net/ß", "http://a.net//en//", "http://a.b.example.net/en/x", "http://exampleXnet/", "http://a|b/c|d/e",
]


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", "h", 1) for k, u in enumerate(urls)], "page_id long, url string, html string, host string, n int")


def test_parts_and_rules(spark):
    got = {r.page_id: r for r in url_filters.judged(pages(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for k, url in enumerate(ODD):
        host, path, rule, verdict = expected(url)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert verdict is None or got[k].verdict == verdict
        assert got[k].verdict in ("allow", "block")


@pytest.mark.parametrize("name", ["odd", "crowd"])
def test_equals_its_twin(spark, name):
    crowd = [f"http://h{k % 3}.example.{'net com org'.split()[k % 3]}/{'en de fr es it'.split()[k * k % 5]}/{k // 7}/{k % 4}/x{k % 6}/y/z" for k in range(900)]
    urls = ODD * 2 if name == "odd" else crowd + ODD
    df = pages(spark, urls)
    got = sorted(map(str, (tuple(r) for r in url_filters.judged(df).collect())))
    db = duckdb.connect()
    db.register("pages", df.toPandas())
    assert got == sorted(map(str, db.execute(url_filters.ORACLES["op4_url_filters"]).fetchall()))


def test_tree_of_one_host(spark):
    """Blocked branches stay apart from others, however many rows the host has."""
    urls = [f"http://a.example.com/de/{k}" for k in range(200)] + [f"http://a.example.com/en/{k}" for k in range(200)]
    urls += [f"http://a.example.com/fr/{k}" for k in range(200)] + ["http://a.example.com/it/1"]
    got = {r.page_id: r for r in url_filters.judged(pages(spark, urls)).collect()}
    assert [{got[k].template for k in part} for part in (range(200), range(200, 400), range(400, 600), [600])] == [
        {"a.example.com/de"}, {"a.example.com/en"}, {"a.example.com/fr"}, {"a.example.com/it"}
    ]
    assert {got[k].verdict for k in range(200, 601)} == {"allow"} and got[0].purity > 0.99


@pytest.mark.parametrize("rows", [3, 20])
def test_a_hundred_sections_go_by_their_own_labels(spark, rows):
    """Of one per cent each, with few rows or many: the labels of /de/ decide no page of another section."""
    urls = [f"http://big.example.com/{'de' if s == 7 else f's{s}'}/{k}" for s in range(100) for k in range(rows)]
    got = url_filters.judged(pages(spark, urls)).collect()
    assert {(r.rule, r.verdict) for r in got} == {("example.com/de/", "block"), (None, "allow")}
    assert len({r.template for r in got if r.verdict == "block"}) == 1
    templates = {r.template for r in got}
    assert templates == ({"big.example.com/*", "big.example.com/de"} if rows == 3 else {f"big.example.com/{'de' if s == 7 else f's{s}'}" for s in range(100)})


def test_signs_of_templates_in_urls(spark):
    urls = [f"http://x.example.com/{s}/{k}" for s in ("de", "*", "a+1", "50%") for k in range(6)]
    got = {r.path.split("/")[1]: r.template for r in url_filters.judged(pages(spark, urls)).collect()}
    assert got == {"de": "x.example.com/de", "*": "x.example.com/%2A", "a+1": "x.example.com/a%2B1", "50%": "x.example.com/50%25"}


def apart(b, n, c, m):
    weight = lambda x: x * math.log(x) if x > 0 else 0.0
    split = lambda x, of: weight(x) + weight(of - x) - weight(of)
    return 2 * (split(b, n) + split(c, m) - split(b + c, n + m))


def plain_tree(rows):
    """template -> positions of ``rows`` (host, segments, ruled), by recursion on lists."""
    found = {}

    def grow(name, mine, level):
        labelled = [k for k in mine if rows[k][2] is not None]
        if not 0 < len(labelled) < len(mine) or all(len(rows[k][1]) <= level for k in mine):
            found.setdefault(name, []).extend(mine)
            return
        by = {}
        for k in mine:
            if len(rows[k][1]) > level:
                by.setdefault(rows[k][1][level], []).append(k)
            else:
                found.setdefault(name, []).append(k)
        count = {s: (len(ks), sum(rows[k][2] is not None for k in ks), sum(rows[k][2] == "block" for k in ks)) for s, ks in by.items()}
        small = {s: c for s, c in count.items() if c[0] < url_filters.ROWS}
        many = sum(c[1] > 0 for c in small.values())
        all_m, all_b = sum(c[1] for c in small.values()), sum(c[2] for c in small.values())
        branch, last, group = {}, None, []
        for s, (_, m, b) in small.items():
            alike = many >= url_filters.VALUES and apart(b, m, all_b - b, all_m - m) <= url_filters.APART
            if len(small) >= url_filters.VALUES and (m == 0 or alike):
                branch[s] = "*"
        for s in sorted((s for s in by if s not in branch), key=lambda s: (count[s][2] / max(count[s][1], 1), s.encode())):
            _, m, b = count[s]
            if m == 0:
                branch[s] = s
                continue
            if last is None or apart(b, m, *last) > url_filters.APART:
                group.append([])
            group[-1].append(s)
            last = b, m
        for names in group:
            for s in names:
                branch[s] = min(names) + (f"+{len(names) - 1}" if len(names) > 1 else "")
        below = {}
        for s, ks in by.items():
            below.setdefault(branch[s], []).extend(ks)
        for b, ks in below.items():
            grow(f"{name}/{b}", ks, level + 1)

    for host in {r[0] for r in rows}:
        grow(host, [k for k, r in enumerate(rows) if r[0] == host], 0)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_tree_grown_by_recursion(spark, seed):
    rng = random.Random(seed)
    names = ["de", "en", "fr", "a", "b", "c", "x1", "x2", "x3"]
    urls = []
    for _ in range(500):
        host = rng.choice(["h.example.com", "g.example.com", "k.org", "e.example.net"])
        path = [rng.choice(names) if rng.random() < 0.8 else f"i{rng.randrange(400)}" for _ in range(rng.randrange(7))]
        urls.append(f"http://{host}/" + "/".join(path) + "/" * (rng.random() < 0.5))
    rules = (("block", "example.com", "/de/"), ("allow", "example.com", "/de/a"), ("block", "example.com", "/a/b"), ("allow", "org", "/x1"), ("block", "net", "/i1"))
    got = {r.page_id: r for r in url_filters.judged(pages(spark, urls), rules).collect()}
    ruled = [got[k].verdict if got[k].rule else None for k in range(len(urls))]
    rows = [(got[k].host, [x for x in got[k].path.split("/") if x], ruled[k]) for k in range(len(urls))]
    for name, mine in plain_tree(rows).items():
        assert {got[k].template for k in mine} == {name}
        m, b = sum(ruled[k] is not None for k in mine), sum(ruled[k] == "block" for k in mine)
        for k in mine:
            assert got[k].verdict == (ruled[k] or ("block" if (b + 1) / (m + 2) >= url_filters.REJECT else "allow"))


def test_learned_templates_reject(spark):
    """Rows without a rule go with the labelled rows of their template."""
    rows = pages(spark, [f"http://h.example.com/de/{k}" for k in range(40)]).selectExpr("page_id", "replace(url, '/de/', '/x/') AS url")
    rules = (("block", "h.example.com", "/x/1"), ("block", "h.example.com", "/x/2"), ("block", "h.example.com", "/x/3"))
    got = {r.page_id: r for r in url_filters.judged(rows, rules).collect()}
    assert got[4].rule is None and got[4].verdict == "block" and got[4].purity > 0.9


def test_no_python_in_the_plan(spark, sf_dir):
    from helpers import plan

    text = plan(url_filters.op4_url_filters(spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text and "MapInArrow" not in text


def test_empty_table(spark):
    assert url_filters.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0

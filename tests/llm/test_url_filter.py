import random
import re
from collections import Counter, defaultdict

import pytest

from tributary.llm import url_filter as uf
from tributary.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest).group(0)
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group(0)


def rule_of(host, path, rules):
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(pages, rules, steps=10, damping=0.85, threshold=0.6):
    rows = [(i, *parts(u), h) for i, u, h in pages]
    edges, names = set(), set()
    for _, host, _, html in rows:
        names.add(host)
        for to in re.findall(uf.LINK, html or ""):
            to = to.lower()
            edges.add((host, to))
            names.add(to)
    for n in list(names):
        labels = n.split(".")
        for i in range(len(labels) - 2):
            a, b = ".".join(labels[i:]), ".".join(labels[i + 1:])
            edges |= {(a, b), (b, a)}
    edges = {(a, b) for a, b in edges if a and b and a != b}
    score = {}
    for kind, way in (("allow", edges), ("block", {(b, a) for a, b in edges})):
        seed, out = defaultdict(float), defaultdict(list)
        for _, host, path, _ in rows:
            if host and rule_of(host, path, rules)[1] == kind:
                seed[host] += 1
        for a, b in way:
            out[a].append(b)
        rank = dict(seed)
        for _ in range(steps):
            new = defaultdict(float, {h: (1 - damping) * m for h, m in seed.items()})
            for a, m in rank.items():
                for b in out[a]:
                    new[b] += damping * m / len(out[a])
            rank = new
        score[kind] = rank
    out = []
    for i, host, path, _ in rows:
        rule, verdict = rule_of(host, path, rules)
        t, d = score["allow"].get(host, 0.0) if host else 0.0, score["block"].get(host, 0.0) if host else 0.0
        out.append((i, host, path, rule, verdict or ("block" if d > threshold * (t + d) else "allow"), round(t, 6), round(d, 6)))
    return sorted(out, key=str)


def run(spark, pages, rules=URL_RULES):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = uf.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"), steps=10).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.trust, 6), round(r.distrust, 6)) for r in got), key=str)


LINKED = [
    (1, "https://Good.example.ORG/a", '<a href="https://friend.net/x">f</a> <a href="//mid.net">m</a>'), (2, "http://friend.net/p", '<A HREF=\'http://far.net\'>x</A>'), (3, "http://far.net/", None),
    (4, "http://shop.com/de/1", '<a href="http://shop.com/fr/2">own</a>'), (5, "http://lure.net/", '<a href="http://shop.com/de/1">buy</a>'), (6, "http://bait.net/q?x=1", '<a href="http://lure.net/">go</a>'),
    (7, "http://mid.net", '<a href="http://shop.com/x">s</a>'), (8, None, "<a href='http://friend.net'>n</a>"), (9, "no scheme/path", ""), (10, "", None), (None, "http://a.org", None), (11, "http://a.org/?q", None),
    (1, "https://Good.example.ORG/a", None), (12, "ftp://x.example.org/en/15", ""), (13, "http://example.org/es/", ""), (14, "http://notexample.org/es/", ""), (15, "x://y://z/p#f", ""), (16, "http://.com/fr/", ""),
]


def test_verdicts_equal_brute_force_on_a_small_web(spark):
    got = run(spark, LINKED)
    assert got == brute(LINKED, URL_RULES)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[2] == verdict[3] == "allow" and verdict[5] == verdict[6] == "block"    # trust flows along links, distrust back


def test_verdicts_equal_brute_force_on_the_pages(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert run(spark, pages) == brute(pages, URL_RULES)


def test_evidence_of_a_far_seed_arrives(spark, tmp_path):
    pages = [(i, f"http://h{i}.net/", f"<a href='http://h{i + 1}.net/'>n</a>") for i in range(25)] + [(25, "http://h25.net/", "<a href='http://shop.com/de/1'>s</a>"), (26, "http://shop.com/de/1", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.verdict, r.distrust) for r in QUERIES["op10_link_trust"](spark, str(tmp_path)).collect())
    want = {r[0]: r[6] for r in brute(pages, URL_RULES, steps=150)}
    assert [v for _, v, _ in got] == ["block"] * 27 and all(abs(d - want[i]) < 1e-5 for i, _, d in got)


def test_extrapolated_walk_meets_the_plain_one(spark):
    """Cycles, a hub, chains and leaves: the fixed point of a walk of 400 steps."""
    rnd = random.Random(3)
    edges = {(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)} | {("hub", f"l{i}") for i in range(40)} | {(f"l{i}", "hub") for i in range(40)}
    edges |= {(f"l{rnd.randrange(40)}", f"c{rnd.randrange(7)}") for _ in range(12)} | {(f"s{i}", f"s{i + 1}") for i in range(20)} | {("c3", "s0")}
    seeds = [("l1", "trust", 3.0), ("c0", "distrust", 2.0), ("alone", "trust", 1.0), ("l9", "distrust", 5.0)]
    want = {}
    for kind in ("trust", "distrust"):
        way = [e if kind == "trust" else e[::-1] for e in edges]
        out = Counter(a for a, _ in way)
        start = {h: m for h, k, m in seeds if k == kind}
        rank = dict(start)
        for _ in range(400):
            nxt = Counter({h: 0.15 * m for h, m in start.items()})
            for a, b in way:
                if a in rank:
                    nxt[b] += 0.85 * rank[a] / out[a]
            rank = nxt
        want[kind] = rank
    got = uf.propagate(spark.createDataFrame(sorted(edges), "src string, dst string"), spark.createDataFrame(seeds, "host string, kind string, mass double")).collect()
    assert {r.host for r in got} == set(want["trust"]) | set(want["distrust"])
    assert max(abs(r[k] - want[k].get(r.host, 0.0)) for r in got for k in want) < 1e-7
    assert all((r[k] > 0) == (r.host in want[k]) for r in got for k in want)


def test_longest_rule_wins_and_equal_rules_count_once(spark):
    rules = [("a.b", "/", "allow"), ("a.b", "/x", "block"), ("b", "/x/long/path", "allow"), ("a.b", "/", "allow")]
    got = {r[0]: r[3:5] for r in run(spark, [(1, "h://a.b/x/long/path", ""), (2, "h://c.a.b/x", ""), (3, "h://a.b/y", ""), (4, "h://b/y", "")], rules)}
    assert got[1] == ("b/x/long/path", "allow") and got[2] == ("a.b/x", "block") and got[3] == ("a.b/", "allow") and got[4][0] is None


@pytest.mark.parametrize("rules", [URL_RULES, []])
def test_empty_table_and_clashing_columns(spark, rules):
    df = spark.createDataFrame(LINKED, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as rule", "'z' as verdict", "'p' as path")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert uf.judge(df, r).count() == len(LINKED) and uf.judge(df.limit(0), r).count() == 0

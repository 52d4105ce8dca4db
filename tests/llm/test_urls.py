from __future__ import annotations

import random
import re

from leaguelake.llm import urls
from leaguelake.llm.queries import URL_RULES
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, id string, host int, n long, template string, _way int"


def pages(spark, addresses):
    return spark.createDataFrame([(i, u, "x", 1, 2, "t", 3) for i, u in enumerate(addresses)], SCHEMA)


def brute_rule(host: str, path: str, rules) -> urls.Rule | None:
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)


def split_address(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


ODD = [
    None, "", "no address", "http://", "http://a.NET", "https://X.example.net/en/1?q=/de/", "http://example.net/en", "http://net/x",
    "http://subnet/x", "http://www.Example.com/de/5#top", "http://example.com?x=/de/", "ftp://a.org/fr/1", "http://a.org/fr",
    "http://b.org://c/d", "http://a.com//x//", "http://É.net/ü", "http://h.com/" + "a/" * 50, "http://h.com/a\nb/c",
]


def test_rules_against_brute_force(spark):
    folder = "/root/testdata/sf0.01/pages.parquet"
    addresses = [r.url for r in spark.read.parquet(folder).collect()] + ODD + ODD
    found = urls.judged(pages(spark, addresses), URL_RULES).collect()
    assert len(found) == len(addresses)
    for r in found:
        host, path = split_address(addresses[r.id])
        rule = brute_rule(host, path, URL_RULES)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule.text if rule else None)
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_longest_rule_wins_and_hosts_end_at_dots(spark):
    # b.c/ and c/x/ are of one length: the longer host decides
    rules = [urls.Rule("b.c", "/", "allow"), urls.Rule("c", "/x/", "block"), urls.Rule("a.b.c", "/", "block")]
    found = urls.judged(pages(spark, ["s://a.b.c/x/1", "s://z.b.c/x/1", "s://ab.c/x/", "s://xb.c/y"]), rules)
    assert {r.id: r.rule for r in found.collect()} == {0: "a.b.c/", 1: "b.c/", 2: "c/x/", 3: None}


def test_templates_generalise_variable_segments(spark):
    rows = [("h", f"/item/{i}.html", 1) for i in range(40)] + [("h", f"/user/{i}/posts", 1) for i in range(30)]
    rows += [("h", "/about", 5), ("h", "/", 3), ("h", "", 1), ("k", "/item/1.html", 2), ("h", "/1/2/3/4/5/6/7/8", 1)]
    rows += [("m", f"/p/{i}", 1) for i in range(40)] + [("m", "/p/popular", 30)]
    paths = spark.createDataFrame(rows, "host string, path string, n long")
    found = {(r.host, r.path): (r.template, r.parent) for r in urls.with_templates(paths).collect()}
    assert len(found) == len(rows)
    assert found["h", "/item/7.html"] == ("/item/*.html", "/item")
    assert found["h", "/user/7/posts"] == ("/user/*/posts", "/user/*")
    assert found["h", "/about"] == ("/about", "") and found["k", "/item/1.html"] == ("/item/1.html", "/item")
    assert found["h", "/1/2/3/4/5/6/7/8"] == ("/1/2/3/4/5/6/7/8", "/1/2/3/4/5/6/7")
    assert found["m", "/p/3"][0] == "/p/*" and found["m", "/p/popular"][0] == "/p/popular"


def test_purity_of_templates_judges_unlabelled_addresses(spark):
    rules = [urls.Rule("bad.com", f"/ads/{i}1", "block") for i in range(10)] + [urls.Rule("bad.com", f"/news/{i}1", "allow") for i in range(10)]
    addresses = [f"http://bad.com/{kind}/{i}" for kind in ("ads", "news", "other") for i in range(400)]
    addresses += [f"http://good.com/ads/{i}" for i in range(100)]
    found = urls.judged(pages(spark, addresses), rules).where("rule is null")
    verdicts = {(r.host, r.template): r.verdict for r in found.select("host", "template", "verdict").distinct().collect()}
    assert verdicts == {
        ("bad.com", "/ads/*"): "block", ("bad.com", "/news/*"): "allow", ("bad.com", "/other/*"): "allow",
        ("good.com", "/ads/*"): "allow",
    }


def test_repeated_addresses_do_not_stop_generalisation(spark):
    rules = [urls.Rule("bad.com", f"/ads/{i}1", "block") for i in range(10)]
    rules += [urls.Rule("four.com", f"/ads/{i}1", "block") for i in range(10)]
    addresses = [f"http://bad.com/ads/{i}" for i in range(400)] + ["http://bad.com/ads/hot"] * 1600
    addresses += [f"http://bad.com/ads/old/{i}" for i in range(2000)]  # nor does a value with many paths
    addresses += [f"http://four.com/ads/{i}" for i in range(400)] * 5
    found = urls.judged(pages(spark, addresses), rules).where("rule is null and path not like '/ads/old/%'")
    verdicts = {(r.host, r.template): r.verdict for r in found.select("host", "template", "verdict").distinct().collect()}
    assert verdicts == {
        ("bad.com", "/ads/*"): "block", ("bad.com", "/ads/hot"): "allow", ("four.com", "/ads/*"): "block",
    }


def test_similar_sisters_are_merged(spark):
    rows = [("h", "/a/*", "/a", 50, 49), ("h", "/a/*.html", "/a", 0, 0), ("h", "/b/*", "/b", 40, 40), ("h", "/b/*/", "/b", 40, 0)]
    paths = spark.createDataFrame(rows, "host string, template string, parent string, labelled long, blocked long")
    assert {r.template for r in urls.rejected_templates(paths).collect()} == {"/a/*", "/a/*.html", "/b/*"}


def test_templates_of_any_depth(spark):
    deep, long = "/d" * 11, "/x" * 3000
    rows = [("h", f"{deep}/{i}/end", 1) for i in range(20)] + [("h", f"{deep}/{i}.html", 1) for i in range(20)]
    rows += [("h", long, 1), ("k", "", 1), ("k", "/", 1), ("k", "//", 1)]
    paths = spark.createDataFrame(rows, "host string, path string, n long")
    found = {(r.host, r.path): (r.template, r.parent) for r in urls.with_templates(paths).collect()}
    assert len(found) == len(rows)
    assert found["h", f"{deep}/3/end"] == (f"{deep}/*/end", f"{deep}/*") and found["h", f"{deep}/3.html"] == (f"{deep}/*.html", deep)
    assert found["h", long] == (long, long[:-2])
    assert [found["k", p] for p in ("", "/", "//")] == [("", ""), ("/", ""), ("//", "/")]


def test_names_like_wildcards_are_names(spark):
    rows = [("h", p, 1) for p in ("/*", "/*.html/x", "/\\*", "/\\", "/a*")]
    paths = spark.createDataFrame(rows, "host string, path string, n long")
    found = {r.path: r.template for r in urls.with_templates(paths).collect()}
    assert found == {"/*": "/\\*", "/*.html/x": "/\\*.html/x", "/\\*": "/\\\\*", "/\\": "/\\\\", "/a*": "/a*"}
    labelled = spark.createDataFrame(
        [("h", "/\\*", "", 9, 9), ("h", "/*", "", 0, 0)], "host string, template string, parent string, labelled long, blocked long"
    )
    assert urls.rejected_templates(labelled).count() == 0


def brute_rejected(nodes: dict[str, tuple[int, int]]) -> set[str]:
    """Templates of one host, by plain loops over the statement of `rejected_templates`."""
    wild = {t: n for t, n in nodes.items() if any(s.startswith("*") for s in t.split("/"))}
    deepest = max((i for t in wild for i, s in enumerate(t.split("/")) if s.startswith("*")), default=0)
    branch = {t: tuple(t.split("/", deepest + 1)) for t in wild}
    for level in range(deepest + 1, 0, -1):
        counts: dict[tuple, list[int]] = {}
        for t, b in branch.items():
            had = counts.setdefault(b, [0, 0])
            had[0], had[1] = had[0] + wild[t][0], had[1] + wild[t][1]
        families: dict[tuple, list[tuple]] = {}
        for b, (labelled, _) in counts.items():
            if len(b) > level and (b[level].startswith("*") or labelled):
                families.setdefault((b[level].startswith("*"), b[:level], b[level + 1 :]), []).append(b)
        for (is_wild, before, after), members in families.items():
            total, blocked = (sum(counts[b][k] for b in members) for k in (0, 1))
            if not total or len(members) < 2:
                continue
            share = blocked / total
            for b in members:
                n, own = counts[b]
                if n and abs(share - own / n) > urls.SIGNIFICANT * ((share * (1 - share) / n) ** 0.5 + 1 / n):
                    continue
                for t in [t for t, old in branch.items() if old == b]:
                    branch[t] = (*before, urls.MERGED_WILD if is_wild else urls.MERGED_NAMES, *after)
    pooled: dict[tuple, list[int]] = {}
    for t, b in branch.items():
        had = pooled.setdefault(b, [0, 0])
        had[0], had[1] = had[0] + wild[t][0], had[1] + wild[t][1]
    bad = {b for b, (n, own) in pooled.items() if (own + urls.SMOOTHING / 2) / (n + urls.SMOOTHING) >= urls.PURITY}
    return {t for t, b in branch.items() if b in bad}


COUNTED = "host string, template string, parent string, labelled long, blocked long"


def test_branches_are_merged_from_below(spark):
    rows = [("h", f"/news/{y}/*", f"/news/{y}", 2, 2) for y in range(2018, 2022)]  # two labels each: too few alone
    rows += [("h", "/news/2022/*", "/news/2022", 0, 0), ("h", "/shop/2020/*", "/shop/2020", 60, 0)]
    rows += [("h", f"/a/{k}/*.{e}", f"/a/{k}", 1, 1) for k in "xy" for e in ("html", "pdf")] + [("g", "/news/2018/*", "/news/2018", 2, 2)]
    found = {(r.host, r.template) for r in urls.rejected_templates(spark.createDataFrame(rows, COUNTED)).collect()}
    assert found == {("h", f"/news/{y}/*") for y in range(2018, 2022)} | {("h", f"/a/{k}/*.{e}") for k in "xy" for e in ("html", "pdf")}


def test_merging_against_brute_force(spark):
    dice = random.Random(7)
    hosts: dict[str, dict[str, tuple[int, int]]] = {}
    for h in range(12):
        for _ in range(40):
            parts = [dice.choice(["a", "b", "c", "*", "*.html", "\\*"]) for _ in range(dice.randint(1, 4))]
            n = dice.choice([0, 0, 1, 3, 20, 200])
            hosts.setdefault(f"h{h}", {})["/" + "/".join(parts)] = (n, dice.choice([0, n, n, n // 2, n - n // 10]))
    rows = [(h, t, "", n, b) for h, nodes in hosts.items() for t, (n, b) in nodes.items()]
    deepest = max(i for _, t, *_ in rows for i, s in enumerate(t.split("/")) if s.startswith("*"))
    found = {(r.host, r.template) for r in urls.rejected_templates(spark.createDataFrame(rows, COUNTED)).collect()}
    expected = set()
    for h, nodes in hosts.items():
        # The levels told apart are those of the whole table: a host without the deepest wildcard gets it without labels.
        expected |= {(h, t) for t in brute_rejected({**nodes, "/" * deepest + "*": (0, 0)} if deepest > 1 else nodes)}
    assert found == {(h, t) for h, t in expected if t in hosts[h]} and len(found) > 20


def test_empty(spark):
    assert urls.judged(pages(spark, []).where(F.lit(True)), URL_RULES).count() == 0

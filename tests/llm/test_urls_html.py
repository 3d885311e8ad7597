"""Operators 2 and 5: brute-force parts and verdicts, planted pages."""

import random
import re
import tracemalloc
from collections import Counter
from itertools import combinations

import pytest

from pluvio.llm import html, urls


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    best = None
    for rule, verdict in urls.RULES:
        suffix, _, prefix = rule.partition("/")
        if (host == suffix or host.endswith("." + suffix)) and path.startswith("/" + prefix) and (not best or len(rule) > len(best[0])):
            best = rule, verdict
    return best


ODD = [None, "", "no host", "http://", "http://ORG/x", "https://a.Example.org/es/1?u=http://b.com/de/", "x://example.org/es", "http://example.org",
       "http://notorg/x", "http://badexample.org/es/a", "ftp://a.com/de/#x", "http://a.com?/de/", "http://a.com/fr/é", "http://a.b.c.com/fr/x\ny?z",
       "http://ÀB.net/", "://a.org/", "http://example.org/en/1", "http://www.example.org/en/19"]


def test_parts_and_rules(spark):
    rows = [(i, u, f"x{i}") for i, u in enumerate(ODD)] + [(None, ODD[4], "x"), (4, ODD[4], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    none = urls.mine_rules(spark.createDataFrame([], "url string, bad boolean"))
    got = Counter(tuple(r) for r in urls.judge_urls(pages, none).select("page_id", "host", "path", "rule", "verdict").collect())
    want = Counter()
    for i, u, _ in rows:
        host, path = brute_parts(u)
        rule = brute_rule(host, path)
        want[i, host, path, rule and rule[0], rule[1] if rule else "allow"] += 1
    assert got == want
    assert urls.judge_urls(pages.filter("false"), none).count() == 0


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    rows = []
    for i in range(600):
        host, lang = rng.choice(["pills.a.net", "b.net", "news.c.net", "d.com"]), rng.choice(["de", "en", "fr"])
        url = f"http://{host}/{lang}/{rng.randint(1, 5)}" + rng.choice(["", "?utm=1", "?ref=x&page=2"])
        bad = host == "pills.a.net" or (host == "b.net" and lang == "fr") or rng.random() < 0.05
        rows.append((url, bad))
    return rows + rows[:50] + [(None, True)]


@pytest.mark.parametrize("wide", [urls.WIDE, 1])
def test_mined_rules_are_those_of_brute_force(spark, labelled, wide, monkeypatch):
    used = []
    for name in ("_by_growth", "_by_levels"):
        monkeypatch.setattr(urls, name, lambda *a, way=getattr(urls, name), name=name: used.append(name) or way(*a))
    mined = urls.mine_rules(spark.createDataFrame(labelled, "url string, bad boolean"), support=0.02, wide=wide)
    assert used == ["_by_growth" if wide > 1 else "_by_levels"]
    got = {tuple(sorted(r["tokens"])): (round(r["confidence"], 9), round(r["support"], 9)) for r in mined.collect()}
    tokens = {r["url"]: r["t"] for r in spark.createDataFrame([(u,) for u, _ in labelled if u], "url string").distinct()
              .select("url", urls.url_tokens(urls.F.col("url")).alias("t")).collect()}
    bad = {}
    for u, b in labelled:
        if u:
            bad[u] = bad.get(u, False) or b
    have, hits = Counter(), Counter()
    for u, t in tokens.items():
        for n in range(1, len(t) + 1):
            for c in combinations(sorted(t), n):
                have[c] += 1
                hits[c] += bad[u]
    least = max(0.02 * len(tokens), urls.LEAST)
    rules = {c: hits[c] / have[c] for c in have if hits[c] >= least and hits[c] / have[c] >= 0.8}
    rules = {c: v for c, v in rules.items() if not any(set(o) < set(c) and w >= v for o, w in rules.items())}
    assert got == {c: (round(v, 9), round(hits[c] / len(tokens), 9)) for c, v in rules.items()} and got

    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(labelled)], "page_id long, url string")
    for bound in (50_000, -1):
        urls.BROADCAST_RULES, before = bound, urls.BROADCAST_RULES
        verdicts = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(pages, mined).collect()}
        urls.BROADCAST_RULES = before
        for i, (u, _) in enumerate(labelled):
            rule = brute_rule(*brute_parts(u))
            hit = u is not None and any(set(c) <= set(tokens[u]) for c in rules)
            assert verdicts[i] == (rule or (None, "block" if hit else "allow"))


def test_support_is_the_same_number_of_urls_at_any_size(spark):
    n = 8_000
    labelled = spark.range(n).selectExpr("concat('http://h', if(id < 12, 'bad', cast(id % 900 as string)), '.net/', id) as url", "id < 12 as bad")
    mined = {tuple(r["tokens"]) for r in urls.mine_rules(labelled).collect()}
    assert mined == {("host=hbad.net",), ("label=hbad",)}  # 12 of 8,000 urls: below a share of 0.002


def test_tokens_at_any_place_of_a_url(spark):
    deep = "/".join(f"s{k}" for k in range(40))
    made = {"a": "http://h{0}.net/a/b/c/d/{1}/{0}", "b": "http://h{0}.net/?a=1&b=2&c=3&d=4&e=5&{1}={0}", "c": "http://{1}.x{0}.b.c.d.e.net/", "d": "http://deep.net/" + deep + "/{1}/{0}"}
    rows = [(form.format(i, mark), mark == "spam") for form in made.values() for i in range(20) for mark in ("spam", "fine")]
    mined = urls.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"))
    assert {tuple(r["tokens"]) for r in mined.collect()} == {("step4=spam",), ("name=spam",), ("label=spam",), ("step40=spam",)}
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages, mined, ()).collect()}
    assert got == {i: "block" if bad else "allow" for i, (_, bad) in enumerate(rows)}


# ---- 5 html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
<nav><ul><li><a href="/x">Menu one</a><li>Menu two</ul></nav><!-- ad <p>hidden</p> --><div class="box ad">Buy <b>now</div>
<article><h1>Title &amp; more</h1><p><b>First  line<br>second&nbsp;line <i>goes</i> on<p>Caf&eacute; &#233; &#x1F600;<form>name <input></form>
<section class="comments"><p>nice post</p></section><ul><li>item<li>item</ul></article><aside>side</aside><footer>&copy; me</footer></body></html>"""


def test_page_lines():
    kept = [t for k, t in html.page_lines(PAGE) if k == html.KEPT]
    assert kept == ["Title & more", "First line", "second line goes on", "Café é 😀", "item", "item"]
    assert html.page_lines("") == [] and html.page_lines("<") == [(1, "<")]
    assert [t for _, t in html.page_lines("a <b>b</b> c<!-- open")] == ["a b c"]
    assert len(html.page_lines("<p>x" * 20_000)) == 20_000
    assert html.page_lines("<div>" * 5000 + "deep")[0][1] == "deep"


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = html.common_lines(a, b)
        assert len(pairs) == brute_lcs(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_common_lines_of_very_long_pages():
    rng = random.Random(2)
    a, b = ([rng.randint(0, 40) for _ in range(rng.randint(150, 400))] for _ in range(2))
    assert len(html.common_lines(a, b)) == brute_lcs(a, b)
    tracemalloc.start()
    a = [k * 7 % 30_011 for k in range(30_000)]
    pairs = html.common_lines(a, [k * 11 % 30_011 for k in range(30_000)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert peak < 60 << 20  # a row of bits for every line would be 110 MB


def test_marks_need_evidence_on_text_and_articles():
    def kept(page):
        return [t for k, t in html.page_lines(page) if k != html.OUT]

    assert kept('<article class="share-price"><p>real text</p></article>') == ["real text"]
    assert kept('<article><p class="share-prices">one</p><p class="social housing">two</p><h2 id="search-and-rescue">three</h2></article>') == ["one", "two", "three"]
    assert kept('<article>x<p class="ad">buy</p><p class="advert banner">buy</p><li class="social-share">tell</li></article>') == ["x"]
    assert kept('<article class="comment-body"><p>nice</p></article><article class="related post">more</article><article class="ad">buy</article>') == []
    assert kept('<div class="share-tools">tell</div><div id="comments"><article>nice</article></div><div class="story">text</div>') == ["text"]


def open_page(i, shared=True):
    own = "".join(f"<p>own text {i} of block {k} with some more words in it</p>" for k in range(4))
    return f"<html><body><div><p>Welcome to our site</p></div>{own}<p>All rights {'kept' if shared else i}</p></body></html>"


def own_text(i):
    return "\n".join(f"own text {i} of block {k} with some more words in it" for k in range(4))


def test_shared_lines_go_between_nearest_pages(spark):
    rows = [(i, f"http://h.com/a/{i}", open_page(i)) for i in range(5)]
    rows += [(10, "http://lone.com/a", open_page(10)), (11, None, open_page(11)), (12, "http://e.com/", None), (None, "http://e.com/1", ""),
             (13, "http://h.com/z", PAGE), (14, "http://copy.com/1", open_page(14)), (15, "http://copy.com/1?x", open_page(14)), (0, rows[0][1], rows[0][2])]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    text = Counter((r["page_id"], r["url"], r["text"]) for r in got)
    whole = "Welcome to our site\n{}\nAll rights kept"
    want = Counter({(i, f"http://h.com/a/{i}", own_text(i)): 1 + (i == 0) for i in range(4)})
    # the last of an odd number of pages is compared with the two before it; PAGE ends that host
    want[4, "http://h.com/a/4", whole.format(own_text(4))] += 1
    for i, url in ((10, rows[5][1]), (11, None)):
        want[i, url, whole.format(own_text(i))] += 1
    for url in ("http://copy.com/1", "http://copy.com/1?x"):
        want[14 + url.endswith("x"), url, whole.format(own_text(14))] += 1
    want[12, "http://e.com/", ""] += 1
    want[None, "http://e.com/1", ""] += 1
    want[13, "http://h.com/z", "Title & more\nFirst line\nsecond line goes on\nCafé é 😀\nitem\nitem"] += 1
    assert text == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").filter("false")).count() == 0


def test_text_beside_and_in_main_elements(spark):
    def page(i):
        body = "".join(f"<div>body {i} part {k} of the real text that stands in plain elements</div>" for k in range(4))
        own = f"<p>teaser {i} goes on with a good many words of its own to tell it from the others</p>"
        return f"<div>Welcome to all of our pages</div>{body}<article>{own}</article><article class='comment'><p>nice {i}</p></article>"

    want = {i: "\n".join([f"body {i} part {k} of the real text that stands in plain elements" for k in range(4)]
                         + [f"teaser {i} goes on with a good many words of its own to tell it from the others"]) for i in range(4)}
    # one article with other things beside it, by two urls: a copy
    rows = [(i, f"http://h.com/{i}", page(i)) for i in range(4)]
    rows += [(8 + i, f"http://copy.com/{i}", f"<article><p>one article on two pages</p></article><div>seen {i} times</div>") for i in range(2)]
    want |= {8 + i: f"one article on two pages\nseen {i} times" for i in range(2)}
    for limit in (html.BROADCAST_BYTES, -1):
        html.BROADCAST_BYTES, before = limit, html.BROADCAST_BYTES
        got = {r["page_id"]: r["text"] for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        html.BROADCAST_BYTES = before
        assert got == want


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract_text(pages).collect()}
    from html import unescape
    for r in pages.collect():
        body = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"<(?:/?(?:p|h1|div|ul|li|section)(?:\s[^>]*)?|br\s*/?)>", body)
        plain = [re.sub(r"\s+", " ", unescape(re.sub("<[^>]*>", "", x))).strip() for x in parts]
        assert got[r["page_id"]] == "\n".join(x for x in plain if x)

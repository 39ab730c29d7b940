"""HTML extraction: blocks, alignment, nearest pages and edge cases."""

import os
import random
import re

from rowcast.llm import htmldiff as H

DDL = "page_id long, url string, html string, key long, lines string, shared int, text string"


def page(body, host="a.org", path="/x", i=0):
    return (i, f"http://{host}{path}", body, 1, "l", 2, "t")


def lines(html):
    return [x for x, _ in H.page_lines(html)]


def test_blocks():
    assert lines("<html><head><title>t</title></head><body><p>a <b>b</b>\n c<br>d<p>e&amp;&#233;&nbsp;f</body>") == ["a b c d", "e&é f"]
    assert lines("<nav>menu</nav><article><h1>T</h1><p>x</p><div class='ad'>buy</div><p>y</p></article><footer>f</footer>") == ["T", "x", "y"]
    assert lines("<script>var t='</p>';</script><style>p{}</style><p>a<!-- no --> b</p>") == ["a b"]
    assert lines("<div class='site-header'>h</div><div id=sidebar>s</div><div role=navigation>n</div><p hidden>z</p><p>a</p>") == ["a"]
    assert lines("<article><header><h1>T</h1></header><p>x</p><section class='comments'><p>c</p></section></article>") == ["T", "x"]
    assert lines("<p class=notice>gone<p>stays<aside>gone<p>gone</aside>tail") == ["stays", "tail"]
    assert lines("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert lines("<main><p>m</p></main><p>outside</p>") == ["m"]
    assert lines("plain & <unclosed <p>text") in (["plain &"], ["plain & text"], ["plain &", "text"])
    assert lines("") == [] and lines("<") == ["<"] and lines("<p>cut &am") == ["cut &am"]
    assert lines("<article><p>x</p><form><p>f</p></form><button>b</button></article><!-- open") == ["x"]


def test_common_lines_is_longest():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, last = [0], row
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
        return row[-1]
    rnd = random.Random(0)
    for _ in range(200):
        a, b = [rnd.randrange(6) for _ in range(rnd.randrange(20))], [rnd.randrange(6) for _ in range(rnd.randrange(20))]
        got = H.common_lines(a, b)
        assert len(got) == length(a, b) and got == sorted(got)
        at = iter(b)
        assert all(any(a[i] == y for y in at) for i in got)


def test_shared_lines_go_and_prose_stays(spark):
    rows = [page(f"<div>Site {k}</div><div>Everywhere</div><p>own text {k}</p><p>more {k}</p><div>Bottom line</div>", path=f"/n/{k}", i=k)
            for k in range(6)]
    rows += [page(f"<article><p>quoted line</p><p>own {k}</p><p class='x'>Read our letter</p></article>", "b.org", f"/{k}", 10 + k)
             for k in range(4)]
    rows += [page("<p>same</p><p>copy</p>", "c.org", f"/{k}", 20 + k) for k in range(2)]
    rows += [page("<div>Everywhere</div><p>alone</p>", "d.org", "/", 30)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, DDL)).collect()}
    assert got[3] == "Site 3\nown text 3\nmore 3" and got[12] == "quoted line\nown 2"
    assert got[20] == "same\ncopy" and got[30] == "Everywhere\nalone"


def test_nearest_is_the_longest_common_path(spark):
    rows = [(1, "h", "/a/1"), (2, "h", "/a/12"), (3, "h", "/b/9"), (4, "h", "/b/98"), (5, "g", "/a/1")]
    df = spark.createDataFrame([(f"http://{h}{p}", k) for k, h, p in rows], "url string, key long")
    assert {r.key: r.other for r in H.nearest(df).collect()} == {1: 2, 2: 1, 3: 4, 4: 3}


def test_edges(spark):
    long = "<p>" + "</p><p>".join(f"line {i}" for i in range(20_000)) + "</p>"
    rows = [page(None, i=1), page("", i=2), page("<p>x</p>", i=3), page("<p>x</p>", i=3), page(long, i=4),
            (None, None, "<p>no url</p>", 1, "l", 2, "t"), (6, "nothing", "<p>z &lt;b&gt;</p>", 1, "l", 2, "t")]
    df = spark.createDataFrame(rows, DDL)
    got = H.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    have = [(r.page_id, r.text, r.n_chars) for r in got.collect()]
    assert len(have) == 7 and have.count((3, "x", 1)) == 2 and (1, "", 0) in have and (2, "", 0) in have
    assert (None, "no url", 6) in have and (6, "z <b>", 5) in have
    assert next(n for i, _, n in have if i == 4) == sum(len(f"line {i}") + 1 for i in range(20_000)) - 1
    assert H.extract(df.limit(0)).count() == 0


def test_site_lines_inside_an_article_go(spark):
    def article(k):
        own = "".join(f"<p>own {k} {i}</p>" for i in range(5))
        return f"<article><h1>Title {k}</h1>{own}<div>Subscribe to us</div><p>more {k}</p><p>Yours, the editors</p></article>"
    rows = [page(article(k), "a.org", f"/n/{k}", k) for k in range(6)]
    rows += [page(article(k), "b.org", f"/n/{k}", k) for k in (10, 11)]
    # a sentence that two of many articles quote, and versions of one article
    rows += [page(f"<article>{'<p>Quoted</p>' * (k < 2)}<p>a {k}</p><p>b {k}</p><p>c {k}</p></article>", "c.org", f"/{k}", 20 + k) for k in range(6)]
    rows += [page(f"<article><p>one</p><p>two</p><p>version {k}</p><p>three</p></article>", "d.org", f"/{k}", 30 + k) for k in range(6)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, DDL)).collect()}
    own = "\n".join(f"own 3 {i}" for i in range(5))
    assert got[3] == f"Title 3\n{own}\nmore 3"
    assert got[10].endswith("Subscribe to us\nmore 10") and got[10].startswith("Title 10")
    assert got[20] == "Quoted\na 0\nb 0\nc 0" and got[31] == "one\ntwo\nversion 1\nthree"


def test_much_chrome_and_copies(spark):
    menu = "".join(f"<p>menu {i}</p>" for i in range(20))
    rows = [page(f"{menu}<p>text {k}</p>", "a.org", f"/{k}", k) for k in range(5)]
    # copies by query, between pages that differ
    rows += [page(f"<p>top</p><p>text {k // 4}</p><p>more {k // 4}</p><p>end</p>", "b.org", f"/{k // 4}?v={k}", 10 + k) for k in range(12)]
    # the nearest page has all of the lines, the next one tells
    rows += [page(x, "c.org", p, 30 + i) for i, (x, p) in enumerate(
        [("<p>top</p><p>a</p>", "/a"), ("<p>top</p><p>a</p><p>b</p>", "/aa"), ("<p>top</p><p>z</p>", "/b")])]
    # two versions of a page, and others
    rows += [page("<p>top</p>" + "".join(f"<p>line {i}</p>" for i in range(20)) + f"<p>seen {k} times</p>", "d.org", f"/n/1?v={k}", 40 + k)
             for k in range(2)]
    rows += [page(f"<p>top</p><p>other {k}</p>", "d.org", f"/n/{k}", 50 + k) for k in range(2, 4)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, DDL)).collect()}
    assert [got[k] for k in range(5)] == [f"text {k}" for k in range(5)]
    assert [got[10 + k] for k in range(12)] == [f"text {k // 4}\nmore {k // 4}" for k in range(12)]
    assert got[30] == "a" and got[31] == "b" and got[32] == "z"
    assert got[40].startswith("line 0\nline 1\n") and got[40].endswith("seen 0 times")


def test_names_drop_no_article():
    art = "<article><h1>T</h1><p>x</p></article>"
    for wrap in ("div class='has-sidebar'", "div id='search-results'", "div class=widget", "form", "div class='layout sidebar'", "aside",
                 "div hidden", "td class=promo", "section role=search"):
        tag = wrap.split()[0]
        assert lines(f"<div class=menu>m</div><{wrap}><p>around</p>{art}</{tag}><footer>f</footer>") == ["T", "x"], wrap
    assert lines(f"<div class=sidebar>{art}<p>never closed") == ["T", "x"]
    assert lines("<main><h1>T</h1><div class=promo><article><p>x</p></article></div></main>") == ["T", "x"]
    assert lines("<div class=related><main><p>x</p></main></div>") == ["x"]
    # beside an article they are what they say
    assert lines(f"{art}<div class=related><article><p>teaser</p></article></div><aside><article>z</article></aside>") == ["T", "x"]
    assert lines("<article><p>x</p><section class=comments><article>c</article></section><p>y</p></article>") == ["x", "y"]
    for name in ("post-tags-body", "share-text", "commentary", "has-sidebar", "ad-free", "no-comments"):
        assert lines(f"<article><div class='{name}'><p>prose</p></div></article>") == ["prose"], name
        assert lines(f"<div id='{name}'><p>prose</p></div>") == ["prose"], name
    for name in ("post-tags", "site-footer", "x comments", "left_sidebar", "cookie-banner", "advertisement"):
        assert lines(f"<div class='{name}'><p>gone</p></div><p>prose</p>") == ["prose"], name


def test_reading_is_linear():
    """A megabyte of unclosed, stray or deeply nested tags is one pass."""
    import time

    many = 70_000
    for html, want in (("<div class=ad>x" * many, []), ("<b>" * many + "</i>" * many, []), ("<li><div>" + "<b>" * many + "<li></li>" * many, []),
                       ("<div class=ad>" * many + "<article>a</article>" + "</div>" * many, ["a"]),
                       ("<b>" * many + "<div></div>" * many, []), ("<a b=\"" * many, [])):
        began = time.time()
        assert lines(html) == want
        assert time.time() - began < 60  # quadratic reading took hours


def test_no_article_paragraph_is_lost(spark):
    """Whole articles of the given pages: sentences that many hosts quote stay."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    want = {r.page_id: "\n".join(lines(r.html or "")) for r in pages.collect()}
    assert len(got) == 2500 and got == want


def brute(rows):
    """The whole query by plain loops over all pages."""
    parsed = [(i, H.page_lines(html or ""), *place(url)) for i, url, html in rows]
    pages = {}  # copies are one page, at the first of their paths
    for _, ls, host, path in parsed:
        pages.setdefault(H._key(host, ls), [host, path, ls])
        pages[H._key(host, ls)][1] = min(pages[H._key(host, ls)][1], path)
    order = sorted(pages, key=lambda k: (pages[k][0].encode(), pages[k][1].encode(), k))
    gone = {}
    for n, k in enumerate(order):
        near = []
        for d in H.STEPS:
            for m in (n - d, n + d):
                if 0 <= m < len(order) and pages[order[m]][0] == pages[k][0]:
                    near.append((-len(os.path.commonprefix([pages[k][1], pages[order[m]][1]])), d, order[m]))
        own = pages[k][2]
        hashed = lambda ls: (H._hashed(ls), [m for _, m in ls])
        sure, maybe = H.site_lines(*hashed(own), [hashed(pages[o][2]) for *_, o in sorted(near)])
        gone[k] = set(sure)
        for i in maybe:
            def share(host_is):
                some = [p for p in pages.values() if (p[0] == pages[k][0]) == host_is]
                return sum(own[i][0] in [x for x, _ in p[2]] for p in some) / max(1, len(some))
            if share(True) >= H.FAR * share(False) or share(True) >= max(0.5, H.NEAR * share(False)):
                gone[k].add(i)
    return sorted((i, "\n".join(x for j, (x, _) in enumerate(ls) if j not in gone[H._key(host, ls)])) for i, ls, host, path in parsed)


def place(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", "")


def test_query_against_brute_force(spark):
    rnd = random.Random(4)
    quotes = [f"quote {i}" for i in range(6)]
    rows = []
    for i in range(120):
        host = f"h{rnd.randrange(5)}.org"
        own = [f"<p>{rnd.choice([*quotes, f'own {i} {j}', f'own {i} {j}'])}</p>" for j in range(rnd.randrange(1, 7))]
        if host < "h3":
            body = f"<div>Top of {host}</div><article>{''.join(own)}<p>Yours, {host}</p></article>"
        else:
            body = f"<div>Top of {host}</div>{''.join(own)}<div>Bottom</div>"
        rows.append((i, f"http://{host}/{rnd.choice('abc')}/{rnd.randrange(30)}?q={i % 3}", body))
    rows += [(200 + i, u, b) for i, (_, u, b) in enumerate(rows[:15])]
    df = spark.createDataFrame([(*r, 1, "l", 2, "t") for r in rows], DDL)
    got = sorted((r.page_id, r.text) for r in H.extract(df).collect())
    assert got == brute(rows)
    signed = sum("Yours" in b for *_, b in rows)
    assert signed > 50 and sum("Yours" in t for _, t in got) < signed / 2

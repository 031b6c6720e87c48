"""Page extraction (H1-H5) on hand-written, partly malformed HTML."""

from __future__ import annotations

import random

import pyarrow as pa

from tidemark.operators import pages as P

ARTICLE = """<html><body><div id="topbar">nav</div>
<div id="main-content"><div class="article-metaline">作者 x</div>
<div class="article-metaline-right">看板 y</div>
第一行<p>第二行<b>粗體</b>
<div class="push">推 好</div>


最後
--
※ 發信站
</div></body></html>"""

LISTING = """<div class="r-ent"><div class="title"><a href="/bbs/x/M.1.html">標題一</a></div>
<div class="date"> 4/10</div></div>
<div class="r-ent"><div class="title">(本文已被刪除)</div><div class="date">4/11</div></div>
<div class="r-ent"><div class="title"><a href="/bbs/x/M.3.html">標題三</a></div></div>"""

CHAIN = """<h3> 半導體產業鏈簡介</h3>
<noscript><div id="companyList_Z9"><a href="company_basic.php?stk_code=9999">隱藏</a></div></noscript>
<div id="companyList_A1" title=" 上游 ">
<table><tr><td><b>上市公司</b></td><td>
<a href="company_basic.php?stk_code=2330" title="台積電">x</a>
<a href="company_basic.php?stk_code=abc">無代碼</a></td></tr>
<tr><td>no bold</td><td><a href="company_basic.php?stk_code=2303">聯電</a></td></tr></table>
</div>
<div id="companyList_b-2"><a href="company_basic.php?stk_code=3105">穩懋<p>unclosed</div>"""


def main_of(spark, html, container, drop):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    return P.extract_main(df, container=container, drop=drop).first()["text"]


def test_main_text_drops_blocks_and_cuts_signature(spark):
    text = main_of(spark, ARTICLE, "div#main-content", ["div.article-metaline", "div.article-metaline-right", "div.push"])
    assert text == "第一行\n第二行\n粗體\n\n最後"
    assert main_of(spark, "<p>no container</p>", "div#main-content", []) == ""
    assert main_of(spark, None, "div#main-content", []) == ""
    assert main_of(spark, "<article>a<script>x</script><nav>n</nav></b> b", "article", ["nav"]) == "a\n b"


def test_listing_rows_skip_deleted_and_default_date(spark):
    df = spark.createDataFrame([(1, LISTING)], "page_id long, html string")
    rows = [tuple(r)[1:] for r in P.extract_links(df, base="https://h").orderBy("pos").collect()]
    assert rows == [(0, "標題一", "https://h/bbs/x/M.1.html", "4/10"),
                    (1, "標題三", "https://h/bbs/x/M.3.html", "")]


def test_chain_page_rows(spark):
    df = spark.createDataFrame([("IC01", CHAIN)], "chain_ic string, html string")
    rows = P.extract_chain_rows(df).collect()
    assert [tuple(r)[1:6] for r in rows] == [
        ("A1", "上游", "上市公司", "2330", "台積電"),
        ("A1", "上游", "", "2303", "聯電"),
        ("b-2", "", "", "3105", "穩懋unclosed"),
    ]


def test_pages_ten_thousand_elements_deep(spark):
    deep = "<article>" + "<b><p>" * 5_000 + "text"
    assert main_of(spark, deep, "article", ["nav"]) == "text"
    nodes = P.read_nodes(deep + "</i></b></article>after")
    assert nodes[0]["end"] == len(nodes) - 2 and nodes[-1]["text"] == "after"


def test_spark_extractors(spark):
    pages = spark.createDataFrame([(1, "u1", ARTICLE), (2, "u2", LISTING)], "page_id long, url string, html string")
    main = {r["page_id"]: r["text"] for r in P.extract_main(pages).collect()}
    assert main[2] == "" and main[1].endswith("最後")
    links = P.extract_links(pages, base="https://h").collect()
    assert [(r["page_id"], r["pos"], r["date"]) for r in links] == [(2, 0, "4/10"), (2, 1, "")]
    chains = spark.createDataFrame([("IC01", CHAIN)], "chain_ic string, html string")
    got = P.extract_chain_rows(chains).collect()
    assert {r["chain_topic"] for r in got} == {"半導體"} and len(got) == 3
    m = P.extract_matches(pages, "html", r'href="([^"]+)"').collect()
    assert [(r["pos"], r["match"]) for r in m] == [(0, "/bbs/x/M.1.html"), (1, "/bbs/x/M.3.html")]


INDEX = """<div class="item"><a class="link"><span class="txt"> 電子 </span></a>
<div class="item"><a class="link"><span class="txt">半導體</span></a><a href="introduce.php?ic=D000">IC</a></div>
<a href="introduce.php?ic=E100&x=1">next</a><span class="itemLink" onclick="go('introduce.php?ic=D000')">IC</span></div>
<a href="introduce.php?ic=F200">alone</a><a href="introduce.php?ic=">none</a><span class="itemLink">no link</span>"""


def test_chain_index_takes_the_innermost_item_and_lists_links_first(spark):
    df = spark.createDataFrame([(1, INDEX), (2, None)], "page_id long, html string")
    rows = [tuple(r) for r in P.extract_chain_index(df).orderBy("page_id", "pos").collect()]
    assert rows == [(1, 0, "D000", "半導體"), (1, 1, "E100", "電子"), (1, 2, "F200", ""), (1, 3, "D000", "電子")]


def walk(following, start):
    """Pages in the order in which a reader sees them, each once."""
    out = []
    while start is not None and start in following and start not in out:
        out.append(start)
        start = following[start]
    return out


def test_listing_order_equals_a_walk(spark):
    following = {f"a{i}": f"a{i + 1}" for i in range(1000)} | {"a1000": None}  # a thousand pages
    following |= {"b0": None, "c0": "c1", "c1": "c2", "c2": "c0"}  # one page; a circle
    following |= {f"d{i}": f"d{i + 1}" for i in range(20)} | {"d20": "d7"}  # back into the middle
    following |= {"e0": "lost", "f0": "a990"}  # a page that did not land; the end of another listing
    pages = spark.createDataFrame(list(following.items()), "page string, next_page string")
    starts = ["a0", "b0", "c0", "d0", "e0", "f0", "d10", "none"]
    got = {}
    for r in P.listing_order(pages, spark.createDataFrame([(s, s) for s in starts], "start string, page string")).collect():
        got.setdefault(r["start"], {})[r["rank"]] = r["page"]
    assert {s: [v[i] for i in range(len(v))] for s, v in got.items()} == {s: walk(following, s) for s in starts if s != "none"}


def test_next_page_button(spark):
    html = ['<a class="btn wide" href="/old">最舊</a><a class="btn wide" href="/p1">&lsaquo; 上頁</a><a class="btn wide" href="/n">下頁</a>',
            '<a class="btn wide">&lsaquo; 上頁</a>', '<a class="btn" href="/x">上頁</a>', '<a class="wide btn on" href=""> 上頁 </a>', "", None]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    got = {r["page_id"]: r["next_url"] for r in P.extract_next(df, base="https://b").collect()}
    assert got == {0: "https://b/p1", 1: None, 2: None, 3: None, 4: None, 5: None}


def rows_by_nodes(html, row, link, date):
    """The rules of H2 over all nodes of a page, in plain Python."""
    nodes, wanted = P.read_nodes(html), [P._compiled(x) for x in (row, link, date)]

    def fits(n, sel):
        if n["tag"] == "#text" or not P._fits(sel[-1], n["tag"], dict(n["attrs"])):
            return False
        return len(sel) == 1 or any(fits(o, sel[:-1]) for o in nodes if o["at"] < n["at"] <= o["end"])

    def first(r, sel):
        return next((n for n in nodes if r["at"] < n["at"] <= r["end"] and fits(n, sel)), None)

    def text(n):
        return "".join(t["text"].strip() for t in nodes if n and n["at"] < t["at"] <= n["end"] and t["tag"] == "#text" and t["shown"])

    found = [(first(r, wanted[1]), first(r, wanted[2])) for r in nodes if fits(r, wanted[0])]
    return [(text(a), dict(a["attrs"])["href"], text(d)) for a, d in found if a and "href" in dict(a["attrs"])]


def test_entries_of_nested_and_broken_pages_equal_the_rules_over_all_nodes(spark):
    rng, bits = random.Random(3), ['<ul class="x y">', "</ul>", "<li>", "</li>", '<a href="/1">', "<a>", "</a>", "<b> t ", "</b>", "<span class='date'>", "</span>",
                                   "<script>", "</script>", "w &amp; ", "<br>", "<a href='/2' />", "</p>", '<div id="m">', "</div>"]
    pages = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(300)]
    df = spark.createDataFrame([*pages, (300, None)], "page_id long, html string")
    for row, link, date in (("li", "a", "span.date"), ("ul.y li", "div#m a[href]", "b"), ("li", "ul a[href^=/]", "li span")):
        got = [tuple(r) for r in P.extract_links(df, row=row, link=link, date=date).orderBy("page_id", "pos").collect()]
        assert got == [(i, pos, *e) for i, h in pages for pos, e in enumerate(rows_by_nodes(h, row, link, date))]
        assert len(got) >= 5


def test_a_task_holds_few_nodes_at_a_time(monkeypatch):
    """the nodes of a batch of 10,000 pages were held at once, an entry with its page."""
    monkeypatch.setattr(P, "SLICE", 10)
    html = pa.array(["<li>a</li>" * 3, None, "<li>b</li>" * 9, "<p>"])
    slices = list(P._slices(html, P.read_nodes, len))
    assert [(a, len(p)) for a, p in slices] == [(0, 3), (3, 1)]
    picked = P.read_picked('<div class="r-ent"><div class="title"><a href="/o/1">x</a></div></div>' * 1000 + "<p>y" * 1000, [P._compiled("div.r-ent"), P._compiled("div.title a")])
    assert len(picked) == 2000 and len(P._entries(picked)) == 1000


def test_entries_leave_a_page_while_it_is_read(monkeypatch):
    """F3 of round 4: all picked elements of a page stood in the task until its end."""
    import pyarrow as pa
    html = ("<p>a &amp; b < c<br>" + "".join(
        f'<div class="r-ent"><div class="title"><a href="/o/{i}" title="x<y"> N° {i} &lt;{i}<b>! </b></a></div><!-- <a href=no> --><div class="date">1/{i}</div>'
        + ("" if i % 50 == 7 else "</div>") + ("<input class='r-ent'><div class='r-ent'/>" if i % 9 == 0 else "") for i in range(400)) + "</body>")
    wanted = [P._compiled(x) for x in ("div.r-ent", "div.title a", "div.date")]
    want = P._entries(P.read_picked(html, wanted))
    assert len(want) == 400
    for size in (1, 13, 100, 1 << 18):
        monkeypatch.setattr(P, "PIECE", size)
        assert list(P.read_entries(pa.scalar(html), wanted)) == want, size
    assert list(P.read_entries(pa.scalar(None, pa.string()), wanted)) == []
    most, reader = 0, P._Listing(wanted)
    closed = '<div class="r-ent"><div class="title"><a href="/o/1">x</a></div></div>' * 3000
    for a in range(0, len(closed), 70 * 10):
        reader.feed(closed[a:a + 70 * 10])
        most = max(most, len(reader.rows))
        assert all(title == ["x"] for title, _, _ in reader.taken())
    assert most <= 12 and not reader.picked

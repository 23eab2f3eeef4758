from hypothesis import given, settings, strategies as st

import pytest

from cellscope.llm import html_extract as hx

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>{body}
<footer>&copy; host</footer></body></html>"""


def text(page):
    """The main text's blocks of a page without neighbours."""
    blocks, inside, places = hx.read_blocks(page)
    verdict = hx.Page({"blocks": blocks, "sizes": list(map(len, blocks)), "inside": inside, "places": places,
                       "path": "/"}).judged(None, None)
    return [b for b, v in zip(blocks, verdict, strict=True) if v == hx.KEEP]


@pytest.mark.parametrize("body,want", [
    ("<article><h1>A &amp; B</h1><p><b>x  y\n z.<br><p>q&eacute;&#8211;</article>", ["A & B", "x y z.", "qé–"]),
    ("<main><div id='sidebar'><p>s</p></div><p>one<p>two</main>", ["one", "two"]),
    ("<article><p>a</p><section class='comments'><p>c</p></section><form>f</form><p>b</p></article>", ["a", "b"]),
    ("<div class='content'><ul><li>i<li>j</ul><table><tr><td>c1<td>c2</table></div>", ["i", "j", "c1", "c2"]),
    ("<aside>x</aside><header>h</header><article><header><h2>t</h2></header>p</article>", ["t", "p"]),
    ("<article>5 < 6 and <em>7</em>&nbsp;8</article>", ["5 < 6 and 7 8"]),
    ("<div class='cookie-notice'>c</div><div role='banner'>b</div><div hidden>h</div><p>ok</p>", ["ok"]),
    ("<main><p>lead</p><article><p>story</p></article><div>more</div></main>", ["story"]),
    ("<div class='post has-sidebar'><p>text</p><div class='post-comments'>c</div></div>", ["text"]),
    ("<ul><li><a href=a>A</a><li><a href=b>B</a><li><a href=c>C</a></ul><p>see <a href=d>this</a>.</p>", ["see this."]),
    ("<p>x</p><p><a href=a>A</a></p><p><a href=b>B</a></p>", ["x", "A", "B"]),
    ("<article><div class='article-header'><h1>T</h1></div>t</article>", ["T", "t"]),
    ("<article><p>kept<script>if (a < b) { x('<p>no</p>') }</script> on</p></article>", ["kept on"]),
])
def test_blocks_of_a_page(body, want):
    assert text(PAGE.format(body=body)) == want


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "<p>a", "</p></div>", "<script>x", "<!--", "<div><div><p>x", "<a <b>"])
def test_broken_pages_do_not_crash(page):
    text(page)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_blocks_are_a_longest_common_subsequence(a, b):
    got = hx.common_blocks(a, b)
    picked = [x for x, g in zip(a, got) if g]
    rest = iter(b)
    assert all(x in rest for x in picked)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert len(picked) == best[-1][-1]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, bucket int")


def plain(i, body):
    return f"<html><body><div>Site menu</div>{body}<div>All rights reserved {i // 100}</div></body></html>"


def test_frame_of_a_site_is_told_by_its_neighbours(spark):
    rows = [(i, f"http://h.example/a/{i:03}", plain(i, f"<div>Story {i} first</div><div>Story {i} second, long enough "
             "to be more than the frame of the site</div>"), "x", 1) for i in range(20)]
    rows += [(50, "http://other.example/a/1", plain(1, "<p>Alone here</p>"), "x", 1)]
    got = {r.page_id: r.text for r in hx.extract(frame(spark, rows)).collect()}
    for i in range(20):
        assert got[i] == f"Story {i} first\n\nStory {i} second, long enough to be more than the frame of the site"
    assert "Alone here" in got[50]


def marked(i, mark="article"):
    return (f"<html><body><div>Site menu</div><{mark}><p>Read our daily letter</p><p>Story {i} is told here, longer than "
            f"the frame of its site</p><p>All rights reserved</p></{mark}></body></html>")


@pytest.mark.parametrize("mark", ["article", "main"])
def test_frame_inside_a_marked_article_is_told_by_the_neighbours(spark, mark):
    """By two neighbours: the site's first and last page keep theirs."""
    rows = [(i, f"http://h.example/a/{i:03}", marked(i, mark), None, None) for i in range(20)]
    got = {r.page_id: r.text for r in hx.extract(frame(spark, rows)).collect()}
    story = "Story {} is told here, longer than the frame of its site"
    assert {i: got[i] for i in range(1, 19)} == {i: story.format(i) for i in range(1, 19)}
    assert all(got[i].split("\n\n") == ["Read our daily letter", story.format(i), "All rights reserved"] for i in (0, 19))


def test_shared_lines_of_articles_stay(spark):
    """A line in both neighbours' articles stays: at other places, and at the same place if another host has it."""
    line, rows = "This work is released under a free licence.", []
    for host in ("a", "b"):
        for i in range(9):
            body = [f"Story {host}{i} part {k}, long enough to be its body." for k in range(4)]
            body.insert(i % 3 + 1, line)                                # another place in each article
            body.insert(0, "A quotation that many articles begin with.")
            rows.append((i + 100 * (host == "b"), f"http://{host}.example/{i}",
                         plain(1, "<article>" + "".join(f"<p>{x}</p>" for x in body) + "</article>"), None, None))
    for r in hx.extract(frame(spark, rows)).collect():
        i, host = r.page_id % 100, "b" if r.page_id >= 100 else "a"
        want = [f"Story {host}{i} part {k}, long enough to be its body." for k in range(4)]
        want.insert(i % 3 + 1, line)
        assert r.text.split("\n\n") == ["A quotation that many articles begin with.", *want]


def test_a_page_that_is_mostly_frame(spark):
    menu = "".join(f"<div>Section {k} of the site</div>" for k in range(6))
    rows = [(i, f"http://h.example/{i}", f"<body>{menu}<p>Short news {i}, told in one line.</p>{menu}</body>", None, None)
            for i in range(6)]
    got = {r.page_id: r.text for r in hx.extract(frame(spark, rows)).collect()}
    assert all(got[i] == f"Short news {i}, told in one line." for i in range(1, 5))


def expected(pages):
    """Texts by the rules in the module's docstring, from each page's known (text, place, mark) lines in order of
    their address, with alignment by plain dynamic programming."""
    def aligned(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
        return best[0][0]

    def shared(a, b):
        """Lines in every longest alignment; the cases below have one alone."""
        return {i for i in range(len(a)) if aligned(a[:i] + a[i + 1:], b) < aligned(a, b)}

    out = {}
    for key, (host, n, lines) in pages.items():
        near = [p[2] for m in (n - 1, n + 1) for p in pages.values() if p[:2] == (host, m)]
        size = sum(len(t) for t, _, _ in lines)
        chars = lambda which: sum(len(lines[i][0]) for i in which)
        both = [shared(lines, x) for x in near]
        frame_ = next((x for x in both if chars(x) <= size / 2), None)
        if frame_ is None:
            frame_ = both[0] & both[1] if len(both) == 2 and chars(both[0] & both[1]) <= 0.9 * size else set()
        left = []
        for i, (t, place, mark) in enumerate(lines):
            if i in frame_ and mark:
                start, end = [(t, place, k) for k in (sum(x[2] for x in lines[:i]), -sum(x[2] for x in lines[i:]))]
                there = [[(u, q, sum(x[2] for x in other[:j])) for j, (u, q, m) in enumerate(other) if m]
                         + [(u, q, -sum(x[2] for x in other[j:])) for j, (u, q, m) in enumerate(other) if m] for other in near]
                elsewhere = any(h != host and any(u == t and m for u, _, m in other) for h, _, other in pages.values())
                if len(near) == 2 and not elsewhere and all(start in x or end in x for x in there):
                    continue
            elif i in frame_:
                continue
            left.append((t, mark))
        marked_ = [t for t, mark in left if mark]
        out[key] = "\n\n".join(marked_ if 3 * sum(map(len, marked_)) >= sum(len(t) for t, _ in left) and marked_
                                else [t for t, _ in left])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sites_equal_a_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    shared = [f"Shared sentence {k} of many articles." for k in range(4)]
    pages, rows = {}, []
    for host in ("a.example", "b.example", "c.example"):
        for n in range(rng.choice([1, 2, 7, 9])):
            lines = [(f"Menu of {host}", "div", 0)]
            lines += [(f"Letter of {host}", "p", 1)] if rng.random() < 0.8 else []
            lines += [(f"Story {host} {n} {k} " + "word " * rng.randrange(1, 9) + "end.", "p", 1) for k in range(rng.randrange(1, 4))]
            lines += [(rng.choice(shared), rng.choice(["p", "li"]), 1)] if rng.random() < 0.7 else []
            lines += [(f"Rights of {host}", "p", 1)] if rng.random() < 0.8 else []
            lines += [(f"Made by {host}", "div", 0)]
            page = "<body>" + "".join(f"<{x}>{t}</{x}>" for t, x, m in lines[:1]) + "<article>" + "".join(
                f"<{x}>{t}</{x}>" for t, x, m in lines if m) + "</article>" + f"<div>Made by {host}</div></body>"
            key = len(pages)
            pages[key] = (host, n, lines)
            rows.append((key, f"http://{host}/{n:03}", page, None, None))
    got = {r.page_id: r.text for r in hx.extract(frame(spark, rows)).collect()}
    assert got == expected(pages)


def test_body_outside_teaser_articles_stays(spark):
    body = "".join(f"<p>Paragraph {k} of the story {{i}}, long enough to be its body.</p>" for k in range(5))
    page = "<body><{0}>" + body + "</{0}><article><p>Teaser {i}</p></article></body>"
    rows = [(10 * n + i, f"http://{tag}.example/{i}", page.format(tag, i=i), None, None)
            for n, tag in enumerate(("main", "div")) for i in range(3)]
    for r in hx.extract(frame(spark, rows)).collect():
        assert all(f"Paragraph {k} of the story {r.page_id % 10}," in r.text for k in range(5))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.sampled_from("abc"), max_size=60))
def test_rows_made_again_on_the_way_back(a, b):
    picked = [x for x, g in zip(a, hx.common_blocks(a, b)) if g]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    rest = iter(b)
    assert all(x in rest for x in picked) and len(picked) == best[-1][-1]


def test_copies_do_not_delete_each_other(spark):
    body = "<p>Same article text on two addresses, word for word, and long.</p>"
    rows = [(i, f"http://h.example/{i}", plain(1, body), None, None) for i in range(3)]
    got = [r.text for r in hx.extract(frame(spark, rows)).collect()]
    assert all("Same article text" in t for t in got)


def test_hot_host_is_dealt_into_buckets_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(hx, "BUCKET_PAGES", 8)
    rows = [(i, f"http://h.example/{i}?q=1#x", PAGE.format(body=f"<article><p>Text {i}</p></article>"), None, None)
            for i in range(300)]
    got = hx.extract(frame(spark, rows)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [
        (i, f"Text {i}", len(f"Text {i}")) for i in range(300)]


def in_order(rows):
    """Texts of rows (page_id, host, path and query, html), each with its neighbours in the whole order."""
    pages = []
    for i, host, path, query, page in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0])):
        blocks, inside, places = hx.read_blocks(page)
        pages.append((i, host, hx.Page({"blocks": blocks, "sizes": list(map(len, blocks)), "inside": inside,
                                        "places": places, "path": path, "query": query})))
    near = lambda k, j: pages[j][2] if 0 <= j < len(pages) and pages[j][1] == pages[k][1] else None
    return {i: "\n\n".join(b for b, v in zip(p.blocks, p.judged(near(k, k - 1), near(k, k + 1)), strict=True)
                           if v == hx.KEEP) for k, (i, _, p) in enumerate(pages)}


@pytest.mark.parametrize("n", [39, 900])
def test_neighbours_are_exact_at_any_size_of_a_host(spark, monkeypatch, n):
    monkeypatch.setattr(hx, "BUCKET_PAGES", 8)
    rows = []
    for i in range(n):
        # Pages of a section share its frame, so the wrong neighbour leaves it in the text.
        page = f"<body><div>Menu of section {i // 3}</div><p>Story {i}, longer than the frame of its section</p></body>"
        rows += [(i, "a.example", f"/{i // 3:04}/{i:04}", "", page),
                 (n + i, "b.example", "/index.php", f"?id={i:04}", page), (2 * n + i, "", "", "", page)]
    table = [(i, None if not host else f"http://{host}{path}{query}#top", page, None, None)
             for i, host, path, query, page in rows]
    got = {r.page_id: r.text for r in hx.extract(frame(spark, table)).collect()}
    assert got == in_order(rows)
    assert not any("Menu" in got[i] for i in range(n))
    ranges = hx._ranges(hx._located(frame(spark, table)))
    assert len(ranges) > 2 and len({f[0] for f, _ in ranges} | {x[0] for _, x in ranges}) == 3


def test_edges(spark):
    long_page = PAGE.format(body="<article>" + "<p>word</p>" * 50_000 + "</article>")
    rows = [(1, None, None, None, None), (2, "", "", None, None), (None, "http://a/b", "<p>x</p>", None, None),
            (3, "http://a/b", "<p>x</p>", None, None), (3, "http://a/b", "<p>x</p>", None, None),
            (4, "not a url", long_page, None, None)]
    got = hx.extract(frame(spark, rows)).collect()
    assert len(got) == 6
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[1].url is None
    assert by[4].text == "\n\n".join(["word"] * 50_000)
    assert sum(r.text == "x" for r in got) == 3
    assert hx.extract(frame(spark, rows[:1]).limit(0)).collect() == []


def test_pages_table(spark):
    got = hx.op6_html_extraction(spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text) > 0
        assert "&copy;" not in r.text and "track(" not in r.text

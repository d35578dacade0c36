"""Pages as blocks: layouts come back from their HTML, in linear time, whatever is cut off."""

import html
import random
import time

from quarry.operators.layout import Layout, page_blocks


def read(page):
    return Layout().read(page)


def test_random_layouts_come_back():
    """Brute force the other way: pages are written from known blocks."""
    rng = random.Random(5)
    words = ["amber", "a < b", "x & y", '"q"', "ö", "1"]

    def text():
        return " ".join(rng.choices(words, k=rng.randint(1, 4)))

    def closed(tag, inner, must=False):
        attrs = rng.choice(["", ' class="a>b"', " data-x='<p>'", " hidden"])
        return f"<{tag}{attrs}>{inner}" + (f"</{tag} >" if must or rng.random() < 0.5 else "")

    def lists(depth, region, out):
        items = ""
        for _ in range(rng.randint(1, 3)):
            t = text()
            out.append(("item", depth, region, t, None))
            inner = f"<b>{html.escape(t)}" + rng.choice(["", "</b>"])
            items += closed("li", inner + (lists(depth + 1, region, out) if depth < 3 and rng.random() < 0.4 else ""))
        return closed("ul", items, must=True)

    def table(depth, region, out):
        rows = ""
        for _ in range(rng.randint(1, 2)):
            cells, row = [], ""
            for _ in range(rng.randint(1, 3)):
                t = text()
                cells.append(t)
                row += closed(rng.choice(["td", "th"]), f"<p>{html.escape(t)}" + (table(depth + 1, region, out) if depth < 2 and rng.random() < 0.3 else ""))
            rows += closed("tr", row)
            out.append(("row", depth, region, " | ".join(cells), cells))
        return closed("table", rows, must=True)

    for _ in range(400):
        out, page = [], "<!DOCTYPE html><script>'<p>no</p>'</script>"
        for _ in range(rng.randint(1, 8)):
            region = rng.choice(["body", "nav", "footer"])
            kind, inner, t = rng.choice(["p", "h2", "ul", "table", "pre", "text"]), "", text()
            if kind == "ul":
                inner = lists(1, region, out)
            elif kind == "table":
                inner = table(1, region, out)
            elif kind == "pre":
                out.append(("pre", 0, region, t + "\n  " + t, None))
                inner = closed("pre", html.escape(t + "\n  " + t), must=True)
            else:
                out.append(("heading", 2, region, t, None) if kind == "h2" else ("paragraph", 0, region, t, None))
                inner = f"<div>{html.escape(t)}</div>" if kind == "text" else closed(kind, html.escape(t), must=kind == "h2")
            page += f"<!-- <p> -->{inner}" if region == "body" else f"<{region}>{inner}</{region}>"
            page += "<div></div>"
        assert read(page) == out, page


def test_cases():
    assert read("a<br>b  c<p>d") == [("paragraph", 0, "body", "a\nb c", None), ("paragraph", 0, "body", "d", None)]
    assert read("<ul><li>a<ul><li>b</ul>c</ul>") == [("item", 1, "body", "a", None), ("item", 2, "body", "b", None), ("item", 1, "body", "c", None)]
    assert read("<table><td>1<td>2<tr><td><li>x</td></table>y")[-2:] == [("row", 1, "body", "x", ["x"]), ("paragraph", 0, "body", "y", None)]
    assert read("1 < 2 <3 </ x>&lt;<a title='>'>z</a>") == [("paragraph", 0, "body", "1 < 2 <3 <z", None)]
    assert read("") == read("<p") == read("<!-- x") == read("<script>x") == []
    assert read("</p></td></table>a</ul>b") == [("paragraph", 0, "body", "a", None), ("paragraph", 0, "body", "b", None)]


def test_every_prefix_of_a_page_is_read():
    page = '<title>t</title><nav><ul><li>a</ul></nav><h1 id="x">h</h1><table><tr><td>1<td>2</table><p>end &amp; more'
    whole = read(page)
    for i in range(len(page)):
        got = read(page[:i])
        assert [b[:3] for b in got] == [b[:3] for b in whole][: len(got)]


def test_hostile_pages_take_linear_time():
    # half a megabyte each; a tag that looked through the stack or the rest of the page would take minutes
    def took(page):
        t = time.time()
        read(page)
        return time.time() - t

    for unit in ("<div>", "</p>", '<a "> "', "<b '", "<", "<li>x", "<table><tr><td>", "<!--", "&", "<ul>", "<p>word "):
        n = 500_000 // len(unit)
        assert took(unit * n) < 10, unit
    assert took("<div>" * 100_000 + "x</p></ul>" * 100_000) < 10


def test_rows_of_the_operator(spark):
    df = spark.createDataFrame([(1, "<h1>a</h1><p>b"), (2, None), (3, ""), (1, "<p>c"), (None, "<p>d")], "id long, html string").selectExpr("id", "html", "'x' AS text", "0 AS block")
    got = sorted(map(tuple, page_blocks(df, "id").select("id", "block", "kind", "depth", "text").collect()), key=str)
    assert got == sorted([(1, 0, "heading", 1, "a"), (1, 1, "paragraph", 0, "b"), (1, 0, "paragraph", 0, "c"), (None, 0, "paragraph", 0, "d")], key=str)
    assert page_blocks(df.limit(0), "id").isEmpty()

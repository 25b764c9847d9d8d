import re

import pytest

from tessera.llm.html import extract, parse, render


def text(source):
    return render(parse(source))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", ""),
        ("a &amp; b", "a & b"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<div>a</div><div>b<br>c</div>", "a\nb\nc"),
        ("x  <b> y</b>\n z", "x y z"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a   | bb\nccc | d"),
        ("<table><tr><th colspan=2>wide title here<tr><td>1<td>2</table>", "wide title here\n1 | 2"),
        ("<head><title>t</title></head><body>x<script>'</p>'</script><style>p{}</style>", "x"),
        ("<p hidden>a</p><p style='display: none'>b</p><p style='visibility:hidden'>c<i style='visibility:visible'>d</i></p>e", "d\n\ne"),
        ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
        ("a<!-- x <p> -->b<![CDATA[y]]>", "ab"),
        ("a </p></div> b </li>", "a b"),
        ("1 < 2 <3", "1 < 2 <3"),
        ("<a href='x>y'>z</a><unknown q=\"", 'z<unknown q="'),
        ("<table><tr><td>x<table><tr><td>in</table><td>y</table>", "x in | y"),
    ],
)
def test_rendering(source, want):
    assert re.sub(r" +$", "", text(source), flags=re.M) == want


def test_deep_and_long():
    assert text("<div>" * 50_000 + "x") == "x"
    assert text("<table><tr><td>" * 300 + "x").split()[-1] == "x"
    assert text("</div>" * 50_000 + "<p>" * 50_000 + "x") == "x"
    assert len(text("word " * 200_000)) == 999_999


def test_extract(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "<p>a", "x"), (3, "<p>a", None)], "page_id long, html string, text string")
    assert [(r.page_id, r.text) for r in extract(df).collect()] == [(1, None), (2, ""), (3, "a"), (3, "a")]
    assert extract(df).columns == df.columns and extract(df.limit(0)).count() == 0


def test_every_visible_word_is_kept(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>|<style.*?</style>", " ", r.html)
        import html

        words = [w for part in re.split(r"<[^>]*>", body) for w in html.unescape(part).split()]
        got = re.sub(r"(?m)^ *(?:-|\d+\.) ", " ", text(r.html)).split()  # "|" stands between cells
        assert sorted("".join(words).replace("|", "")) == sorted("".join(got).replace("|", "")), r.page_id


def test_stray_and_hidden_parts_of_tables():
    from tessera.llm import html

    shown = lambda source: html.render(html.parse(source)).split()
    assert shown("<table><tbody><td>A</td><td>B</td></tbody></table>") == ["A", "|", "B"]
    assert shown("<table><tbody>x <b>y</b><tr><td>A</td></tr></tbody></table>") == ["x", "y", "A"]
    assert shown("<table><tbody><form><tr><td>A</td></tr><tr><td>B</td></tr></form></tbody></table>") == ["A", "B"]
    assert shown("<table><script>var a</script><caption hidden>b</caption><tr><td>A</td></tr></table>") == ["A"]
    assert shown("<table><tr style='visibility:hidden'><td>a</td><td style='visibility:visible'>B</td></tr></table>") == ["|", "B"]
    assert shown("<table><tbody style='visibility:hidden'>x<tr><td>a</td></tr></tbody></table>") == []


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ('<table><tr><td colspan="' + "9" * 5000 + '">x<td>y</table>', "x | y"),
        ("<table><tbody>lost text<p>para</p><tr><td>x", "lost text\npara\nx"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ('<p>before <a href="x>link</a> after</p><p>more', "before link after\n\nmore"),
        ("<table><tr><td><pre>l1\n  l2</pre><td>z</table>", "l1   | z\n  l2 |"),
        ("<table><tr><td>one<td>two<tr><td colspan=2>both<td>three</table>", "one | two\nboth      | three"),
    ],
)
def test_spans_quotes_and_preformatted_cells(source, want):
    assert re.sub(r" +$", "", text(source), flags=re.M) == want


def test_work_and_output_stay_in_proportion():
    import time

    assert len(text("<table><tr>" + "<td colspan=1000>x" * 50 + "</table>")) < 1000
    for piece in ("<a", "<a '", '<a "', "<!-", "</", "<a b='"):
        began = time.time()
        text(piece * 40_000 + "<p>x")
        assert time.time() - began < 2, piece


def test_cells_of_several_rows_over_many_rows():
    """Placement against one that keeps every column of every row, and work in proportion to the page."""
    import random
    import time

    from tessera.llm.html import _taken

    def slow(rows):
        held, out = {}, []
        for cells in rows:
            at, places = 0, []
            for span, down in cells:
                while held.get(at):
                    at += 1
                places.append(at)
                if down > 1:
                    held |= {i: down for i in range(at, at + span)}
                at += span
            held = {i: n - 1 for i, n in held.items() if n > 1}
            out.append(places)
        return out

    def fast(rows):
        held, out = [], []
        for r, cells in enumerate(rows):
            held, at, k, taken, places = [x for x in held if x[2] > r], 0, 0, [], []
            for span, down in cells:
                while k < len(held) and held[k][0] <= at:
                    at, k = max(at, held[k][1]), k + 1
                places.append(at)
                if down > 1:
                    taken.append((at, at + span, min(r + down, len(rows))))
                at += span
            held = _taken(held, taken) if taken else held
            out.append(places)
        return out

    rng = random.Random(2)
    for _ in range(300):
        rows = [[(rng.choice([1, 1, 2, 5]), rng.choice([1, 1, 2, 3, 9])) for _ in range(rng.randint(0, 5))] for _ in range(rng.randint(1, 9))]
        assert fast(rows) == slow(rows)
    page = "<table><tr>" + "<td colspan=1000 rowspan=65534>x</td>" * 200 + "</tr>" + "<tr><td>a</td></tr>" * 2000 + "</table>"
    began = time.process_time()
    assert render(parse(page)).count("\n") == 2000 and time.process_time() - began < 5

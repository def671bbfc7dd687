from hypothesis import given, settings
from hypothesis import strategies as st

from seqlake.llm import html_text


def text(page):
    return "\n".join(html_text.blocks(page)[0])


def test_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
    <nav><ul><li>Menu</li></ul></nav><!-- <p>no</p> --><div class="ad box">Buy</div>
    <article><header>By line</header><h1>Head&nbsp;line</h1><p>One <b>two</b>
      three &amp; <i>four</i><br>five<p>Six<script>var a="</p>";</script><form><input>x</form>
    <section class='post comments'>Me too</section><aside>Side</aside><ul><li>A<li>B</ul></article>
    <footer>&copy;</footer></body></html>"""
    assert text(page) == "Head line\nOne two three & four five\nSix\nA\nB"


def test_broken_markup():
    assert text("<article><p>One <b>bold<p>Two &am") == "One bold\nTwo &am"
    assert text('<p>a < b and c > d <p title="x>y">z') == "a < b and c > d\nz"
    assert text("<article>x<scri") == "x"
    assert text("<p>one</p></div></p>two") == "one\ntwo"
    assert text("<script>never closed <p>x") == ""
    assert text("<P CLASS=Sidebar>a</P><P>b</P>") == "b"
    assert text("plain\n text") == "plain text"


def brute(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_shared_is_a_longest_common_subsequence(a, b):
    places = html_text.shared(a, b)
    assert len(places) == brute(a, b) and places == sorted(set(places))
    rest = iter(b)
    assert all(a[i] in rest for i in places)


def page(site, body):
    return f"<body><div>{site} site</div><p>Start</p><div>{body}</div><p>Legal line</p></body>"


def test_nearest_pages_are_differenced(spark):
    rows = [(1, "http://a.org/x/1", page("A", "first")), (2, "http://a.org/x/2", page("A", "second")),
            (3, "http://b.org/x/2", page("B", "alone")), (4, None, None), (5, "http://c.org/1", ""),
            (1, "http://a.org/x/1", page("A", "first")),
            (6, "http://d.org/1", "<p>copy"), (7, "http://d.org/2", "<p>copy"),
            (8, "http://e.org/1", "<article><p>same</article>"),
            (9, "http://e.org/2", "<article><p>same<p>more</article>")]
    pages = spark.createDataFrame([(*r, "noise", 3) for r in rows],
                                  "page_id bigint, url string, html string, template string, key int")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect())
    want = {1: "first", 2: "second", 3: "B site\nStart\nalone\nLegal line", 4: "", 5: "", 6: "copy",
            7: "copy", 8: "same", 9: "same\nmore"}
    assert got == sorted((r[0], want[r[0]], len(want[r[0]])) for r in rows)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_hot_host(spark):
    rows = [(i, f"http://a.org/{i % 97}/{i}", page("A", f"own {i}")) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert all(r["text"] == f"own {r['page_id']}" for r in html_text.extract(pages).collect())


def test_copies_and_previews_keep_their_text(spark):
    article = [f"paragraph {i}" for i in range(9)]
    paged = lambda lines: "".join(f"<p>{x}" for x in lines)
    around = lambda lines: paged(["A site", "Start", *lines, "Legal line"])
    rows = [(1, "http://a.org/x/1", paged([*article, "1 May"])),
            (2, "http://a.org/x/2", paged([*article, "2 May"])),
            (3, "http://b.org/x", paged(article)), (4, "http://b.org/x?print", paged(article[:6])),
            # the next page that differs tells the template of two near copies
            (5, "http://c.org/x/1", around([*article, "1 May"])),
            (6, "http://c.org/x/2", around([*article, "2 May"])),
            (7, "http://c.org/y", around(["one", "two", "Start", "three"]))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(pages).collect()}
    assert got == {1: [*article, "1 May"], 2: [*article, "2 May"], 3: article, 4: article[:6],
                   5: [*article, "1 May"], 6: [*article, "2 May"],
                   # only the aligned place of a repeated block goes
                   7: ["one", "two", "Start", "three"]}


def test_articles_are_differenced(spark):
    """A line without a mark that all near articles of a host have goes; a quotation of two articles,
    copies and hosts of few articles stay whole."""
    def article(*lines):
        return "<nav>Menu</nav><article>" + "".join(f"<p>{x}" for x in lines) + "</article>"

    own = {i: [f"{i} {part}" for part in "abcde"] for i in range(9)}
    quoted = {3: ["quoted"], 4: ["quoted"]}
    rows = [(i, f"http://a.org/x/{i}", article("Our letters", *own[i], *quoted.get(i, []), "Legal line"))
            for i in range(9)]
    rows += [(20 + i, f"http://b.org/{i}", article("Our letters", *own[i])) for i in range(3)]
    rows += [(30 + i, f"http://c.org/{i}", article(*own[0], *own[1][:3], f"day {i}")) for i in range(6)]
    # the other pages of a host have their own neighbours
    rows += [(40, "http://a.org/x/4x", page("A", "first")), (41, "http://a.org/x/5x", page("A", "second"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(pages).collect()}
    want = {i: own[i] + quoted.get(i, []) for i in range(9)}
    want |= {20 + i: ["Our letters", *own[i]] for i in range(3)}
    want |= {30 + i: [*own[0], *own[1][:3], f"day {i}"] for i in range(6)}
    assert got == want | {40: ["first"], 41: ["second"]}


def test_runs_do_not_change_the_template(spark, monkeypatch):
    rows = [(i, f"http://{'ab'[i % 2]}.org/{i:03}", f"<article><p>Line<p>own {i}<p>text {i}</article>")
            for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for size in (9, 1024):
        monkeypatch.setattr(html_text, "RUN", size)
        got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
        assert got == {i: f"own {i}\ntext {i}" for i in range(150)}

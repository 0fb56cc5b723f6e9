import html as entities
import re
import time

import duckdb

from loomsift.llm.html_extract import Page, extract, path_id, winning_paths

from .cases import clashing


def text(markup, path=None):
    return Page(markup).main(path)


def of(path):
    """The hash of a path that is written out."""
    out = 0
    for key in path.split(">"):
        out = path_id(out, key)
    return out


def test_pages():
    assert text("") == ""
    assert text("plain text & more") == "plain text & more"
    assert text("<p>a<p>b") == "a\nb"
    assert text("<article><p>x <script>if(a<b){}</script>y</article>") == "x y"
    assert text("<body><div class='comments'><p>c</p></div><div class=post><h1>T</h1><p>A<br>B&nbsp;&eacute;c</p><div class='share'>s</div><ul><li>1<li>2</ul></div>") == "T\nA B éc\n1\n2"
    assert text("<main><article><header>h</header><p>body text here</p><aside>no</aside><form>f</form><footer>no</footer></article></main><nav>n</nav>") == "body text here"
    assert text("<a href='x>y'>z</a>") == "z"
    assert text("<div>" * 5000 + "deep") == "deep"
    assert text("<article><p>one</p><!-- <p>two</p> --><p>three &amp") == "one\nthree &"
    assert text("<body class='has-sidebar'><article class='related post'><p>stays</p></article></body>") == "stays"
    assert text("<html><head><title>t</title><meta x></head><article><p>b<table><tr><td>1<td>2</table>") == "b\n1\n2"
    assert text("<div id=cookie-notice>accept</div><div id=content><p>the text</p></div>") == "the text"


def test_nothing_of_the_article_goes():
    words = "words of the article " * 20
    assert text(f"<body><form><nav>menu</nav><article><p>{words}</p></article></form></body>") == words.strip()
    assert text(f"<body><form id=aspnet><div class=page><div class=menu>m</div><div class=text><p>{words}</p></div></div></form></body>") == words.strip()
    kept = f"<section id='discussion'><p>{words}</p></section><p class='related'>more</p><div class='legal-text'>law</div><p class='ad'>p</p>"
    assert text(f"<body><article>{kept}</article></body>") == f"{words.strip()}\nmore\nlaw\np"
    assert text(f"<article><header><h1>Title</h1><p>by</p></header><p>{words}</p><footer>f</footer></article>") == f"Title\nby\n{words.strip()}"
    assert text(f"<body><header><h1>Site</h1></header><article><p>{words}</p></article></body>") == words.strip()
    posts = "".join(f"<div class=post><p>post {i} {words}</p></div>" for i in range(3))
    assert text(f"<body>{posts}</body>", of("body>div.post")).count("post") == 3
    assert text(f"<nav><article><p>{words}</p></article></nav>") == words.strip()


TEMPLATES = {
    "wrapper": "<body><div id=header><a href=/>Site</a></div><div class='nav'><ul><li><a>x</a></ul></div><div id=main><div class=entry><h1>{t}</h1><p>{a}</p><p>{b}</p></div><div id=comments><p>{c}</p></div></div><div id=footer class=footer>(c)</div></body>",
    "table": "<body><table><tr><td class=menu><a>m</a><br><a>n</a></td><td class=content><h2>{t}</h2><p>{a}</p><p>{b}</p></td></tr></table></body>",
    "main": "<body><header><nav>m</nav></header><main><h1>{t}</h1><section><p>{a}</p></section><section><p>{b}</p></section><aside>side</aside></main><footer>f</footer></body>",
    "form": "<body><form action=/><input name=q><div class=post-{i}><h1>{t}</h1><p>{a}</p><p>{b}</p></div><div class=ads>{c}</div></form></body>",
    "bare": "<body><div class=cookie-banner>We use cookies</div><h1>{t}</h1><p>{a}</p><p>{b}</p><ul class=share><li>tell</ul></body>",
}


def test_unlike_templates(spark):
    rows, want = [], {}
    for n, (name, markup) in enumerate(TEMPLATES.items()):
        for i in range(4):
            t, a, b = f"Title {i}", f"first paragraph {i} " * 12, f"second paragraph {i} of some length " * 9
            rows.append((10 * n + i, f"http://{name}.com/{i}", markup.format(t=t, a=a, b=b, c=f"a remark by reader {i} " * 3, i=i)))
            want[10 * n + i] = f"{t}\n{a.strip()}\n{b.strip()}"
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_deep_nesting_takes_linear_time():
    for tags in (["<div>"], ["<h1>"], ["<p><table><tr><td><div>"], ["<a><span>", "</b>"], ["<li>", "<ul>"], ["<div class=c>", "<p>"]):
        n = 100_000 // sum(t.count("<") for t in tags)
        start = time.process_time()
        assert text("".join(t * n for t in tags) + "deep").endswith("deep")
        assert time.process_time() - start < 8


def test_consensus(spark):
    good = "<body><div class='x1'><p>{}</p></div><div class='links'><p>{}</p></div></body>"
    rows = [(i, f"http://h.com/{i}", good.format("main text " * 20, "side " * 3)) for i in range(5)]
    rows.append((9, "http://H.com/9", good.format("short", "side words are more here " * 9)))
    rows.append((10, None, None))
    rows.append((11, "no url", "<p>x</p>"))
    rows.append((11, "no url", "<p>x</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in extract(df).collect()}
    assert got[9]["text"] == "short" and got[9]["n_chars"] == 5 and got[9]["path"] == "body>div.x#"
    assert got[0]["text"] == ("main text " * 20).strip()
    assert (got[10]["text"], got[10]["n_chars"], got[11]["text"]) == ("", 0, "x")
    assert extract(clashing(df)).count() == len(rows) and extract(df.limit(0)).count() == 0
    ties = spark.createDataFrame([("h", 2, 5), ("h", 1, 5), (None, 3, 1)], "host string, path long, vote long")
    assert {r["host"]: r["path"] for r in winning_paths(ties).collect()}["h"] == 1


def test_articles_of_the_tables():
    """Every page against a plain reading: what stands in the article, cut at block tags."""
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (h,) in rows:
        body = re.search(r"<article>(.*?)(</article>|\Z)", h, re.S)[1]
        parts = re.split(r"</?(?:p|h1|div|li|ul|ol|table|tr|td|blockquote|h2|h3)\b[^>]*>", body)
        parts = [" ".join(entities.unescape(re.sub(r"</?[a-zA-Z][^>]*(>|\Z)", "", x.replace("<br>", " "))).split()) for x in parts]
        assert text(h) == "\n".join(x for x in parts if x)
